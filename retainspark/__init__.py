"""retainspark — subscriber-retention analytics as Spark DataFrame operators.

Every operator takes DataFrames (and Columns) and returns a DataFrame; the
work is expressed with Spark SQL functions, windows, joins and aggregates so
that Catalyst plans it and the executors run it.  Sub-packages:

* ``sources``   – table access, the ``customers_raw`` bridge, sinks
* ``functions`` – column-level encodings, derived features and rules
* ``operators`` – profiling, ranking, metrics, survival, uplift, drift,
                  decisioning, models, attribution and the run registry
* ``plans``     – end-to-end compositions (ETL, batch scoring, targeting)
* ``streaming`` – incremental scoring with Structured Streaming
"""

from .session import build_session, checkpoint_dir, stable

__all__ = ["build_session", "checkpoint_dir", "stable"]
