"""Training-data operators: filtering, deduplication, tokenisation, formats.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
