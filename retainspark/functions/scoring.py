"""Linear-logistic scorers as column expressions.

A logistic model is an intercept plus a coefficient per column pushed through
the logistic function; scoring it is one codegen'd projection.  The same
form is used for coefficients fitted by ``pyspark.ml`` (operators.models) and
for the fixed retention scorer used when no fitted model is supplied.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class LinearScorer:
    intercept: float
    coefficients: tuple  # ((column, weight), ...)
    centers: tuple = ()  # optional ((column, center), ...) subtracted first

    def margin(self) -> Column:
        centers = dict(self.centers)
        z = F.lit(float(self.intercept))
        for col, w in self.coefficients:
            x = F.col(col).cast("double")
            if col in centers:
                x = x - F.lit(float(centers[col]))
            z = z + F.lit(float(w)) * x
        return z

    def probability(self) -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.margin()))


# The model-free retention scorer used on the bridged tables.
# control margin  z  = 2.0 - 0.04*tenure - 0.7*contract + 0.02*(monthly - 60)
# treated margin  z' = z - (1.6*digital_engagement - 0.8)
CONTROL_SCORER = LinearScorer(2.0, (("tenure", -0.04), ("Contract_encoded", -0.7),
                                    ("MonthlyCharges", 0.02)), (("MonthlyCharges", 60.0),))
TREATED_SCORER = LinearScorer(2.8, (("tenure", -0.04), ("Contract_encoded", -0.7),
                                    ("MonthlyCharges", 0.02), ("digital_engagement", -1.6)),
                              (("MonthlyCharges", 60.0),))


def retention_scores(features: DataFrame, control: LinearScorer = CONTROL_SCORER,
                     treated: LinearScorer = TREATED_SCORER) -> DataFrame:
    """Adds p_control, p_treated, uplift_score = p_control − p_treated
    (SURVEY D17) and churn_probability = p_control."""
    df = features.withColumns({"p_control": control.probability(),
                               "p_treated": treated.probability()})
    return df.withColumns({"uplift_score": F.col("p_control") - F.col("p_treated"),
                           "churn_probability": F.col("p_control")})
