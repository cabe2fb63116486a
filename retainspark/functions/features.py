"""Derived behavioural features."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from .encode import PROFILES

# Ordered feature contract of the scoring request (27 columns)
# and the 8-column uplift contract with its renames.
FEATURE_COLS = (
    "tenure", "SeniorCitizen", "MonthlyCharges", "TotalCharges", "Partner", "Dependents",
    "PhoneService", "PaperlessBilling", "MultipleLines", "OnlineSecurity", "OnlineBackup",
    "DeviceProtection", "TechSupport", "StreamingTV", "StreamingMovies", "Contract_encoded",
    "InternetService_encoded", "PaymentMethod_encoded", "recency_risk", "service_count",
    "monetary_value", "monthly_to_total_ratio", "charge_per_month", "clv_proxy",
    "is_high_value", "contract_stability", "digital_engagement",
)
UPLIFT_RENAME = {
    "tenure": "tenure", "MonthlyCharges": "monthly_charges", "Contract_encoded": "contract_type",
    "service_count": "service_count", "clv_proxy": "clv_proxy", "SeniorCitizen": "senior_citizen",
    "Partner": "has_partner", "digital_engagement": "digital_engagement",
}
HIGH_VALUE_QUANTILE = 0.75
SHORT_FORM_HIGH_VALUE_CLV = 500.0


def safe_ratio(num: Column, den: Column) -> Column:
    """Division that yields NULL instead of failing under ANSI mode."""
    return F.try_divide(num, den)


def row_sum(cols) -> Column:
    """Row-wise sum of flag columns; NULL flags count as 0."""
    return reduce(add, [F.coalesce(F.col(c), F.lit(0)) for c in cols]).cast("int")


def derive_features(enc: DataFrame, profile: str = "etl", with_high_value: bool = True,
                    high_value_quantile: float = HIGH_VALUE_QUANTILE) -> DataFrame:
    """P10–P18 over an encoded customer table.

    ``is_high_value`` compares each row with the table-wide 75th percentile of
    ``clv_proxy`` (linear interpolation).  The percentile comes from
    ``operators.quantiles.exact_quantile_scalar`` – a scalar subquery over a
    distributed, exact rank search – so no row-sized state sits in one task.
    """
    p = PROFILES[profile]
    c = F.col
    tenure1 = c("tenure") + F.lit(1)
    df = enc.withColumns({
        "recency_risk": F.lit(1.0) / tenure1,
        "service_count": row_sum(p.service_flags),
        "monetary_value": c("TotalCharges"),
        "monthly_to_total_ratio": safe_ratio(c("MonthlyCharges"), c("TotalCharges") + F.lit(1)),
        "charge_per_month": c("MonthlyCharges") / tenure1,
    })
    df = df.withColumns({
        "clv_proxy": c("TotalCharges") * (F.lit(1.0) - c("recency_risk")),
        "contract_stability": (c("Contract_encoded") * c("tenure")).cast("int"),
        "digital_engagement": (
            (F.when(c("PaperlessBilling") == 1, 1).otherwise(0) if profile == "etl"
             else c("PaperlessBilling"))
            + F.when(c("PaymentMethod_encoded") >= 2, 1).otherwise(0)).cast("int"),
    })
    if with_high_value:
        from ..operators.quantiles import exact_quantile_scalar
        q = exact_quantile_scalar(df, "clv_proxy", high_value_quantile)
        df = df.withColumn("is_high_value", (c("clv_proxy") > q).cast("int"))
    return df


def uplift_frame(features: DataFrame, keep=("customerID",)) -> DataFrame:
    """Feature names → uplift-model names (8 columns)."""
    return features.select(*keep, *[F.col(k).alias(v) for k, v in UPLIFT_RENAME.items()])


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    """Columns whose type is numeric."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name not in exclude]


def clip(c: Column, lower=None, upper=None) -> Column:
    """P22."""
    if lower is not None:
        c = F.greatest(c, F.lit(lower))
    if upper is not None:
        c = F.least(c, F.lit(upper))
    return c


def round_half_even(c, digits: int) -> Column:
    """Numpy rounding – scale, round half to even on the double, unscale
    (``rint(x·10^d)/10^d``), which is what ``DataFrame.round`` does."""
    c = F.col(c) if isinstance(c, str) else c
    scale = float(10 ** digits)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def guarded_ratio(value: Column, cost: Column) -> Column:
    """Value / cost when cost > 0, else 0."""
    return F.when(cost > 0, value / cost).otherwise(F.lit(0.0))


def short_form_features(req: DataFrame, keep=("request_id",)) -> DataFrame:
    """P25: the 27-column contract from the short lookup form
    (tenure, monthly_charges, contract_code, internet_code, senior, partner,
    service_count, digital_engagement) with the lookup page's fixed values:
    total = monthly·max(tenure, 1), clv = total·(1 − 1/(tenure+1)),
    high value = clv > 500, paperless and both streaming flags on, phone on."""
    c = F.col
    t = c("tenure").cast("double")
    m = c("monthly_charges").cast("double")
    total = m * F.greatest(t, F.lit(1.0))
    clv = total * (F.lit(1.0) - F.lit(1.0) / (t + 1))
    fixed = {"Dependents": 0.0, "PhoneService": 1.0, "PaperlessBilling": 1.0, "MultipleLines": 0.0,
             "OnlineSecurity": 0.0, "OnlineBackup": 0.0, "DeviceProtection": 0.0, "TechSupport": 0.0,
             "StreamingTV": 1.0, "StreamingMovies": 1.0, "PaymentMethod_encoded": 0.0}
    exprs = {
        "tenure": t, "SeniorCitizen": c("senior").cast("double"), "MonthlyCharges": m,
        "TotalCharges": total, "Partner": c("partner").cast("double"),
        "Contract_encoded": c("contract_code").cast("double"),
        "InternetService_encoded": c("internet_code").cast("double"),
        "recency_risk": F.lit(1.0) / (t + 1), "service_count": c("service_count").cast("double"),
        "monetary_value": total, "monthly_to_total_ratio": m / (total + 1),
        "charge_per_month": m / (t + 1), "clv_proxy": clv,
        "is_high_value": (clv > F.lit(SHORT_FORM_HIGH_VALUE_CLV)).cast("double"),
        "contract_stability": c("contract_code").cast("double") * t,
        "digital_engagement": c("digital_engagement").cast("double"),
    }
    exprs.update({k: F.lit(v) for k, v in fixed.items()})
    return req.select(*keep, *[exprs[f].alias(f) for f in FEATURE_COLS])
