"""Cleaning and categorical encodings.

Two encoding profiles exist because the two upstream code paths disagree
(SURVEY D3/D4): ``etl`` (defaults for unmapped values, Female=1, 7 service
flags) and ``training`` (NULL for unmapped values, Male=1, 8 service flags
including phone).  Every mapping is a literal CASE ladder, so it stays inside
whole-stage codegen.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lenient_number(c: Column, default: float | None = 0.0) -> Column:
    """Blank or non-numeric text → NULL → ``default``."""
    parsed = F.trim(c).try_cast("double")
    return parsed if default is None else F.coalesce(parsed, F.lit(float(default)))


def map_values(c: Column, mapping: dict, default=None, dtype: str = "int") -> Column:
    """Literal lookup as a CASE ladder; values absent from ``mapping`` give
    ``default`` (NULL when ``default`` is None)."""
    out = None
    for k, v in mapping.items():
        out = F.when(c == F.lit(k), F.lit(v)) if out is None else out.when(c == F.lit(k), F.lit(v))
    out = out.otherwise(F.lit(default))
    return out.cast(dtype)


def yes_flag(c: Column) -> Column:
    """1 iff the value is exactly 'Yes'."""
    return F.when(c == F.lit("Yes"), 1).otherwise(0).cast("int")


def label(c: Column, positive: str = "Yes") -> Column:
    """Binary label."""
    return F.when(c == F.lit(positive), 1).otherwise(0).cast("int")


# Label → code maps of the two profiles.
ETL_BINARY = {"Yes": 1, "No": 0, "Female": 1, "Male": 0}
ETL_INTERNET = {"DSL": 0, "Fiber optic": 1, "No": 2}
ETL_CONTRACT = {"Month-to-month": 0, "One year": 1, "Two year": 2}
ETL_PAYMENT = {"Electronic check": 0, "Mailed check": 1, "Bank transfer": 2, "Credit card": 3}
TRAIN_BINARY = {"Yes": 1, "No": 0, "No phone service": 0, "No internet service": 0}
TRAIN_GENDER = {"Male": 1, "Female": 0}
TRAIN_CONTRACT = {"Month-to-month": 0, "One year": 1, "Two year": 2}
TRAIN_INTERNET = {"No": 0, "DSL": 1, "Fiber optic": 2}
TRAIN_PAYMENT = {"Electronic check": 0, "Mailed check": 1,
                 "Bank transfer (automatic)": 2, "Credit card (automatic)": 3}

# raw snake_case name → feature-table name
RENAME = {
    "customer_id": "customerID", "senior_citizen": "SeniorCitizen",
    "partner": "Partner", "dependents": "Dependents",
    "phone_service": "PhoneService", "multiple_lines": "MultipleLines",
    "online_security": "OnlineSecurity", "online_backup": "OnlineBackup",
    "device_protection": "DeviceProtection", "tech_support": "TechSupport",
    "streaming_tv": "StreamingTV", "streaming_movies": "StreamingMovies",
    "paperless_billing": "PaperlessBilling", "monthly_charges": "MonthlyCharges",
    "total_charges": "TotalCharges", "churn": "Churn_binary",
}

SERVICE_FLAGS_ETL = ("MultipleLines", "OnlineSecurity", "OnlineBackup", "DeviceProtection",
                     "TechSupport", "StreamingTV", "StreamingMovies")
SERVICE_FLAGS_TRAINING = ("PhoneService",) + SERVICE_FLAGS_ETL


@dataclass(frozen=True)
class Profile:
    name: str
    service_flags: tuple = field(default=SERVICE_FLAGS_ETL)
    default_fill: bool = True


PROFILES = {
    "etl": Profile("etl", SERVICE_FLAGS_ETL, True),
    "training": Profile("training", SERVICE_FLAGS_TRAINING, False),
}


def encode_customers(raw: DataFrame, profile: str = "etl", keep=()) -> DataFrame:
    """P1–P9 + P19 over the raw customer schema; returns the feature-table
    naming (CamelCase) with raw categoricals kept in snake_case, and the
    columns ``keep`` unchanged."""
    p = PROFILES[profile]
    c = F.col
    out = {"customerID": c("customer_id")}
    if p.name == "etl":
        out["gender"] = map_values(c("gender"), ETL_BINARY, 0)
        for raw_name in ("partner", "dependents", "phone_service", "paperless_billing"):
            out[RENAME[raw_name]] = map_values(c(raw_name), ETL_BINARY, 0)
        for raw_name in ("multiple_lines", "online_security", "online_backup",
                         "device_protection", "tech_support", "streaming_tv", "streaming_movies"):
            out[RENAME[raw_name]] = yes_flag(c(raw_name))
        out["InternetService_encoded"] = map_values(c("internet_service"), ETL_INTERNET, 2)
        out["Contract_encoded"] = map_values(c("contract"), ETL_CONTRACT, 0)
        out["PaymentMethod_encoded"] = map_values(c("payment_method"), ETL_PAYMENT, 0)
        out["Churn_binary"] = map_values(c("churn"), ETL_BINARY, 0)
    else:
        out["gender"] = map_values(c("gender"), TRAIN_GENDER)
        for raw_name in ("partner", "dependents", "phone_service", "paperless_billing",
                         "multiple_lines", "online_security", "online_backup",
                         "device_protection", "tech_support", "streaming_tv", "streaming_movies"):
            out[RENAME[raw_name]] = map_values(c(raw_name), TRAIN_BINARY)
        out["InternetService_encoded"] = map_values(c("internet_service"), TRAIN_INTERNET)
        out["Contract_encoded"] = map_values(c("contract"), TRAIN_CONTRACT)
        out["PaymentMethod_encoded"] = map_values(c("payment_method"), TRAIN_PAYMENT)
        out["Churn_binary"] = label(c("churn"))
    out["SeniorCitizen"] = c("senior_citizen").cast("int")
    out["tenure"] = c("tenure").cast("int")
    out["MonthlyCharges"] = c("monthly_charges").cast("double")
    out["TotalCharges"] = lenient_number(c("total_charges"), 0.0)
    out["internet_service"] = c("internet_service")
    out["contract"] = c("contract")
    out["payment_method"] = c("payment_method")
    return raw.select(*[v.alias(k) for k, v in out.items()], *keep)
