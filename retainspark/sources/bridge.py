"""Bridge from the supplied TPC-H-style tables to the retention data model.

The supplied tables hold no subscriber columns, so ``customers_raw`` derives
the raw-string customer schema (FIXTURES.md §3) from ``customer`` and
``orders`` with integer arithmetic and date differences only.  The same
formulas are written as SQL in ``retainspark.plans.oracle`` so an independent
engine computes identical rows.

Plan shape: ``orders`` is reduced to one (first, last) row per customer with a
partial (map-side) min/max aggregate, so a customer with a third of all
orders costs one row per input partition; the join to ``customer`` then
re-uses the aggregate's hash partitioning on the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

# Reference date for the churn label and the label sets of the
# raw customer schema.
CHURN_REFERENCE_DATE = "2001-08-01"
CHURN_GAP_DAYS = 180
MAX_TENURE = 72
CONTRACT_LABELS = ("Month-to-month", "One year", "Two year")
PAYMENT_LABELS = ("Electronic check", "Mailed check", "Bank transfer", "Credit card")
INTERNET_LABELS = ("DSL", "Fiber optic", "No")
MULTILINE_LABELS = ("Yes", "No", "No phone service")
ONLINE_SERVICES = ("online_security", "online_backup", "device_protection",
                   "tech_support", "streaming_tv", "streaming_movies")
# divisor of the id that drives each Yes/No online-service flag
ONLINE_DIVISORS = (19, 23, 29, 31, 37, 41)


def _pick(index: Column, labels) -> Column:
    out = None
    for i, lab in enumerate(labels):
        out = F.when(index == i, F.lit(lab)) if out is None else out.when(index == i, F.lit(lab))
    return out


def _yes_no(flag: Column) -> Column:
    return F.when(flag, F.lit("Yes")).otherwise(F.lit("No"))


def customer_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """first / last order date per customer (partial aggregate on orders)."""
    o = read_table(spark, sf_dir, "orders")
    return (o.select(F.col("o_custkey").alias("id"),
                     F.to_date("o_orderdate").alias("d"))
            .groupBy("id")
            .agg(F.min("d").alias("first_order"), F.max("d").alias("last_order")))


def customers_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw customer rows: strings for categoricals, ``total_charges`` as text
    with a blank in every tenth row (the lenient-parse case)."""
    c = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("bigint").alias("id"), "c_acctbal")
    df = c.join(customer_spans(spark, sf_dir), "id", "left")
    id_ = F.col("id")
    tenure = F.coalesce(
        F.least(F.lit(MAX_TENURE).cast("bigint"),
                F.expr("datediff(last_order, first_order) div 30")),
        F.lit(0).cast("bigint")).cast("int")
    mc = F.expr("CAST(1800 + floor((c_acctbal + 1000) * 100 / 110) AS BIGINT)")
    df = df.select(id_, tenure.alias("tenure"), mc.alias("mc"), "last_order")
    cents = F.col("mc") * F.col("tenure")
    total_txt = F.when(id_ % 10 == 0, F.lit(" ")).otherwise(
        F.concat(F.expr("(mc * tenure) div 100").cast("string"), F.lit("."),
                 F.lpad((cents % 100).cast("string"), 2, "0")))
    internet = _pick(F.expr("(id div 11) % 3"), INTERNET_LABELS)
    cols = [
        F.concat(F.lit("C"), id_.cast("string")).alias("customer_id"),
        F.when(id_ % 2 == 0, F.lit("Female")).otherwise(F.lit("Male")).alias("gender"),
        F.when(F.expr("(id div 7) % 6") == 0, 1).otherwise(0).cast("int").alias("senior_citizen"),
        _yes_no(F.expr("(id div 2) % 2") == 1).alias("partner"),
        _yes_no(F.expr("(id div 13) % 3") == 0).alias("dependents"),
        F.col("tenure"),
        F.lit("Yes").alias("phone_service"),
        _pick(F.expr("(id div 17) % 3"), MULTILINE_LABELS).alias("multiple_lines"),
        internet.alias("internet_service"),
    ]
    for name, k in zip(ONLINE_SERVICES, ONLINE_DIVISORS):
        cols.append(F.when(F.expr("(id div 11) % 3") == 2, F.lit("No internet service"))
                    .otherwise(_yes_no(F.expr(f"(id div {k}) % 2") == 1)).alias(name))
    cols += [
        _pick(id_ % 3, CONTRACT_LABELS).alias("contract"),
        _yes_no(F.expr("(id div 5) % 2") == 1).alias("paperless_billing"),
        _pick(F.expr("(id div 3) % 4"), PAYMENT_LABELS).alias("payment_method"),
        (F.col("mc") / F.lit(100.0)).alias("monthly_charges"),
        total_txt.alias("total_charges"),
        _yes_no(F.col("last_order").isNull()
                | (F.datediff(F.lit(CHURN_REFERENCE_DATE).cast("date"), F.col("last_order"))
                   > CHURN_GAP_DAYS)).alias("churn"),
    ]
    return df.select(*cols)


def ab_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A/B outcome table (FIXTURES.md §5) from the bridged customers: the
    uplift features, a deterministic treatment arm, the fixed logistic
    scores as base/final probabilities, the observed churn label and a
    week number 1-8 for the weekly variant."""
    from ..functions.encode import encode_customers
    from ..functions.features import derive_features, round_half_even
    from ..functions.rules import segment_absolute
    from ..functions.scoring import retention_scores

    feats = derive_features(encode_customers(customers_raw(spark, sf_dir), "etl"), "etl",
                            with_high_value=False)
    s = retention_scores(feats)
    num = F.expr("CAST(substring(customerID, 2) AS BIGINT)")
    treated = F.expr("((CAST(substring(customerID, 2) AS BIGINT) * 7919) div 10) % 2").cast("int")
    return s.select(
        F.col("customerID").alias("user_id"),
        F.col("tenure"),
        F.col("MonthlyCharges").alias("monthly_charges"),
        F.col("Contract_encoded").alias("contract_type"),
        F.col("service_count"),
        F.col("clv_proxy"),
        F.col("SeniorCitizen").alias("senior_citizen"),
        F.col("Partner").alias("has_partner"),
        F.col("digital_engagement"),
        segment_absolute(F.col("uplift_score"), F.col("churn_probability")).alias("segment_true"),
        treated.alias("treated"),
        F.col("p_control").alias("base_churn_prob"),
        F.when(treated == 1, F.col("p_treated")).otherwise(F.col("p_control")).alias("final_churn_prob"),
        F.col("Churn_binary").alias("churned"),
        (num % 8 + 1).cast("int").alias("week"),
        # uplift score of the same scorer, 4 decimals as in the score file
        round_half_even(F.col("uplift_score"), 4).alias("uplift_score"),
    )
