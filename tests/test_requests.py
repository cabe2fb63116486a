"""Request-table scoring, mirroring the reference's API behaviour tests
(FIXTURES.md §1–§2): risky > 0.5, loyal < risky, missing field rejected,
segment / priority values from the allowed sets."""

from pyspark.sql import functions as F

from retainspark.functions.features import FEATURE_COLS
from retainspark.plans.requests import predict, segment, validate_requests

RISKY = dict(tenure=3, SeniorCitizen=0, MonthlyCharges=95.0, TotalCharges=285.0, Partner=0, Dependents=0,
             PhoneService=1, PaperlessBilling=1, MultipleLines=0, OnlineSecurity=0, OnlineBackup=0,
             DeviceProtection=0, TechSupport=0, StreamingTV=0, StreamingMovies=0, Contract_encoded=0,
             InternetService_encoded=2, PaymentMethod_encoded=0, recency_risk=0.25, service_count=3,
             monetary_value=285.0, monthly_to_total_ratio=0.33, charge_per_month=31.0, clv_proxy=213.75,
             is_high_value=0, contract_stability=0, digital_engagement=1)
LOYAL = dict(RISKY, tenure=60, MonthlyCharges=45.0, TotalCharges=2700.0, Partner=1, Dependents=1,
             Contract_encoded=2, InternetService_encoded=1, PaymentMethod_encoded=2, recency_risk=0.016,
             service_count=7, monetary_value=2700.0, monthly_to_total_ratio=0.0166, charge_per_month=0.74,
             clv_proxy=2655.6, is_high_value=1, contract_stability=120, digital_engagement=2)


def _requests(spark, rows):
    schema = "request_id string, " + ", ".join(f"{c} double" for c in FEATURE_COLS)
    return spark.createDataFrame([(rid, *[None if r.get(c) is None else float(r[c]) for c in FEATURE_COLS])
                                  for rid, r in rows], schema)


def test_predict_risky_and_loyal(spark):
    out = {r.request_id: r for r in predict(_requests(spark, [("risky", RISKY), ("loyal", LOYAL)]), 0.5).collect()}
    assert out["risky"].churn_probability > 0.5
    assert out["loyal"].churn_probability < out["risky"].churn_probability
    assert {r.churn_predicted for r in out.values()} <= {0, 1}
    assert all(0 <= r.churn_probability <= 1 for r in out.values())


def test_missing_field_rejected(spark):
    bad = dict(RISKY, tenure=None)
    valid, rejected = validate_requests(_requests(spark, [("ok", RISKY), ("bad", bad)]))
    assert [r.request_id for r in valid.collect()] == ["ok"]
    rej = rejected.collect()
    assert [r.request_id for r in rej] == ["bad"] and rej[0].missing_fields == ["tenure"]


def test_segment_values(spark):
    out = segment(_requests(spark, [("risky", RISKY), ("loyal", LOYAL)])).collect()
    assert {r.segment for r in out} <= {"Persuadable", "Sleeping_Dog", "Lost_Cause", "Sure_Thing"}
    assert {r.priority for r in out} <= {"HIGH", "SUPPRESS", "LOW", "NONE"}
    for r in out:
        assert abs(r.uplift_score - (r.p_churn_no_action - r.p_churn_with_voucher)) < 2e-4


def test_validation_query_checks_every_required_field(spark, sf_dir, monkeypatch):
    from retainspark.plans import retention
    from retainspark.plans.queries_models import request_validation
    from retainspark.sources import bridge
    raw = bridge.customers_raw
    before = request_validation(spark, sf_dir).first()

    def broken(s, d):  # labels that no map has, in fields other than payment and internet service
        odd = F.conv(F.substring(F.md5(F.col("customer_id").cast("string")), 1, 1), 16, 10).cast("int")
        return (raw(s, d).withColumn("contract", F.when(odd < 4, "Weekly").otherwise(F.col("contract")))
                .withColumn("senior_citizen", F.when(odd == 15, None).otherwise(F.col("senior_citizen"))))

    monkeypatch.setattr(bridge, "customers_raw", broken)
    monkeypatch.setattr(retention, "customers_raw", broken)
    after = request_validation(spark, sf_dir).first()
    assert after.valid + after.rejected == before.valid + before.rejected
    want = retention.features_table(spark, sf_dir, "training").select(*FEATURE_COLS).na.drop().count()
    assert after.valid == want < before.valid
