"""Scoring and request payloads by fitted models (few rounds) against plain pandas."""
import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from retainspark.functions.features import FEATURE_COLS
from retainspark.functions.rules import segment_absolute
from retainspark.operators import models as ML
from retainspark.operators import profile as P
from retainspark.operators import survival as SV
from retainspark.plans.queries_models import UPLIFT_FEATURES
from retainspark.plans.queries_survival import SURV_COVARIATES
from retainspark.plans.requests import explain, predict_fitted
from retainspark.plans.retention import features_table, fitted_batch_scores, stored_threshold
from retainspark.session import stable
from retainspark.sources import io as IO
from retainspark.sources.bridge import ab_outcomes


@pytest.fixture(scope="module")
def fitted(spark, sf_dir):
    feats = stable(features_table(spark, sf_dir))
    model = ML.train_boosted(feats, FEATURE_COLS, "Churn_binary", weight=None, rounds=4)
    m0, m1 = ML.t_learner(ab_outcomes(spark, sf_dir), UPLIFT_FEATURES, "treated", "churned", rounds=3)
    fit = SV.cox_fit(feats, "tenure", "Churn_binary", SURV_COVARIATES, penalizer=0.1)
    return feats, model, m0, m1, fit


def test_threshold_is_the_stored_one(spark, tmp_path):
    path = str(tmp_path / "config")
    assert stored_threshold(spark, path) == 0.5 and stored_threshold(spark, path, 0.3) == 0.3
    IO.write_summary(spark.createDataFrame([(0.42,)], "churn_threshold double"), path)
    assert stored_threshold(spark, path) == 0.42
    IO.write_summary(spark.createDataFrame([(1,)], "other int"), path)
    assert stored_threshold(spark, path) == 0.5


def test_batch_scores_by_the_fitted_models(spark, fitted):
    feats, model, m0, m1, fit = fitted
    got = fitted_batch_scores(feats, model, 0.4, m0, m1, fit, F.lit("2024-01-01").cast("timestamp"))
    assert "scored_at" in got.columns and got.count() == feats.count()
    renamed = feats.withColumns({"monthly_charges": F.col("MonthlyCharges"), "contract_type": F.col("Contract_encoded"),
                                 "senior_citizen": F.col("SeniorCitizen"), "has_partner": F.col("Partner")})
    p, c, t = model.probability(), m0.probability(), m1.probability()
    want = renamed.select(F.col("customerID").alias("id"), p.alias("p"), (c - t).alias("u"), segment_absolute(c - t, p).alias("seg"))
    life = SV.expected_remaining(feats, fit).select(F.col("customerID").alias("id"), F.col("expected_tenure_remaining").alias("rem"))
    rows = got.join(want, F.col("user_id") == F.col("id")).drop("id").join(life, F.col("user_id") == F.col("id")).toPandas()
    assert len(rows) == feats.count()
    assert np.allclose(rows.churn_probability, rows.p.round(4), atol=1e-9) and np.allclose(rows.uplift_score, rows.u.round(4), atol=1e-9)
    assert (rows.churn_predicted == (rows.p >= 0.4)).all() and (rows.segment == rows.seg).all()
    assert np.allclose(rows.expected_tenure_remaining, rows.rem) and (rows.rem >= 0).all()
    assert fitted_batch_scores(feats, model, 0.4, m0, m1).where("expected_tenure_remaining <> -1").count() == 0
    assert P.score_audit(got).first()["last_scored_at"].year == 2024


def test_predict_has_a_falling_survival_block(spark, fitted):
    feats, model, _, _, fit = fitted
    req = feats.withColumnRenamed("customerID", "request_id")
    gap = req.limit(1).withColumns({"request_id": F.lit("gap"), "MonthlyCharges": F.lit(None).cast("double")})
    rows = predict_fitted(req.unionByName(gap), model, 0.61234, fit).toPandas().set_index("request_id")
    broken = rows.loc["gap"]
    assert broken[["p_active_7d", "p_active_30d", "p_active_90d"]].isna().all() and 0 <= broken.churn_probability <= 1
    rows = rows.drop("gap")
    assert (rows.threshold_used == 0.6123).all() and len(rows) == feats.count()
    assert ((rows.p_active_7d >= rows.p_active_30d) & (rows.p_active_30d >= rows.p_active_90d)).all()
    assert rows[["p_active_7d", "p_active_90d"]].stack().between(0, 1).all()


def test_explanations_add_up_and_are_ordered(spark, fitted):
    feats, model, _, _, _ = fitted
    req = feats.withColumnRenamed("customerID", "request_id")
    every = explain(req, model, k=len(FEATURE_COLS)).toPandas().set_index("request_id")
    p = ML.score(model, req).select("request_id", "churn_probability").toPandas().set_index("request_id").churn_probability
    for rid, r in every.iterrows():
        parts = json.loads(r.top_churn_drivers)
        assert list(parts.values()) == sorted(parts.values(), reverse=True) and len(parts) == len(FEATURE_COLS)
        assert r.base_value + sum(parts.values()) == pytest.approx(np.log(p[rid] / (1 - p[rid])), abs=27 * 5e-5 + 1e-9)
    five = explain(req, model).toPandas().set_index("request_id")
    for rid, r in five.iterrows():
        low, all_ = list(json.loads(r.top_churn_protectors).values()), sorted(json.loads(every.loc[rid].top_churn_drivers).values())
        assert low == all_[:5] and list(json.loads(r.top_churn_drivers).values()) == all_[::-1][:5]


def test_features_of_the_model_queries_are_derived_once(spark, sf_dir):
    # before, split, weights, folds and scores each read and joined the tables anew
    from retainspark.plans import queries_models as QM
    feats = QM._features(spark, sf_dir)
    assert feats is QM._features(spark, sf_dir) and feats.count() == features_table(spark, sf_dir).count()
    plan = feats._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "parquet" not in plan
