"""End-to-end job on the smallest fixture, with a tiny tree budget."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from giftlens.config import AnalysisParams, ModelParams, Settings
from giftlens.operators import reports
from giftlens.plans import catalog, run
from giftlens.sources import fixtures

from conftest import SMALL


def test_full_run(spark):
    out = tempfile.mkdtemp(prefix="giftlens-run-")
    s = Settings(analysis=AnalysisParams(major_gift_threshold=450_000.0, year_cutoff=1995,
                                         min_panel_start=dt.datetime(1996, 1, 1)),
                 models=ModelParams(rf_n_estimators=5, gbt_n_estimators=5, time_rf_n_estimators=5,
                                    amount_rf_n_estimators=5, preference_n_estimators=5, lr_max_iter=50,
                                    rf_max_depth=4))
    res = run.run(spark, fixtures.gifts(spark, SMALL), out, s)
    assert "prospecting_playbook" in res.reports
    book = spark.read.parquet(f"{out}/reports/run_date={dt.date.today().isoformat()}/prospecting_playbook")
    assert book.count() == fixtures.gifts(spark, SMALL).select("ID").distinct().count()
    man = spark.read.parquet(f"{out}/manifest").orderBy("position").collect()
    assert man[0]["source"] == "prospecting_playbook"
    assert os.path.isdir(f"{out}/models/amount")
    assert spark.read.parquet(f"{out}/runs").count() == 1


def test_relationship_by_age_group(spark):
    rows = [("a", 10.0, 1, 0, 0, 0, "30-39"), ("b", 20.0, 1, 0, 0, 0, "30-39"), ("a", 5.0, 0, 1, 0, 0, "40-49")]
    df = spark.createDataFrame(rows, "ID string, Amount double, CurrentParent int, PastParent int, "
                                     "PastStudent int, FutureParent int, AgeGroupAtDonation string")
    t = {(r["CurrentParent"], r["AgeGroupAtDonation"]): r for r in reports.relationship_by_group(df).collect()}
    assert t[(1, "30-39")]["donor_count"] == 2 and t[(1, "30-39")]["avg_amount_per_donor"] == 15.0
    d = reports.distribution(df.withColumnRenamed("AgeGroupAtDonation", "AgeGroup"), "AgeGroup")
    assert [r["AgeGroup"] for r in d.collect()] == ["30-39", "40-49"]


def test_model_roundtrip_and_probabilities(spark):
    p = catalog.q_panel_redonate(spark, SMALL)
    t = __import__("giftlens.operators.models", fromlist=["x"]).train_propensity(
        p, "ReDonate", catalog.C, catalog.FIXTURE_PARAMS.with_(min_samples_for_training=10),
        ModelParams(rf_n_estimators=5, rf_max_depth=4), algorithms=("RandomForest",))
    m = t.models["RandomForest"]
    path = tempfile.mkdtemp(prefix="giftlens-model-") + "/rf"
    m.write().overwrite().save(path)
    from pyspark.ml import PipelineModel
    from giftlens.operators.models import categorical_features, model_matrix
    mm = model_matrix(p, categorical_features(p)).withColumn("ReDonate", F.col("ReDonate").cast("double"))
    a = m.transform(mm).select("prop_prediction").collect()
    b = PipelineModel.load(path).transform(mm).select("prop_prediction").collect()
    assert a == b
    auc = t.comparison.first()["auc"]
    assert auc is None or 0.0 <= auc <= 1.0


def _short_run(spark, gifts):
    out = tempfile.mkdtemp(prefix="giftlens-run-")
    small = ModelParams(rf_n_estimators=2, gbt_n_estimators=2, time_rf_n_estimators=2, amount_rf_n_estimators=2,
                        preference_n_estimators=2, lr_max_iter=5, rf_max_depth=2)
    return out, run.run(spark, gifts, out, Settings(analysis=AnalysisParams(year_cutoff=1990), models=small))


def test_short_history_keeps_reports(spark):
    day = dt.datetime(2020, 1, 1)
    rows = [(i, f"d{i % 20}", day + dt.timedelta(days=i % 300), 10.0 + i % 7) for i in range(600)]
    out, res = _short_run(spark, spark.createDataFrame(
        rows, "ReceiptSeq long, ID string, Date timestamp_ntz, Amount double"))
    assert set(res.skipped) == {"propensity", "major_gift", "amount", "time", "preference"}
    assert not res.metrics
    made = os.listdir(f"{out}/reports/run_date={dt.date.today().isoformat()}")
    assert {"trend_year", "rfm_table", "prospecting_playbook"} <= set(made)


def test_appeals_only_are_called_appeals(spark):
    day = dt.datetime(2012, 1, 1)
    rows = [(i, f"d{i % 40}", day + dt.timedelta(days=(i * 13) % 2900), 10.0 + i % 7, "AB"[i // 3 % 2])
            for i in range(1200)]
    out, res = _short_run(spark, spark.createDataFrame(
        rows, "ReceiptSeq long, ID string, Date timestamp_ntz, Amount double, Appeal string"))
    book = res.reports["prospecting_playbook"].columns
    assert "top1_appeal" in book and "top1_fund" not in book
    made = set(os.listdir(f"{out}/metrics"))
    assert {"propensity_LogisticRegression_metrics.json", "preference_metrics.json"} <= made
