"""Counts, landing, bucketed tables, one-scan reports, streams, many labels."""

import datetime as dt
import os
import re
import tempfile
import uuid

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from conftest import SMALL
from giftlens.config import AnalysisParams, ColumnMap, ModelParams, Settings
from giftlens.operators import cleaning, donors, models, quality, reports, rfm
from giftlens.plans import catalog, outputs, run
from giftlens.sources import extract, fixtures
from giftlens.sources.readers import write_gifts_csv
from giftlens.streaming import trends

C = ColumnMap()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_run_from_files(spark):
    """Raw CSV receipts are landed as they are, then everything follows."""
    base = tempfile.mkdtemp(prefix="giftlens-files-")
    write_gifts_csv(fixtures.dirty_gifts(spark, SMALL), f"{base}/csv")
    res = run.run_files(spark, f"{base}/csv", f"{base}/out", Settings(analysis=AnalysisParams(year_cutoff=1990)), train_models=False)
    landed = spark.read.parquet(f"{base}/out/landing")
    assert set(landed.dtypes) == {(c, "string") for c in landed.columns}
    want = cleaning.preprocess_stats(catalog.typed_dirty(spark, SMALL), C).first()
    assert landed.count() == want.rows_before == res.counts["rows_before"]
    assert res.counts["rows_after"] == want.rows_after == spark.read.parquet(f"{base}/out/runs").first().records_processed
    raw = cleaning.null_tokens(fixtures.dirty_gifts(spark, SMALL))
    assert res.counts["lost_Date"] == cleaning.date_parse_loss(raw, C).where("column = 'Date'").first().lost > 0
    made = os.listdir(f"{base}/out/reports/run_date={dt.date.today().isoformat()}")
    assert {"trend_year", "dist_gender", "rfm_table"} <= set(made)


def test_reports_of_the_run_equal_the_single_ones(spark):
    gifts = cleaning.preprocess(fixtures.gifts(spark, SMALL), C)
    out = run.build_reports(gifts, Settings(analysis=AnalysisParams(major_gift_threshold=450_000.0, top_n_categories=4)))
    for name, one in (("dist_gender", reports.distribution(gifts, "Gender", 4, C)), ("dist_suburb", reports.distribution(gifts, "Suburb", 4, C)),
                      ("appeal_performance", reports.appeal_performance(gifts, C)), ("fund_performance", reports.fund_performance(gifts, C))):
        assert out[name].columns == one.columns
        assert [tuple(r) for r in out[name].collect()] == [tuple(r) for r in one.collect()]


def test_category_reports_scan_once(spark):
    p = plan(catalog.queries()["category_reports"](spark, SMALL))
    assert len(re.findall(r"FileScan parquet \[[^\]]*o_totalprice", p)) == 1


def test_category_reports_awkward_rows(spark):
    rows = [(1, "a", 5.0, None, "x"), (2, None, 7.0, "F", "x"), (3, "b", None, "F", None), (4, "b", 1.0, "", "y")]
    df = spark.createDataFrame(rows, "ReceiptSeq long, ID string, Amount double, Gender string, Appeal string")
    for col in ("Gender", "Appeal"):
        got = reports.category_reports(df, ["Gender", "Appeal", "Nowhere"], None, C).where(F.col("report") == col).drop("report")
        want = reports.distribution(df, col, None, C)
        assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]
    assert reports.category_reports(df.limit(0), ["Gender"], {"Gender": 1}, C).collect() == []


def test_bucketed_table_needs_no_shuffle_by_donor(spark):
    gifts = catalog.core_gifts(spark, SMALL)
    path = tempfile.mkdtemp(prefix="giftlens-buckets-") + "/t"
    table = outputs.write_cleaned_by_donor(gifts, f"cleaned_{uuid.uuid4().hex}", path, 4, C)
    for make in (lambda g: rfm.rfm_metrics(g, C), lambda g: donors.donor_summary(g, C)):
        assert "hashpartitioning(ID" in plan(make(gifts)) and "hashpartitioning(ID" not in plan(make(table))
        assert sorted(map(str, make(gifts).collect())) == sorted(map(str, make(table).collect()))


@pytest.mark.parametrize("missing", ["Date", "ID", "Amount"])
def test_a_missing_required_column_is_named(spark, missing):
    df = fixtures.gifts(spark, SMALL).drop(missing)
    with pytest.raises(quality.ValidationError, match=missing):
        quality.require_columns(df, C)
    with pytest.raises(quality.ValidationError, match=missing):
        quality.validate(df, C)


def test_wide_extract_has_its_43_typed_columns(spark):
    noon = dt.datetime(2020, 5, 4, 12, 30)
    receipts = {c: "r" + c for c in extract.RECEIPT_COLUMNS} | {"ReceiptSeq": 1, "ID": "d1", "Date": noon, "Appeal": "A", "Fund": "F",
                                                                 "Amount": 9.5, "HoldPledgeInstalmentNextDate": noon}
    attributes = {c: "a" + c for c in extract.ATTRIBUTE_COLUMNS} | {"ID": "d1", "BirthDate": noon}
    appeals = {"Code": "A", "Description": "spring", "ActiveFlag": "Y", "ModifiedDate": noon}
    funds = {"Code": "F", "Description": "roof", "TaxDeductableFlag": "Y", "ActiveFlag": "N"}
    rows = [receipts, receipts | {"ReceiptSeq": 2, "ID": "d2", "Appeal": "?", "Fund": None}]
    make = lambda rows: spark.createDataFrame([tuple(r.values()) for r in rows], list(rows[0]))
    out = extract.extract_wide(make(rows), make([attributes]), make([appeals]), make([funds]))
    want = [*extract.RECEIPT_COLUMNS, *extract.ATTRIBUTE_COLUMNS, "AppealCode", "AppealDescription", "AppealActiveFlag",
            "AppealModifiedDate", "FundCode", "FundDescription", "FundTaxDeductableFlag", "FundActiveFlag"]
    assert out.columns == want and len(want) == 43
    one, two = sorted(out.collect(), key=lambda r: r.ReceiptSeq)
    day = dt.datetime(2020, 5, 4)
    assert [one[c] for c in extract.DATE_COLUMNS] == [day] * 4
    assert (one.AppealDescription, one.FundActiveFlag, one.FundTaxDeductableFlag, one.Suburb) == ("spring", "N", "Y", "aSuburb")
    for c in want:
        held = c in extract.RECEIPT_COLUMNS
        assert (two[c] is not None) == (held and c != "Fund"), c


def test_stream_trend_keeps_months_exact_over_restarts(spark):
    rng = np.random.default_rng(3)
    base = tempfile.mkdtemp(prefix="giftlens-trend-")
    rows = [(int(i), f"d{rng.integers(3000)}", dt.datetime(2021, 1, 1) + dt.timedelta(days=int(rng.integers(150))), float(rng.integers(1, 500)))
            for i in range(6000)] + [(9999, "x", None, 5.0)]
    gifts = spark.createDataFrame(rows, "ReceiptSeq long, ID string, Date timestamp_ntz, Amount double")
    for part in (gifts.where("ReceiptSeq < 2500"), gifts.where("ReceiptSeq >= 2500")):
        part.write.mode("append").parquet(f"{base}/landing")
        stream = spark.readStream.schema(gifts.schema).option("maxFilesPerTrigger", 2).parquet(f"{base}/landing")
        trends.run_month_trend(stream, f"{base}/months", f"{base}/checkpoint", "400 days", C)
    got = {r.Month: r for r in trends.read_month_trend(spark, f"{base}/months").collect()}
    want = {r.Month: r for r in reports.trend_month(gifts, C).collect()}
    assert got.keys() == want.keys()
    for m, r in want.items():
        assert (got[m].total_amount, got[m].donation_count, got[m].avg_amount_per_donation) == (
            r.total_amount, r.donation_count, r.avg_amount_per_donation)
        assert abs(got[m].donors_estimate - r.donors) <= 4 * trends.standard_error() * r.donors


def test_hundred_thousand_labels_stay_bounded(spark):
    """A category with 100,000 labels takes ``max_labels`` slots and its importance is one field's."""
    p = ModelParams(max_labels=64, rf_n_estimators=3, rf_max_depth=3)
    i = F.col("id")
    panel = spark.range(120_000).select(
        i.cast("string").alias("ID"), F.timestamp_add("MONTH", (i % 6).cast("int"), F.lit("2015-01-31").cast("timestamp_ntz")).alias("CutoffDate"),
        (i % 50).cast("double").alias("Recency"), (i % 7).cast("double").alias("Frequency"), F.lit(1.0).alias("Monetary"),
        F.lit(1.0).alias("AvgAmount"), F.lit(1.0).alias("LastAmount"), F.concat(F.lit("s"), (i % 100_000).cast("string")).alias("State"),
        F.when(i % 2 == 0, "F").otherwise("M").alias("Gender"), (i % 50 < 20).cast("int").alias("ReDonate"))
    cats = models.categorical_features(panel, C)
    assert models.many_labels(panel, cats, p) == ["State"]
    t = models.train_propensity(panel, "ReDonate", C, AnalysisParams(), p, algorithms=("RandomForest",))
    indexer = next(s for s in t.models["RandomForest"].stages if hasattr(s, "labelsArray"))
    assert [len(x) for x in indexer.labelsArray] == [2, 64]
    imp = {r.field: r.importance for r in t.importance["RandomForest"].collect()}
    assert sum(imp.values()) == pytest.approx(1.0) and "State" in imp
    assert imp["Recency"] > max(imp["Frequency"], imp["Gender"])        # a few of 71 slots are tried at each node
    assert t.comparison.first().auc > 0.6


def _planted(spark, n=6000):
    """A panel whose labels follow from its features, with noise."""
    rng = np.random.default_rng(8)
    rows = []
    for i in range(n):
        recency, gender = float(rng.integers(0, 1000)), "FM"[rng.integers(2)]
        p = 1 / (1 + np.exp((recency - 500) / 60 - (1.5 if gender == "F" else -1.5)))
        state = "ABC"[rng.integers(3)]
        rows.append((f"d{i}", dt.datetime(2015, 1, 31) + dt.timedelta(days=int(rng.integers(8)) * 182), recency, float(rng.integers(1, 20)), 100.0, 10.0,
                     float(rng.integers(1, 500)), gender, state, int(rng.random() < p), float(recency / 10 + rng.normal(0, 8) + 30),
                     state + ("x" if recency < 500 else "y") if rng.random() < 0.9 else "Ax", float(3 * (recency % 97) + rng.normal(0, 10))))
    return spark.createDataFrame(rows, "ID string, CutoffDate timestamp_ntz, Recency double, Frequency double, Monetary double, AvgAmount double, "
                                       "LastAmount double, Gender string, State string, ReDonate int, DaysToNext double, TargetCategory string, "
                                       "FutureMedianAmount double")


SMALL_TREES = ModelParams(rf_n_estimators=20, gbt_n_estimators=20, gbt_learning_rate=0.2, time_rf_n_estimators=20, amount_rf_n_estimators=20,
                          preference_n_estimators=20, rf_max_depth=7)


def test_classifiers_find_a_planted_signal(spark):
    t = models.train_propensity(_planted(spark).drop("DaysToNext", "TargetCategory", "FutureMedianAmount"), "ReDonate", C, AnalysisParams(), SMALL_TREES)
    got = {r.model: r for r in t.comparison.collect()}
    assert set(got) == {"LogisticRegression", "RandomForest", "GBT"}
    assert all(r.auc > 0.93 and r.f1 > 0.83 for r in got.values()), got
    assert [r.auc for r in t.comparison.collect()] == sorted((r.auc for r in got.values()), reverse=True)
    for imp in t.importance.values():
        by = {r.field: r.importance for r in imp.collect()}
        assert sum(by.values()) == pytest.approx(1.0) and by["Recency"] > 0.5 > by["Gender"] > by["State"]


def test_regressors_find_a_planted_signal(spark):
    base = _planted(spark)
    time = models.train_time(base.drop("ReDonate", "TargetCategory", "FutureMedianAmount"), C, AnalysisParams(), SMALL_TREES)
    r = time.metrics.first()
    assert r.R2 > 0.85 and r.MAE < 9 and abs(r.mean_actual - r.mean_predicted) < 2
    assert abs(time.residuals.agg(F.avg("residual")).first()[0]) < 2
    simple = base.drop("ReDonate", "TargetCategory", "DaysToNext", "CutoffDate").withColumn("FutureMedianAmount", F.col("LastAmount") * 2 + F.col("Frequency"))
    r = models.train_amount(simple, C, AnalysisParams(), SMALL_TREES).metrics.first()
    assert r.R2 > 0.95


def test_preference_finds_a_planted_signal(spark):
    data = _planted(spark).drop("ReDonate", "DaysToNext", "FutureMedianAmount")
    boosted = models.train_preference(data, "fund", C, AnalysisParams(), SMALL_TREES.with_(gbt_n_estimators=8), algorithm="GBT")
    r = boosted.metrics.first()
    assert (r.model, r.n_classes) == ("GBT", 6) and r.accuracy > 0.8 and r.macro_f1 > 0.8
    path = tempfile.mkdtemp(prefix="giftlens-boosted-") + "/m"
    outputs.save_model(boosted.model, path)
    scored = models.model_matrix(data.limit(50), models.categorical_features(data, C), fill="")
    kept = [m.transform(scored).select("pref_probability").collect() for m in (boosted.model, PipelineModel.load(path))]
    assert kept[0] == kept[1] and all(sum(x[0]) == pytest.approx(1.0) for x in kept[0])
    t = models.train_preference(data, "fund", C, AnalysisParams(), SMALL_TREES)
    r = t.metrics.first()
    assert r.n_classes == 6 and t.classes == ["Ax", "Ay", "Bx", "By", "Cx", "Cy"]
    assert r.accuracy > 0.8 and r.macro_f1 > 0.8                    # the largest class holds about a quarter
