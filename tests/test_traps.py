"""Hand-built micro-frames for the semantic traps."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from giftlens.config import AnalysisParams, ColumnMap
from giftlens.functions.expr import elapsed_days, parse_flag, strict_double
from giftlens.operators import cleaning, donors, metrics, panel, playbook, reports, rfm, splits

C = ColumnMap()
D = dt.datetime


def gifts(spark, rows):
    return spark.createDataFrame(rows, "ReceiptSeq long, ID string, Date timestamp_ntz, Amount double")


def test_x1_x2_strict_numbers(spark):
    df = spark.createDataFrame([("12d",), ("NaN",), ("1,000",), (" 12.5 ",), ("1e3",), (None,), ("-5",)], "a string")
    got = [r[0] for r in df.select(strict_double(F.col("a"))).collect()]
    assert got == [None, None, None, 12.5, 1000.0, None, -5.0]


def test_x2_nan_dropped_by_positive_filter(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 3.0), (3, None), (4, 0.0)], "ReceiptSeq long, Amount double")
    assert [r[0] for r in cleaning.positive_amounts(df, C).collect()] == [2]


def test_x3_elapsed_days_counts_time_of_day(spark):
    df = spark.createDataFrame([(D(2024, 1, 1, 23, 0), D(2024, 1, 3, 6, 0))], "a timestamp_ntz, b timestamp_ntz")
    r = df.select(elapsed_days(F.col("a"), F.col("b")).alias("e"), F.datediff(F.col("b"), F.col("a")).alias("c")).first()
    assert (r["e"], r["c"]) == (1, 2)


def test_x4_last_amount_ties_follow_input_order(spark):
    rows = [(1, "a", D(2020, 1, 1), 10.0), (2, "a", D(2020, 5, 1), 20.0), (3, "a", D(2020, 5, 1), 30.0)]
    out = rfm.rfm_metrics(gifts(spark, rows), C).first()
    assert out["LastAmount"] == 30.0
    rows = [(3, "a", D(2020, 5, 1), 20.0), (2, "a", D(2020, 5, 1), 30.0)]
    assert rfm.rfm_metrics(gifts(spark, rows), C).first()["LastAmount"] == 20.0


def test_x5_duplicate_edges_still_score(spark):
    rows = [(i, f"d{i}", D(2020, 1, 1 + i), 100.0) for i in range(8)]
    rows += [(10, "d8", D(2020, 2, 1), 50.0), (11, "d8", D(2020, 3, 1), 60.0),
             (12, "d9", D(2020, 2, 1), 70.0), (13, "d9", D(2020, 4, 1), 80.0)]
    t = rfm.rfm_table(gifts(spark, rows), C).collect()
    assert len(t) == 10
    assert all(1 <= r["F_score"] <= 5 and 3 <= r["RFM_Score"] <= 15 for r in t)
    assert {r["F_score"] for r in t if r["Frequency"] == 1} == {1}


def test_x6_flags(spark):
    df = spark.createDataFrame([("2",), ("2.7",), ("maybe",), (None,), (" Yes ",), ("f",), ("1.0",)], "f string")
    assert [r[0] for r in df.select(parse_flag(F.col("f"))).collect()] == [2, 2, 0, 0, 1, 0, 1]


def test_x7_null_keys_dropped_in_distribution(spark):
    df = spark.createDataFrame([("a", 1.0, "x"), ("b", 2.0, None)], "ID string, Amount double, Gender string")
    assert [r["Gender"] for r in reports.distribution(df, "Gender", 50, C).collect()] == ["x"]


def test_x8_growth_against_previous_present_year(spark):
    rows = [(1, "a", D(1999, 3, 1), 100.0), (2, "a", D(2001, 3, 1), 150.0)]
    t = {r["Year"]: r for r in reports.trend_year(gifts(spark, rows), C).collect()}
    assert t[1999]["YoY_total_growth_%"] is None
    assert t[2001]["YoY_total_growth_%"] == pytest.approx(50.0)


def test_x9_recency_at_least_one(spark):
    rows = [(1, "a", D(2020, 1, 1), 1.0), (2, "b", D(2020, 6, 1), 1.0)]
    assert min(r["Recency"] for r in rfm.rfm_metrics(gifts(spark, rows), C).collect()) == 1


def test_x10_demographics_latest_over_all_data(spark):
    rows = [(1, "a", D(2020, 1, 1), 5.0, "F"), (2, "a", D(2021, 1, 1), 5.0, "M")]
    df = spark.createDataFrame(rows, "ReceiptSeq long, ID string, Date timestamp_ntz, Amount double, Gender string")
    f = panel.donor_features_asof(df, F.lit(D(2020, 6, 1)).cast("timestamp_ntz"), C).first()
    assert f["Gender"] == "M" and f["Frequency"] == 1


def _panel_rows():
    # cutoffs for start 2019-01-01 (min + 365d) are 2019-03-31, 2019-09-30, ...
    return [(1, "a", D(2018, 1, 1), 10.0), (2, "a", D(2019, 3, 31), 20.0),       # on the cutoff
            (3, "a", D(2020, 3, 30), 1500.0),                                      # cutoff + 365d
            (4, "b", D(2019, 3, 31, 12), 5.0), (5, "b", D(2021, 6, 1), 5.0)]


def test_panel_bounds(spark):
    p = AnalysisParams(major_gift_threshold=1000.0)
    t = {(r["ID"], r["CutoffDate"]): r for r in
         panel.build_panel(gifts(spark, _panel_rows()), "redonate", C, p).collect()}
    a0 = t[("a", D(2019, 3, 31))]
    assert a0["Frequency"] == 2 and a0["Recency"] == 0 and a0["ReDonate"] == 1
    assert ("b", D(2019, 3, 31)) not in t              # gift at noon is after the cutoff
    m = {(r["ID"], r["CutoffDate"]): r["MajorGift"] for r in
         panel.build_panel(gifts(spark, _panel_rows()), "major", C, p).collect()}
    assert m[("a", D(2019, 3, 31))] == 1
    tt = {(r["ID"], r["CutoffDate"]): r["DaysToNext"] for r in
          panel.build_panel(gifts(spark, _panel_rows()), "time", C,
                            p.with_(min_panel_start=D(2019, 1, 1))).collect()}
    assert tt[("a", D(2019, 3, 31))] == 365


def test_panel_equals_naive_range_join(spark):
    rows = [(i, f"d{i % 7}", D(2015, 1, 1) + dt.timedelta(days=37 * i + (i % 3)), float(100 + i))
            for i in range(120)]
    g = gifts(spark, rows)
    p = AnalysisParams()
    fast = panel.build_panel(g, "redonate", C, p).select("ID", "CutoffDate", "Frequency", "Monetary",
                                                         "Recency", "LastAmount", "ReDonate")
    cuts = panel.panel_cutoffs(g, "redonate", C, p)
    j = g.join(cuts, g.Date <= cuts.CutoffDate)
    naive = j.groupBy("ID", "CutoffDate").agg(F.count(F.lit(1)).alias("Frequency"),
                                              F.sum("Amount").alias("Monetary"))
    fut = g.alias("f").join(cuts, (F.col("f.Date") > cuts.CutoffDate)
                            & (F.col("f.Date") <= cuts.CutoffDate + F.expr("INTERVAL 365 DAYS")))
    lab = fut.select("ID", "CutoffDate").distinct().withColumn("y", F.lit(1))
    naive = naive.join(lab, ["ID", "CutoffDate"], "left").fillna(0, ["y"])
    a = {(r["ID"], r["CutoffDate"]): (r["Frequency"], round(r["Monetary"], 2), r["ReDonate"]) for r in fast.collect()}
    b = {(r["ID"], r["CutoffDate"]): (r["Frequency"], round(r["Monetary"], 2), r["y"]) for r in naive.collect()}
    assert a == b and len(a) > 50


def test_x19_time_split_without_test_rows_raises(spark):
    df = spark.createDataFrame([("a", D(2020, 3, 31))] * 5, "ID string, CutoffDate timestamp_ntz")
    with pytest.raises(Exception):
        splits.time_split(df).collect()


def test_x20_single_class_auc_is_null(spark):
    df = spark.createDataFrame([(1, 1, 0.3), (1, 1, 0.8)], "label int, prediction int, probability double")
    assert metrics.classification_metrics(df).first()["auc"] is None


def test_auc_with_ties(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.9), (0, 0.1)], "label int, probability double")
    df = df.withColumn("prediction", (F.col("probability") > 0.5).cast("int"))
    assert metrics.classification_metrics(df).first()["auc"] == pytest.approx(0.875)


def test_w7_w9_scoring(spark):
    df = spark.createDataFrame([("a", 5.0, None, 0.9), ("b", 5.0, None, None)],
                               "ID string, pred_amount double, pred_days_to_next double, top1_prob double")
    r = {x["ID"]: x for x in playbook.priority_score(df).collect()}
    # constant amount -> 0.5; all-null days stay null -> priority null
    assert r["a"]["priority_score"] is None
    assert r["a"]["action_bucket"] == "Nurture"
    df2 = spark.createDataFrame([("a", 2000.0, 30.0, 0.8), ("b", 600.0, 100.0, 0.1), ("c", 1.0, 200.0, 0.1)],
                                "ID string, pred_amount double, pred_days_to_next double, top1_prob double")
    b = {x["ID"]: x["action_bucket"] for x in playbook.priority_score(df2).collect()}
    assert b == {"a": "VIP_target", "b": "Upgrade_push", "c": "Reactivation"}


def test_lists_use_summary_reference(spark):
    rows = [(1, "a", D(2020, 1, 1), 10.0), (2, "a", D(2021, 1, 1), 40.0), (3, "b", D(2021, 1, 2), 5.0)]
    s = donors.donor_summary(gifts(spark, rows), C)
    up = [r["ID"] for r in donors.upgrade_candidates(s).collect()]
    assert up == ["a"]
    nd = [r["ID"] for r in donors.new_donors(s).collect()]
    assert nd == ["b"]


def test_quality_report_raises_on_empty_and_no_dates(spark):
    from giftlens.operators import quality
    empty = spark.createDataFrame([], "ReceiptSeq long, ID string, Date timestamp_ntz, Amount double")
    with pytest.raises(Exception, match="empty"):
        quality.quality_report(empty, C).collect()
    nodate = spark.createDataFrame([(1, "a", None, 5.0)], "ReceiptSeq long, ID string, Date timestamp_ntz, Amount double")
    with pytest.raises(Exception, match="No valid dates"):
        quality.quality_report(nodate, C).collect()
    ok = spark.createDataFrame([(1, "a", D(2020, 1, 1), -5.0), (2, "b", D(2022, 1, 1), 0.0)],
                               "ReceiptSeq long, ID string, Date timestamp_ntz, Amount double")
    r = {x["check"]: x for x in quality.validate(ok, C).collect()}
    assert r["amount_negative"]["value"] == 1.0 and r["amount_zero"]["severity"] == "warning"
    assert r["date_span_years"]["severity"] == "ok"


def test_custom_label_next_gift_amount(spark):
    # a user label: amount of the first gift after the cutoff, any time later
    lab = panel.Label("NextAmount", lambda x: F.min_by(x.amount, x.key), "first",
                      lambda nxt, cut, hz: nxt, "inner", None, "redonate")
    rows = [(i, f"d{i % 4}", D(2015, 1, 1) + dt.timedelta(days=53 * i + i % 5), float(i)) for i in range(60)]
    g = gifts(spark, rows)
    got = {(r["ID"], r["CutoffDate"]): r["NextAmount"]
           for r in panel.build_panel(g, lab, C, AnalysisParams()).collect()}
    cuts = [r["CutoffDate"] for r in panel.panel_cutoffs(g, "redonate", C, AnalysisParams()).collect()]
    want = {}
    for c in cuts:
        for donor in {r[1] for r in rows}:
            mine = sorted((r[2], r[0], r[3]) for r in rows if r[1] == donor)
            if any(x[0] <= c for x in mine):
                later = [x for x in mine if x[0] > c]
                if later:
                    want[(donor, c)] = later[0][2]
    assert got == want and len(got) > 10


def test_shared_dir_when_unset():
    from giftlens.session import shared_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class SC:
        master = "local[2]"

        def __init__(self):
            self.dir = None

        def getCheckpointDir(self):
            return self.dir

        def setCheckpointDir(self, d):
            self.dir = d + "/ctx"

        def getConf(self):
            return Conf()

    class Session:
        conf = Conf()
        sparkContext = SC()

    s = Session()
    d = shared_dir(s)
    assert d.endswith("/ctx") and shared_dir(s) == d


# -- donors without attributes, money, ingest, appended files -------------------------

def _two_donors(spark):
    gifts = spark.createDataFrame([("1", dt.datetime(2020, 1, 2), 80.0), ("2", dt.datetime(2020, 3, 2), 150.0)],
                                  "ID string, Date timestamp_ntz, Amount double")
    attrs = spark.createDataFrame([("1", "F", 1, 0, 0, 0)], "ID string, Gender string, CurrentParent int, "
                                  "PastParent int, PastStudent int, FutureParent int")
    return gifts, attrs


def test_unmatched_donors_are_counted(spark):
    from giftlens.operators import reports
    gifts, attrs = _two_donors(spark)
    got = {r.Gender: r.total_amount for r in reports.attribute_distribution(gifts, attrs, "Gender").collect()}
    assert got == {"F": 80.0, "Missing": 150.0}
    assert sum(r.total_amount for r in reports.attribute_relationship_trend(gifts, attrs).collect()) == 230.0
    flags = {r.CurrentParent: r.total_amount for r in reports.attribute_relationship_summary(gifts, attrs).collect()}
    assert flags == {1: 80.0, 0: 150.0}


def test_money_keeps_fractions_and_large_amounts(spark):
    from giftlens.functions.agg import money_sum
    df = spark.createDataFrame([(10.004,), (10.004,), (0.004,)], "a double")
    assert df.agg(money_sum(df.a)).first()[0] == 20.012
    big = spark.createDataFrame([(1e16,), (1e17,)], "a double")
    assert big.agg(money_sum(big.a)).first()[0] == 1.1e17


def test_approximate_median_counts_gifts(spark):
    from giftlens.operators import reports
    gifts = spark.createDataFrame([("1", a) for a in (10.0, 20.0, 30.0, 30.0, 30.0, 30.0, 30.0)], "ID string, Amount double")
    _, attrs = _two_donors(spark)
    for exact in (True, False):
        assert reports.attribute_relationship_summary(gifts, attrs, exact=exact).first().median_amount == 30.0


def test_numbers_out_of_range(spark):
    from giftlens.functions.expr import parse_flag, strict_double
    df = spark.createDataFrame([("9999999999",), ("1e400",), ("2.7",)], "s string")
    rows = df.select(parse_flag(df.s).alias("f"), strict_double(df.s).alias("d")).collect()
    assert [r.f for r in rows] == [2**31 - 1, 0, 2] and rows[1].d is None


def test_dates_of_many_formats(spark):
    from giftlens.functions.expr import parse_timestamp
    texts = ["2020-01-02T03:04:05", "2020-01-02 03:04:05.123", "02/01/2020 13:45", "02-01-2020", "02.01.2020",
             "2 Jan 2020", "2/1/20", "2/1/2020 1:45 PM", "2/1/2020", "20200102"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    assert [r[0].date() for r in df.select(parse_timestamp(df.s)).collect()] == [dt.date(2020, 1, 2)] * len(texts)


def test_csv_keeps_quotes_and_line_breaks(spark, tmp_path):
    import pytest as _pytest
    from giftlens.sources.readers import read_gifts_csv
    (tmp_path / "a.csv").write_text('ID,Date,Comments\n1,2/1/2020,"He said ""hi, all"" ok"\n2,3/1/2020,"line1\nline2"\n')
    rows = {r.ID: r.Comments for r in read_gifts_csv(spark, str(tmp_path)).collect()}
    assert rows == {"1": 'He said "hi, all" ok', "2": "line1\nline2"}
    (tmp_path / "b.csv").write_text("Date,ID,Comments\n4/1/2020,3,x\n")
    with _pytest.raises(Exception):
        read_gifts_csv(spark, str(tmp_path)).collect()


def test_appended_files_are_read(spark, tmp_path):
    from giftlens.sources.tables import table
    spark.range(10).write.parquet(f"{tmp_path}/t.parquet")
    assert table(spark, str(tmp_path), "t").count() == 10
    spark.range(10).write.mode("append").parquet(f"{tmp_path}/t.parquet")
    assert table(spark, str(tmp_path), "t").count() == 20


def test_random_split_is_exact_and_stratified(spark):
    from giftlens.operators import splits
    rows = [(i, "a" if i < 6 else "b" if i < 106 else None) for i in range(113)]
    df = spark.createDataFrame(rows, "k int, c string")
    got = splits.random_split(df, 0.25, 7, key_cols=["k"], stratify_col="c").collect()
    assert sorted(r["k"] for r in got) == list(range(113))
    n = {c: sum(r["split"] == "test" for r in got if r["c"] == c) for c in ("a", "b", None)}
    assert sum(n.values()) == 29 and n["b"] in (25, 26) and n["a"] in (1, 2) and n[None] in (1, 2)
    plain = splits.random_split(df, 0.25, 7, key_cols=["k"]).where("split = 'test'").count()
    assert plain == 29
    # Ten classes are not strata, and a repeated key is still counted row by row.
    many = spark.createDataFrame([(i % 3, str(i % 12)) for i in range(40)], "k int, c string")
    assert splits.random_split(many, 0.25, 7, ["k"], "c").where("split = 'test'").count() == 10
    assert splits.random_split(df.limit(0), 0.25, 7, ["k"], "c").count() == 0


def test_time_split_without_time_column_is_random(spark):
    from giftlens.operators import splits
    df = spark.range(40).toDF("k")
    assert splits.time_split(df).where("split = 'test'").count() == 10
