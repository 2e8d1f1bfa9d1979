"""Exact quantiles, prefix sums and latest-by without sorted or one-task aggregates."""

import datetime as dt
import math
import random
import re
import struct

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SMALL
from giftlens.config import AnalysisParams, ColumnMap, InsufficientData
from giftlens.functions import quantiles as Q
from giftlens.functions.agg import last_by
from giftlens.operators import metrics, panel, rfm
from giftlens.plans import catalog

C = ColumnMap()
QS = [0.0, 0.2, 0.4, 0.5, 0.8, 1.0]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def bits(x: float) -> int:
    n = struct.unpack(">q", struct.pack(">d", abs(x)))[0]
    return -n if x < 0 else n


def test_keys_are_the_doubles_bits(spark):
    rng = random.Random(1)
    odd = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 1e-310, math.inf, -math.inf, 1.7976931348623157e308, 1.0, -1.0]
    powers = [2.0**e for e in range(-1074, 1024, 7)]
    near = [float(np.nextafter(p, to)) for p in powers for to in (0.0, math.inf)]
    values = odd + powers + near + [rng.gauss(0, 10.0**rng.randint(-300, 300)) for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for r in Q.keyed(df, F.col("v")).withColumn("back", Q.key_value("k")).collect():
        assert (r.k, r.back) == (bits(r.v), r.v)
    nothing = Q.keyed(spark.createDataFrame([(None,), (math.nan,)], "v double"), F.col("v"))
    assert [r.k for r in nothing.collect()] == [None, None]


def expected(values, q):
    v = sorted(x for x in values if x is not None and not math.isnan(x))
    if not v:
        return None
    at = (len(v) - 1) * q
    lo, part = v[math.floor(at)], at - math.floor(at)
    return round(lo if part == 0 else (1 - part) * lo + part * v[math.ceil(at)], 6)


def sample(rng, n):
    return [rng.choice([None, math.nan, 0.5, 0.5 + rng.random() * 1e-12, rng.uniform(-9, 9), float(rng.randint(0, 3))]) for _ in range(n)]


@pytest.mark.parametrize("n", [0, 1, 2, 900])
def test_quantiles_over_all_rows(spark, n):
    rng = random.Random(n)
    a, b = sample(rng, n), sample(rng, n)
    df = spark.createDataFrame(list(zip(a, b)), "a double, b double")
    got = spark.range(1).select(Q.quantiles(df, {"a": F.col("a"), "b": -F.col("b")}, QS).alias("q")).first().q
    for mine, values in ((got.a, a), (got.b, [None if x is None else -x for x in b])):
        assert mine == pytest.approx([expected(values, q) for q in QS], abs=1.1e-6) if any(
            x is not None and not math.isnan(x) for x in values) else mine == [None] * len(QS)


def test_grouped_quantiles_weights_and_null_groups(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["hot", "hot", None, "x", "y"]), v, rng.randint(0, 3)) for v in sample(rng, 1500)] + [("void", None, 1)]
    got = Q.grouped_quantiles(spark.createDataFrame(rows, "g string, v double, w int"), ["g"], F.col("v"), QS, F.col("w")).collect()
    groups = {}
    for g, v, w in rows:
        groups.setdefault(g, []).extend([v] * w)
    assert {r.g for r in got} == {"hot", "x", "y", None}
    for r in got:
        assert list(r)[1:] == pytest.approx([expected(groups[r.g], q) for q in QS], abs=1.1e-6)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=32), min_size=1, max_size=40))
def test_median_of_any_floats(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = Q.grouped_quantiles(df, [], F.col("v"), [0.5]).first().q0
    assert got == pytest.approx(expected(values, 0.5), rel=1e-12, abs=1.1e-6)


def test_hot_donors_future_median(spark):
    """One donor holds a third of all gifts, nearly all of different amounts."""
    rng = random.Random(9)
    rows = [(i, "hot" if i % 3 == 0 else f"d{i % 40}", dt.datetime(2019, 1, 1) + dt.timedelta(days=i % 1400), rng.randint(100, 10**7) / 100)
            for i in range(6000)]
    g = spark.createDataFrame(rows, "ReceiptSeq long, ID string, Date timestamp_ntz, Amount double")
    got = {r.ID: r.FutureMedianAmount for r in panel.amount_dataset(g, C, AnalysisParams()).collect()}
    cut = max(r[2] for r in rows) - dt.timedelta(days=AnalysisParams().redonate_window_days)
    later, before = {}, set()
    for _, i, d, a in rows:
        later.setdefault(i, []).append(a) if d > cut else before.add(i)
    assert got == pytest.approx({i: expected(v, 0.5) for i, v in later.items() if i in before}, abs=1.1e-6)
    assert len(later["hot"]) > 400


def test_auc_of_scores_that_crowd_together(spark):
    """90 % of the scores lie within 1e-6: no bucket of a level holds many of them."""
    rng = random.Random(4)
    rows = [(0.5 + rng.random() * 1e-6 if rng.random() < 0.9 else rng.random(), int(rng.random() < 0.4)) for _ in range(20_000)]
    rows += [(0.5, 1)] * 50 + [(0.5, 0)] * 70 + [(None, 1)]
    df = spark.createDataFrame(rows, "probability double, label int")
    pos = sorted(s for s, y in rows if y and s is not None)
    neg = np.array(sorted(s for s, y in rows if not y))
    won = sum((np.searchsorted(neg, s, "left") + np.searchsorted(neg, s, "right")) / 2 for s in pos)
    want = won / ((len(pos) + 1) * len(neg))                     # the row without a score wins nothing
    assert metrics.auc(df).first().auc == pytest.approx(want, abs=2e-9)
    sizes = Q.keyed(df, F.col("probability")).select(F.shiftright("k", Q.SHIFTS[1]).alias("b"), "probability").distinct().groupBy("b").count()
    assert sizes.agg(F.max("count")).first()[0] < 40


@pytest.mark.parametrize("rows", [[], [(0.5, 1)], [(None, 1), (None, 0)], [(0.2, 0), (0.7, 1), (0.7, 0)]])
def test_auc_of_few_rows(spark, rows):
    want = {0: None, 1: None, 2: 0.0, 3: 0.75}[len(rows)]
    assert metrics.auc(spark.createDataFrame(rows, "probability double, label int")).first().auc == want


@pytest.mark.parametrize("key", ["rfm_scores", "rfm_table", "relationship_summary", "residual_quantiles", "amount_dataset"])
def test_no_percentile_in_the_plans(spark, key):
    assert "percentile" not in plan(catalog.queries()[key](spark, SMALL))


@pytest.mark.parametrize("key", ["rfm_table", "donor_summary", "panel_redonate", "panel_major", "panel_time", "panel_preference",
                                 "donor_features_asof", "asof_features", "amount_dataset", "donor_demographics"])
def test_gifts_are_hash_aggregated(spark, key):
    """A sorted aggregate only ever sees rows that a hash aggregate left."""
    text = plan(catalog.queries()[key](spark, SMALL))
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if "SortAggregate" in line:
            assert any("HashAggregate" in x for x in lines[i + 1:])
            below = "\n".join(lines[i + 1:]).split("FileScan")[0]
            assert "HashAggregate" in below, line
    if key in ("rfm_table", "donor_summary"):
        assert not re.search(r"\bSortAggregate", text)


def test_last_by_orders_by_date_then_number(spark):
    rows = [("a", dt.datetime(1950, 5, 1), 9, 1.0), ("a", dt.datetime(1950, 5, 1, 0, 0, 0, 1), 2, 2.0), ("a", None, 99, 3.0),
            ("b", dt.datetime(2020, 1, 1), -5, 4.0), ("b", dt.datetime(2020, 1, 1), 2**62, 5.0), ("b", dt.datetime(2020, 1, 1), None, 6.0),
            ("c", None, 1, 7.0), ("c", None, 2, 8.0)]
    df = spark.createDataFrame(rows, "g string, d timestamp_ntz, s long, v double")
    got = df.groupBy("g").agg(last_by(F.col("v"), F.col("d"), F.col("s")).alias("v"))
    assert {r.g: r.v for r in got.collect()} == {"a": 2.0, "b": 5.0, "c": 8.0}


def test_panel_over_given_cutoffs_equals_one_pass_each(spark):
    rng = random.Random(3)
    rows = [(i, f"d{rng.randrange(25)}", dt.datetime(2015, 1, 1) + dt.timedelta(hours=rng.randrange(40_000)), float(rng.randint(1, 900)))
            for i in range(700)]
    g = spark.createDataFrame(rows, "ReceiptSeq long, ID string, Date timestamp_ntz, Amount double")
    cuts = [dt.datetime(2018, 3, 1, 7), rows[5][2], dt.datetime(2016, 6, 30), dt.datetime(2018, 3, 1, 7), dt.datetime(2000, 1, 1), dt.datetime(2030, 1, 1)]
    got = {(r.ID, r.CutoffDate): (r.Recency, r.Frequency, round(r.Monetary, 2), r.LastAmount, r.ReDonate)
           for r in panel.build_panel(g, "redonate", C, AnalysisParams(), cutoffs=cuts).collect()}
    want = {}
    for cut in set(cuts):
        for who in {r[1] for r in rows}:
            past = sorted((r[2], r[0], r[3]) for r in rows if r[1] == who and r[2] <= cut)
            if past:
                ahead = any(cut < r[2] <= cut + dt.timedelta(days=365) for r in rows if r[1] == who)
                want[who, cut] = ((cut - past[-1][0]).days, len(past), round(sum(p[2] for p in past), 2), past[-1][2], int(ahead))
    assert got == want
    with pytest.raises(InsufficientData):
        panel.build_panel(g, "redonate", C, AnalysisParams(), cutoffs=[])


def test_rfm_edges_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "ReceiptSeq long, ID string, Date timestamp_ntz, Amount double")
    assert rfm.rfm_table(empty, C, AnalysisParams(rfm_reference=dt.datetime(2020, 1, 1))).collect() == []


def test_attributes_fill_only_donors_without_a_row(spark):
    g = spark.createDataFrame([(1, "a", dt.datetime(2015, 1, 1), 5.0), (2, "b", dt.datetime(2015, 1, 1), 5.0)],
                              "ReceiptSeq long, ID string, Date timestamp_ntz, Amount double")
    attrs = spark.createDataFrame([("a", None, None)], "ID string, Gender string, CurrentParent int")
    out = panel.donor_features_asof(g, F.lit(dt.datetime(2016, 1, 1)).cast("timestamp_ntz"), C, attributes=attrs)
    assert {r.ID: (r.Gender, r.CurrentParent) for r in out.collect()} == {"a": (None, None), "b": ("Missing", 0)}
