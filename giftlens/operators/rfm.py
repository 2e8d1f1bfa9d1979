"""RFM: per-donor recency/frequency/monetary, quintile scores, segments
and the lapsed list (A10, A19, W3-W6, L1).

One ``groupBy(ID)`` (partial aggregation first, so a donor holding a third
of all gifts collapses map-side).  Global scalars -- the reference date and
the quintile edges -- are uncorrelated scalar subqueries: Catalyst runs
each once and inlines the value; nothing is collected in Python and no
join is needed.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from giftlens.config import AnalysisParams, ColumnMap
from giftlens.functions.agg import last_by, money_sum, quantile
from giftlens.functions.expr import add_days, elapsed_days, ntz_lit
from giftlens.functions.quantiles import quantiles as exact_quantiles

_C = ColumnMap()
_A = AnalysisParams()

# Segment rules, evaluated in order (fixed labels of the reference).
CHAMPION = "Champion"
LOYAL = "Loyal"
AT_RISK = "At Risk / Lapsed"
HIGH_POTENTIAL = "High Potential"
REGULAR = "Regular"


def reference_date(df: DataFrame, cols: ColumnMap = _C,
                   configured: _dt.datetime | None = None) -> Column:
    """Configured date, else the latest gift + 1 day (a scalar subquery)."""
    if configured is not None:
        return ntz_lit(configured)
    return add_days(df.agg(F.max(cols.date)).scalar(), 1)


def _seq(df: DataFrame, cols: ColumnMap):
    return F.col(cols.seq) if cols.seq and cols.seq in df.columns else None


def rfm_metrics(df: DataFrame, cols: ColumnMap = _C, ref: Column | None = None) -> DataFrame:
    """A10: Recency (whole elapsed days to ``ref``), Frequency, Monetary,
    LastAmount (latest by date, then input order), first/last gift date."""
    df = df.dropna(subset=[cols.date])                          # C11
    ref = ref if ref is not None else reference_date(df, cols)
    d, a = F.col(cols.date), F.col(cols.amount)
    agg = df.groupBy(cols.donor_id).agg(
        F.max(d).alias("LastGiftDate"), F.count(d).alias("Frequency"),
        money_sum(a).alias("Monetary"),
        last_by(a, d, _seq(df, cols)).alias("LastAmount"),
        F.min(d).alias("FirstGiftDate"))
    # The scalar is bound once in its own projection; Catalyst does not
    # inline a subquery into each of its uses.
    return agg.withColumn("__ref", ref).select(
        cols.donor_id, elapsed_days(F.col("LastGiftDate"), F.col("__ref")).alias("Recency"),
        "Frequency", "Monetary", "LastAmount", "FirstGiftDate", "LastGiftDate")


def quintile_score(x: Column, edges: Column, n_edges: int = 4) -> Column:
    """Right-closed bins over quantile edges, 1..5; null -> 3.
    ``1 + #(x > edge)`` equals the binning wherever edges are distinct and
    stays defined when they are not (many one-gift donors)."""
    v = x.cast("double")
    s = F.lit(1)
    for i in range(n_edges):
        s = s + F.when(v > edges.getItem(i), 1).otherwise(0)
    return F.when(x.isNull(), F.lit(3)).otherwise(s).cast("int")


def rfm_scores(rfm: DataFrame, quantiles=_A.rfm_quantiles, exact: bool = True) -> DataFrame:
    """W4 + W5: R (reversed), F and M scores and their sum."""
    qs = list(quantiles)
    values = {"r": -F.col("Recency"), "f": F.col("Frequency"), "m": F.col("Monetary")}
    edges = (exact_quantiles(rfm, values, qs) if exact else
             rfm.agg(F.struct(*[quantile(c, qs, False).alias(n) for n, c in values.items()])).scalar())
    e = F.col("__edges")
    out = rfm.withColumn("__edges", edges).withColumns({
        "R_score": quintile_score(-F.col("Recency"), e["r"], len(qs)),
        "F_score": quintile_score(F.col("Frequency"), e["f"], len(qs)),
        "M_score": quintile_score(F.col("Monetary"), e["m"], len(qs)),
    }).drop("__edges")
    return out.withColumn("RFM_Score", F.col("R_score") + F.col("F_score") + F.col("M_score"))


def segment(r: Column, f: Column, m: Column) -> Column:
    """Ordered segment rules."""
    return (F.when((r >= 4) & (f >= 4) & (m >= 4), CHAMPION)
            .when((r >= 4) & (f >= 3), LOYAL)
            .when((r <= 2) & (f <= 2) & (m <= 2), AT_RISK)
            .when((r >= 4) & (m >= 4), HIGH_POTENTIAL)
            .otherwise(REGULAR))


def rfm_table(df: DataFrame, cols: ColumnMap = _C, params: AnalysisParams = _A) -> DataFrame:
    """Compute RFM end to end: metrics, scores, segment."""
    base = df.dropna(subset=[cols.date])
    ref = reference_date(base, cols, params.rfm_reference)
    scored = rfm_scores(rfm_metrics(base, cols, ref), params.rfm_quantiles, params.exact_quantiles)
    return scored.withColumn("RFM_Segment",
                             segment(F.col("R_score"), F.col("F_score"), F.col("M_score")))


def segment_distribution(rfm: DataFrame) -> DataFrame:
    """Donors and share per segment."""
    total = rfm.agg(F.count(F.lit(1))).scalar()
    return (rfm.groupBy("RFM_Segment").agg(F.count(F.lit(1)).alias("count"))
            .withColumn("pct", F.col("count") / total * F.lit(100.0))
            .orderBy(F.col("count").desc(), "RFM_Segment"))


def lapsed_targets(rfm: DataFrame, recency_days: int = _A.lapsed_recency_days,
                   min_monetary: float = _A.lapsed_min_monetary,
                   cols: ColumnMap = _C) -> DataFrame:
    """L1: long-quiet donors with enough lifetime giving, by value."""
    return (rfm.filter((F.col("Recency") >= recency_days) & (F.col("Monetary") >= min_monetary))
            .orderBy(F.col("Monetary").desc(), cols.donor_id)
            .select(cols.donor_id, "Recency", "Frequency", "Monetary", "RFM_Segment"))
