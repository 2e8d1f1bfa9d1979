"""Donor summary with trailing windows and the operational lists
(A11, A12, J8, L2-L5).

The trailing 12-month windows are conditional aggregates in the same
``groupBy`` as the lifetime metrics, so the reference's two extra
grouped passes and two joins disappear.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from giftlens.config import AnalysisParams, ColumnMap
from giftlens.functions.agg import MONEY, last_by, money, money_avg, money_sum
from giftlens.functions.expr import add_days, elapsed_days

_C = ColumnMap()
_A = AnalysisParams()

LIST_COLUMNS = ("Recency", "Frequency", "Monetary", "AvgAmount", "LastAmount",
                "LastGiftDate", "FirstGiftDate", "Gifts12", "Amt12",
                "GiftsPrev12", "AmtPrev12")
WINDOW_DAYS = 365


def donor_summary(df: DataFrame, cols: ColumnMap = _C) -> DataFrame:
    """A11 + A12: lifetime metrics and the last / previous 12 months
    (``(ref-365d, ref]`` and ``(ref-730d, ref-365d]``, ref = latest + 1d)."""
    d, a = F.col(cols.date), F.col(cols.amount)
    df = df.withColumn("__ref", add_days(df.agg(F.max(d)).scalar(), 1))
    ref = F.col("__ref")
    cut12 = add_days(ref, -WINDOW_DAYS)
    cut24 = add_days(ref, -2 * WINDOW_DAYS)
    recent = d > cut12
    prev = (d <= cut12) & (d > cut24)
    seq = F.col(cols.seq) if cols.seq and cols.seq in df.columns else None
    s = df.groupBy(cols.donor_id).agg(
        F.max(d).alias("LastGiftDate"), F.min(d).alias("FirstGiftDate"),
        F.count(d).alias("Frequency"), money_sum(a).alias("Monetary"),
        money_avg(a).alias("AvgAmount"), last_by(a, d, seq).alias("LastAmount"),
        F.count_if(recent).alias("Gifts12"),
        F.coalesce(F.sum(F.when(recent, money(a))), F.lit(0).cast(MONEY)).cast("double").alias("Amt12"),
        F.count_if(prev).alias("GiftsPrev12"), F.first("__ref").alias("__ref"),
        F.coalesce(F.sum(F.when(prev, money(a))), F.lit(0).cast(MONEY)).cast("double").alias("AmtPrev12"))
    return s.select(cols.donor_id, "LastGiftDate", "FirstGiftDate", "Frequency", "Monetary",
                    "AvgAmount", "LastAmount",
                    elapsed_days(F.col("LastGiftDate"), ref).alias("Recency"),
                    "Gifts12", "Amt12", "GiftsPrev12", "AmtPrev12")


def _list(summary: DataFrame, cols: ColumnMap, columns=LIST_COLUMNS) -> list:
    return [cols.donor_id] + [c for c in columns if c in summary.columns]


def lapsed_12m(summary: DataFrame, recency_days: int = _A.lapsed12_recency_days,
               min_monetary: float = _A.lapsed12_min_monetary, cols: ColumnMap = _C) -> DataFrame:
    """L2: no gift for a year, some history; by value, then most recent."""
    return (summary.filter((F.col("Recency") >= recency_days) & (F.col("Monetary") >= min_monetary))
            .orderBy(F.col("Monetary").desc(), F.col("Recency").asc(), cols.donor_id)
            .select(*_list(summary, cols)))


def high_potential_sleeper(summary: DataFrame, recency_days: int = _A.sleeper_recency_days,
                           min_monetary: float = _A.sleeper_min_monetary,
                           cols: ColumnMap = _C) -> DataFrame:
    """L3: strong history but dormant."""
    return lapsed_12m(summary, recency_days, min_monetary, cols)


def upgrade_candidates(summary: DataFrame, params: AnalysisParams = _A,
                       cols: ColumnMap = _C) -> DataFrame:
    """L4: gave within a year of the latest gift, last gift >= 1.5x their
    average, at least two gifts; largest last gift first."""
    latest = summary.agg(F.max("LastGiftDate")).scalar()
    cutoff = F.col("__cut")
    return (summary.withColumn("__cut", add_days(latest, -params.upgrade_recent_days)).filter((F.col("LastGiftDate") >= cutoff)
                           & (F.col("LastAmount") >= F.lit(params.upgrade_multiplier) * F.col("AvgAmount"))
                           & (F.col("Frequency") >= params.upgrade_min_frequency))
            .orderBy(F.col("LastAmount").desc(), cols.donor_id)
            .select(*_list(summary, cols)))


def new_donors(summary: DataFrame, days: int = _A.new_donor_days, cols: ColumnMap = _C) -> DataFrame:
    """First gift within ``days`` of the newest first gift (not of the
    run date); newest first."""
    newest = summary.agg(F.max("FirstGiftDate")).scalar()
    return (summary.withColumn("__cut", add_days(newest, -days))
            .filter(F.col("FirstGiftDate") >= F.col("__cut"))
            .orderBy(F.col("FirstGiftDate").desc(), cols.donor_id)
            .select(*_list(summary, cols, LIST_COLUMNS[:9])))


def donor_spine(df: DataFrame, cols: ColumnMap = _C) -> DataFrame:
    """Distinct donors."""
    return df.select(cols.donor_id).distinct()


__all__ = ["donor_summary", "lapsed_12m", "high_potential_sleeper", "upgrade_candidates",
           "new_donors", "donor_spine"]
