"""Point-in-time training panels.

The reference rebuilds features with one full scan, group and sort per
cutoff date, then joins each cutoff's labels.  Here every cutoff is
handled in one pass:

1. Cutoffs are the month ends ``c_i = Qend(start) + 6i months`` (time of
   day of ``start`` kept); they are arithmetic, so each gift computes its
   own *bucket* -- the first cutoff at or after it -- with no join.
2. Gifts are pre-aggregated per (donor, bucket): partial aggregation runs
   before the shuffle, so a donor holding a third of all gifts collapses
   map-side to at most one row per bucket.
3. A window per donor ordered by bucket (bounded: one row per bucket)
   gives cumulative features (rows up to the current bucket) and the next
   gift, next major gift and next target (rows after it).
4. Each bucket row expands to the cutoffs it covers until the donor's next
   bucket (``explode(sequence)``), yielding exactly the donors with
   history at each cutoff.

Work is O(gifts + donors x cutoffs) with two shuffles on the donor key.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from giftlens.config import AnalysisParams, ColumnMap, InsufficientData
from giftlens.functions.agg import median, money, order_number
from giftlens.functions.expr import MISSING_CATEGORY, add_days, elapsed_days, ntz_lit
from giftlens.functions.quantiles import grouped_quantiles

_C = ColumnMap()
_A = AnalysisParams()

LABELS = ("ReDonate", "MajorGift", "DaysToNext", "TargetCategory")


# -- cutoffs -----------------------------------------------------------------

def _micros_of_day(ts: Column) -> Column:
    return (F.hour(ts).cast("long") * 3_600_000_000 + F.minute(ts).cast("long") * 60_000_000
            + (F.date_part(F.lit("SECOND"), ts) * 1_000_000).cast("long"))


def _at_time(day: Column, micros: Column) -> Column:
    """A date at a time of day (microseconds after midnight), NTZ."""
    return F.timestamp_add("MICROSECOND", micros, day.cast("timestamp_ntz"))


def cutoff_at(start: Column, i: Column, step_months: int) -> Column:
    """I-th cutoff -- the quarter end on or after ``start``, then
    every ``step_months`` months (month ends), at start's time of day."""
    q = F.trunc(start.cast("date"), "quarter")
    day = F.last_day(F.add_months(q, (F.lit(2) + i * step_months).cast("int")))
    return _at_time(day, _micros_of_day(start))


def _month_index(ts: Column) -> Column:
    return F.year(ts) * 12 + F.month(ts)


def bucket_of(d: Column, start: Column, n: Column, step_months: int) -> Column:
    """Index of the first cutoff at or after ``d`` (clamped to ``n``, the
    bucket for gifts after the last cutoff)."""
    c0 = cutoff_at(start, F.lit(0), step_months)
    m = _month_index(d) - _month_index(c0)
    k = F.greatest(F.lit(0), F.ceil(m / F.lit(float(step_months))).cast("int"))
    k = k + F.when(d > cutoff_at(start, k, step_months), 1).otherwise(0)
    return F.least(k, n).cast("int")


def cutoff_count(start: Column, end: Column, step_months: int) -> Column:
    """Number of cutoffs in [start, end]."""
    c0 = cutoff_at(start, F.lit(0), step_months)
    months = _month_index(end) - _month_index(c0)
    k = F.floor(months / F.lit(float(step_months))).cast("int")
    k = k - F.when(cutoff_at(start, k, step_months) > end, 1).otherwise(0)
    return F.when(end < c0, F.lit(0)).otherwise(k + 1).cast("int")


# -- panel ranges --------------------------------------------------------------

def _range(df: DataFrame, kind: str, cols: ColumnMap, params: AnalysisParams) -> DataFrame:
    """(start, end) of the panel ``kind``, one row."""
    d = F.col(cols.date)
    mn, mx = F.min(d), F.max(d)
    win = params.redonate_window_days
    if kind in ("redonate", "major"):
        start, end = add_days(mn, 365), add_days(mx, -win)
    else:
        floor_start = ntz_lit(params.min_panel_start)
        start = F.when(floor_start < mn, add_days(mn, 365)).otherwise(floor_start)
        end = add_days(mx, -7) if kind == "time" else add_days(mx, -win)
    return df.agg(start.alias("start"), end.alias("end"))


def require_range(df: DataFrame, kind: str, cols: ColumnMap = _C, params: AnalysisParams = _A) -> None:
    """Raise ``InsufficientData`` if the gifts are too few days for panel
    ``kind``: what building it would fail with.  Reads one row."""
    r = _range(df, kind, cols, params).first()
    if r["start"] is None or r["end"] is None or r["start"] >= r["end"]:
        raise InsufficientData(f"Insufficient date range for {kind} panel")


def _range_struct(df: DataFrame, kind: str, cols: ColumnMap, params: AnalysisParams) -> Column:
    """(start, end, n) of the panel ``kind`` as one scalar subquery."""
    r = _range(df, kind, cols, params).select(
        F.when(F.col("start") >= F.col("end"),
               F.raise_error(F.lit(f"Insufficient date range for {kind} panel")))
        .otherwise(F.col("start")).cast("timestamp_ntz").alias("start"),
        "end")
    r = r.withColumn("n", cutoff_count(F.col("start"), F.col("end"), params.panel_step_months))
    return r.select(F.struct("start", "end", "n")).scalar()


def panel_cutoffs(df: DataFrame, kind: str = "redonate", cols: ColumnMap = _C,
                  params: AnalysisParams = _A) -> DataFrame:
    """W10 as a table: (i, CutoffDate) for the panel ``kind``."""
    rng = _range_struct(df, kind, cols, params)
    spark = df.sparkSession
    base = spark.range(1).select(rng.alias("__r"))
    out = base.select(F.explode(F.sequence(F.lit(0), F.col("__r.n") - 1)).alias("i"), "__r")
    return out.select("i", cutoff_at(F.col("__r.start"), F.col("i"),
                                     params.panel_step_months).alias("CutoffDate"))


# -- demographics --------------------------------------------------------------

def _demo_cols(df: DataFrame, cols: ColumnMap, attributes: DataFrame | None = None) -> list[str]:
    """Demographics carried by the gift rows themselves (latest row wins)."""
    held = set(attributes.columns) - {cols.donor_id} if attributes is not None else set()
    return [c for c in cols.demographics if c in df.columns and c not in held]


def _attach_attributes(result: DataFrame, attributes: DataFrame | None, cols: ColumnMap,
                       order: list[str]) -> DataFrame:
    """Join donor-table attributes (one row per donor) onto an already
    aggregated result, then restore the column order.  Joining after the
    aggregation shuffles one row per donor (or donor x cutoff), never
    the raw gifts."""
    if attributes is None:
        return result
    extra = [c for c in cols.demographics if c in attributes.columns and c != cols.donor_id]
    if not extra:
        return result
    j = result.join(attributes.select(cols.donor_id, *extra, F.lit(True).alias("__found")), cols.donor_id, "left")

    def blank(c):
        if c in cols.relationship:
            return F.lit(0)
        return F.lit(MISSING_CATEGORY if dict(attributes.dtypes)[c] == "string" else None)

    # Donors without an attribute row, and only they, get what blank attributes are cleaned to.
    j = j.withColumns({c: F.when(F.col("__found"), F.col(c)).otherwise(blank(c)) for c in extra}).drop("__found")
    demo_order = [c for c in cols.demographics if c in j.columns]
    head = [c for c in order if c not in cols.demographics and c not in ("CutoffDate",) + LABELS
            and c != "FutureMedianAmount"]
    tail = [c for c in order if c == "CutoffDate" or c in LABELS or c == "FutureMedianAmount"]
    return j.select(*head, *demo_order, *tail)


def donor_demographics(df: DataFrame, cols: ColumnMap = _C) -> DataFrame:
    """Latest demographic row per donor by (date, input order).  Gifts
    are first hash-aggregated to the latest of each of a donor's different
    demographics; only those few rows are compared as rows."""
    demo = _demo_cols(df, cols)
    seq = F.col(cols.seq) if cols.seq in df.columns else None
    latest = df.groupBy(cols.donor_id, *demo).agg(F.max(order_number(F.col(cols.date), seq)).alias("__k"))
    t = latest.groupBy(cols.donor_id).agg(F.max_by(F.struct(*demo), "__k").alias("__demo"))
    return t.select(cols.donor_id, *[F.col("__demo")[c].alias(c) for c in demo])


# -- as-of features for one cutoff -----------------------------------------------

def _history(df: DataFrame, hist: Column, demo: list[str], seq: Column | None, cols: ColumnMap) -> DataFrame:
    """Per donor the gifts that are ``hist`` (up to ``__cut``) summed up, and the latest
    demographics of all gifts.  Gifts are hash-aggregated per donor and different
    demographics; what is left of them is merged."""
    d, a = F.col(cols.date), F.col(cols.amount)
    key = order_number(d, seq)
    t = df.groupBy(cols.donor_id, *demo).agg(
        F.count_if(hist).alias("Frequency"), F.sum(F.when(hist, money(a))).alias("__sum"), F.max(F.when(hist, d)).alias("__last"),
        F.max_by(F.when(hist, a), F.when(hist, key)).alias("LastAmount"), F.max(F.when(hist, key)).alias("__lk"),
        F.max(key).alias("__k"), F.first("__cut").alias("__cut"))
    if not demo:
        return t
    return t.groupBy(cols.donor_id).agg(
        F.sum("Frequency").alias("Frequency"), F.sum("__sum").alias("__sum"), F.max("__last").alias("__last"),
        F.max_by("LastAmount", "__lk").alias("LastAmount"), F.first("__cut").alias("__cut"),
        F.max_by(F.struct(*demo), "__k").alias("__demo"))


def donor_features_asof(df: DataFrame, cutoff: Column, cols: ColumnMap = _C,
                        demographics: bool = True, attributes: DataFrame | None = None) -> DataFrame:
    """A13 (+J4): features of each donor with a gift at or before
    ``cutoff``; demographics are the latest over all data (reference
    parity), folded into the same aggregation."""
    d, a = F.col(cols.date), F.col(cols.amount)
    seq = F.col(cols.seq) if cols.seq in df.columns else None
    df = df.withColumn("__cut", cutoff)
    hist = d <= F.col("__cut")
    demo = _demo_cols(df, cols, attributes) if demographics else []
    t = _history(df, hist, demo, seq, cols).filter(F.col("Frequency") > 0)
    out = t.select(
        cols.donor_id,
        elapsed_days(F.col("__last"), F.col("__cut")).alias("Recency"),
        "Frequency", F.col("__sum").cast("double").alias("Monetary"),
        F.try_divide(F.col("__sum").cast("double"), F.col("Frequency").cast("double")).alias("AvgAmount"),
        "LastAmount", *[F.col("__demo")[c].alias(c) for c in demo])
    return _attach_attributes(out, attributes if demographics else None, cols, out.columns)


# -- the panel ---------------------------------------------------------------------

def build_panel(df: DataFrame, kind="redonate", cols: ColumnMap = _C,
                params: AnalysisParams = _A, target_col: str | None = None,
                attributes: DataFrame | None = None, cutoffs: Sequence[_dt.datetime] | None = None) -> DataFrame:
    """Features as of every cutoff of panel ``kind`` plus its label.

    ``cutoffs``: the cutoff dates to use, in any order, repeated ones once;
    without them the panel's own (W10) are used.  An empty list raises
    ``InsufficientData``.

    kind: ``redonate`` (ReDonate 0/1, left), ``major`` (MajorGift 0/1,
    left), ``time`` (DaysToNext > 0, inner), ``preference``
    (TargetCategory, inner; target = fund if any non-null, else appeal),
    or any :class:`Label`.

    ``attributes``: optional donor table (one row per donor) holding some
    demographics; they are joined onto the finished panel instead of onto
    every gift, so the raw gifts are only ever shuffled pre-aggregated.
    """
    out = _build_panel(df, kind, cols, params, target_col, attributes, cutoffs)
    return _attach_attributes(out, attributes, cols, out.columns)


@dataclass(frozen=True)
class BucketContext:
    """What a label's per-bucket aggregate can use: the gift columns, the
    (date, input order) key (a number) and the analysis parameters."""
    date: Column
    amount: Column
    key: Column
    params: AnalysisParams

    def col(self, name: str) -> Column:
        return F.col(name)


@dataclass(frozen=True)
class Label:
    """A panel label as column expressions -- the reference's
    ``label_func(df, cutoff)`` hook, re-expressed so that every cutoff is
    labelled in the same pass.

    ``per_bucket`` aggregates the gifts of one (donor, bucket); ``ahead``
    combines the buckets after a cutoff (``"first"`` non-null in time
    order, or ``"min"``); ``value(next, cutoff, horizon)`` turns that into
    the label (null = no label).  ``keep="left"`` fills missing labels with
    ``default``; ``keep="inner"`` drops those rows.  ``range`` picks the
    cutoff range: ``"redonate"``/``"major"`` (first gift + 365 d to latest
    - window), ``"time"`` (panel start to latest - 7 d) or
    ``"preference"`` (panel start to latest - window).

    With ``merge`` the gifts of a bucket are aggregated in two steps: per
    demographics and columns of ``split``, where ``per_bucket`` should be
    hash-aggregatable (no strings), then ``merge(per_bucket's result, first
    key)`` over these rows.  Without it in one.
    """
    name: str
    per_bucket: Callable[[BucketContext], Column]
    ahead: str
    value: Callable[[Column, Column, Column], Column]
    keep: str = "left"
    default: object = 0
    range: str = "redonate"
    merge: Callable[[Column, Column], Column] | None = None
    split: tuple[str, ...] = ()


def _earliest(lab: Column, key: Column) -> Column:
    return F.min(lab)


def redonate_label() -> Label:
    """Any gift in (cutoff, cutoff + window]."""
    return Label("ReDonate", lambda x: F.min(x.date), "first",
                 lambda nxt, cut, hz: F.when(nxt.isNotNull() & (nxt <= hz), 1).otherwise(0).cast("int"),
                 "left", 0, "redonate", _earliest)


def major_label(threshold: float) -> Label:
    """Any gift >= threshold in (cutoff, cutoff + window]."""
    return Label("MajorGift", lambda x: F.min(F.when(x.amount >= F.lit(threshold), x.date)), "min",
                 lambda nxt, cut, hz: F.when(nxt.isNotNull() & (nxt <= hz), 1).otherwise(0).cast("int"),
                 "left", 0, "major", _earliest)


def days_to_next_label() -> Label:
    """Whole days to the next gift (no window end), kept when > 0."""
    def value(nxt, cut, hz):
        days = elapsed_days(cut, nxt)
        return F.when(days > 0, days)
    return Label("DaysToNext", lambda x: F.min(x.date), "first", value, "inner", None, "time", _earliest)


def next_category_label(target_col: str) -> Label:
    """fund/appeal of the first gift in the window with a value."""
    t = F.col(target_col)

    def merge(first, key):
        return F.min_by(F.struct(first.alias("d"), t.alias("t")), F.when(t.isNotNull(), key))

    return Label("TargetCategory", lambda x: F.min(x.date), "first",
                 lambda nxt, cut, hz: F.when(nxt["d"] <= hz, nxt["t"]), "inner", None, "preference", merge, (target_col,))


def _label_for(kind, df, cols, params, target_col) -> Label:
    if isinstance(kind, Label):
        return kind
    if kind == "redonate":
        return redonate_label()
    if kind == "major":
        return major_label(params.major_gift_threshold)
    if kind == "time":
        return days_to_next_label()
    if kind == "preference":
        return next_category_label(target_col or preference_target(df, cols))
    raise ValueError(f"unknown panel kind {kind!r}")


class _Quarters:
    """The panel's own cutoffs: quarter ends, by arithmetic."""

    def __init__(self, df, label, cols, params):
        self.range, self.step = _range_struct(df, label.range, cols, params), params.panel_step_months
        self.n = F.col("__r.n")

    def attach(self, df: DataFrame) -> DataFrame:
        return df.withColumn("__r", self.range)

    def bucket(self, d: Column) -> Column:
        return bucket_of(d, F.col("__r.start"), F.col("__r.n"), self.step)

    def at(self, i: Column) -> Column:
        return cutoff_at(F.col("__r.start"), i, self.step)


class _Given:
    """A caller's cutoffs, sorted, each once."""

    def __init__(self, cutoffs: Sequence[_dt.datetime]):
        dates = sorted(set(cutoffs))
        if not dates:
            raise InsufficientData("No cutoff dates given")
        self.dates, self.count, self.n = F.array(*[ntz_lit(c) for c in dates]), len(dates), F.lit(len(dates))

    def attach(self, df: DataFrame) -> DataFrame:
        return df.withColumn("__r", self.dates)

    def bucket(self, d: Column) -> Column:
        """How many cutoffs lie before ``d``, by bisection: halving steps are taken
        while the cutoff they would pass is still before."""
        steps = [2**i for i in reversed(range(self.count.bit_length()))]
        return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda at, s: F.when(
            (at + s <= self.count) & (F.get("__r", at + s - 1) < d), at + s).otherwise(at))

    def at(self, i: Column) -> Column:
        return F.get("__r", i)


def _build_panel(df, kind, cols, params, target_col, attributes, cutoffs=None):
    win = params.redonate_window_days
    d, a = F.col(cols.date), F.col(cols.amount)
    seq = F.col(cols.seq) if cols.seq in df.columns else None
    demo = _demo_cols(df, cols, attributes)
    label = _label_for(kind, df, cols, params, target_col)

    cuts = _Given(cutoffs) if cutoffs is not None else _Quarters(df, label, cols, params)
    g = cuts.attach(df)
    g = g.withColumn("b", cuts.bucket(d))

    key = order_number(d, seq)
    ctx = BucketContext(d, a, key, params)
    aggs = [F.count(F.lit(1)).alias("cnt"), F.sum(money(a)).alias("amt"),
            F.max(d).alias("max_d"), F.max_by(a, key).alias("last_amt"),
            label.per_bucket(ctx).alias("lab_b")]
    if label.merge is None:
        if demo:
            aggs.append(F.max_by(F.struct(*[F.col(c) for c in demo]), key).alias("demo"))
        pre = g.groupBy(cols.donor_id, "b").agg(*aggs)
    else:
        parts = list(dict.fromkeys([*demo, *label.split]))
        pre = g.groupBy(cols.donor_id, "b", *parts).agg(*aggs, F.max(key).alias("max_k"), F.min(key).alias("min_k"))
        if parts:
            merged = [F.sum("cnt").alias("cnt"), F.sum("amt").alias("amt"), F.max("max_d").alias("max_d"),
                      F.max_by("last_amt", "max_k").alias("last_amt"),
                      label.merge(F.col("lab_b"), F.col("min_k")).alias("lab_b")]
            if demo:
                merged.append(F.max_by(F.struct(*[F.col(c) for c in demo]), "max_k").alias("demo"))
            pre = pre.groupBy(cols.donor_id, "b").agg(*merged)
    pre = cuts.attach(pre)

    # One row per (donor, bucket): the window is bounded by the cutoff count.
    w = Window.partitionBy(cols.donor_id).orderBy("b")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = w.rowsBetween(1, Window.unboundedFollowing)
    nxt = (F.min("lab_b").over(after) if label.ahead == "min"
           else F.first("lab_b", ignorenulls=True).over(after))
    cols_w = {"cum_cnt": F.sum("cnt").over(upto), "cum_amt": F.sum("amt").over(upto),
              "next_b": F.lead("b").over(w), "next_lab": nxt}
    if demo:
        cols_w["demo_x"] = (F.col("demo") if params.demographics_asof else
                            F.last("demo").over(w.rowsBetween(Window.unboundedPreceding,
                                                              Window.unboundedFollowing)))
    pw = pre.withColumns(cols_w)

    # Each bucket row stands for the cutoffs up to the donor's next bucket.
    n = cuts.n
    last_i = F.least(F.coalesce(F.col("next_b"), n), n) - 1
    ex = pw.filter(F.col("b") < n).withColumn("i", F.explode(F.sequence(F.col("b"), last_i)))
    ex = ex.withColumn("CutoffDate", cuts.at(F.col("i")))
    horizon = add_days(F.col("CutoffDate"), win)

    feats = [F.col(cols.donor_id),
             elapsed_days(F.col("max_d"), F.col("CutoffDate")).alias("Recency"),
             F.col("cum_cnt").alias("Frequency"),
             F.col("cum_amt").cast("double").alias("Monetary"),
             F.try_divide(F.col("cum_amt").cast("double"), F.col("cum_cnt").cast("double")).alias("AvgAmount"),
             F.col("last_amt").alias("LastAmount"),
             *[F.col("demo_x")[c].alias(c) for c in demo],
             F.col("CutoffDate")]
    val = label.value(F.col("next_lab"), F.col("CutoffDate"), horizon)
    if label.keep == "left":
        if label.default is not None:
            val = F.coalesce(val, F.lit(label.default))
        return ex.select(*feats, val.alias(label.name))
    return ex.select(*feats, val.alias(label.name)).filter(F.col(label.name).isNotNull())


def preference_target(df: DataFrame, cols: ColumnMap = _C) -> str:
    """Fund when present with any value, else appeal, else error.

    Decided at plan-build time from the schema and one bounded probe
    (``limit(1)``) -- never a scan of the whole column.
    """
    for c in (cols.fund, cols.appeal):
        if c and c in df.columns and df.filter(F.col(c).isNotNull()).limit(1).count() > 0:
            return c
    raise InsufficientData("Neither Fund nor Appeal columns available")


def amount_dataset(df: DataFrame, cols: ColumnMap = _C, params: AnalysisParams = _A,
                   exact: bool = True, attributes: DataFrame | None = None) -> DataFrame:
    """J7 + A18: features as of ``max - window`` with the median of each
    donor's later gifts as the target (donors with both only).  The median
    goes through prefix counts of the donor's amounts, so a donor holding a
    third of all gifts is spread over many tasks."""
    d, a = F.col(cols.date), F.col(cols.amount)
    seq = F.col(cols.seq) if cols.seq in df.columns else None
    cutoff = add_days(df.agg(F.max(d)).scalar(), -params.redonate_window_days)
    g = df.withColumn("__cut", cutoff)
    hist = d <= F.col("__cut")
    demo = _demo_cols(df, cols, attributes)
    later = g.where(~hist)
    future = (grouped_quantiles(later, [cols.donor_id], a, [0.5]) if exact else
              later.groupBy(cols.donor_id).agg(median(a, False).alias("q0")).where("q0 is not null"))
    future = future.select(F.col(cols.donor_id).alias("__id"), F.col("q0").alias("FutureMedianAmount"))
    t = _history(g, hist, demo, seq, cols).filter(F.col("Frequency") > 0)
    t = t.join(future, t[cols.donor_id].eqNullSafe(future["__id"])).drop("__id")
    out = t.select(
        cols.donor_id,
        elapsed_days(F.col("__last"), F.col("__cut")).alias("Recency"),
        "Frequency", F.col("__sum").cast("double").alias("Monetary"),
        F.try_divide(F.col("__sum").cast("double"), F.col("Frequency").cast("double")).alias("AvgAmount"),
        "LastAmount", *[F.col("__demo")[c].alias(c) for c in demo], "FutureMedianAmount")
    return _attach_attributes(out, attributes, cols, out.columns)


def panel_summary(panel: DataFrame, label: str, name: str | None = None) -> DataFrame:
    """Observations, positives and rate (binary), median (numeric),
    class count (any), cutoff count -- one aggregation."""
    y = F.col(label)
    numeric = panel.schema[label].dataType.typeName() in ("integer", "long", "double")
    aggs = [F.count(F.lit(1)).alias("observations"),
            F.countDistinct("CutoffDate").alias("cutoffs"),
            F.countDistinct(y).alias("classes")]
    if numeric:
        aggs += [F.count_if(y.cast("double") > 0).alias("positives"),
                 F.round(F.percentile(y.cast("double"), F.lit(0.5)), 6).alias("median_label")]
    else:
        aggs += [F.lit(None).cast("long").alias("positives"), F.lit(None).cast("double").alias("median_label")]
    t = panel.agg(*aggs)
    return t.select(F.lit(name or label).alias("dataset"), "observations", "cutoffs", "classes",
                    "positives", F.try_divide(F.col("positives").cast("double"),
                                              F.col("observations").cast("double")).alias("positive_rate"),
                    "median_label")


__all__ = ["build_panel", "require_range", "Label", "BucketContext", "redonate_label", "major_label",
           "days_to_next_label", "next_category_label", "panel_cutoffs", "donor_demographics", "donor_features_asof",
           "amount_dataset", "panel_summary", "preference_target", "cutoff_at", "bucket_of"]
