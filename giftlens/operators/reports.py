"""Descriptive reports: trends, distributions, campaigns, relationships.

A1-A9, W1, W11, T1.  Each report is one ``groupBy`` with partial
(map-side) aggregation, so a hot key collapses before the shuffle; the
only window (W1 growth) runs on the already tiny per-year result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from giftlens.config import AnalysisParams, ColumnMap
from giftlens.functions.agg import median, money, money_avg, money_sum
from giftlens.functions.expr import MISSING_CATEGORY, month_label, month_start, pct_change, safe_div
from giftlens.functions.quantiles import grouped_quantiles

_C = ColumnMap()
_A = AnalysisParams()


def with_temporal(df: DataFrame, cols: ColumnMap = _C) -> DataFrame:
    """Year, MonthPeriod (first day of month) and Month ('yyyy-MM')."""
    if "Year" in df.columns and "MonthPeriod" in df.columns:
        return df
    d = F.col(cols.date)
    return df.withColumns({"Year": F.year(d), "MonthPeriod": month_start(d),
                           "Month": month_label(d)})


def _base_aggs(cols: ColumnMap):
    a = F.col(cols.amount)
    return [money_sum(a).alias("total_amount"),
            F.countDistinct(cols.donor_id).alias("donors"),
            F.count(F.lit(1)).alias("donation_count")]


def trend_year(df: DataFrame, cols: ColumnMap = _C) -> DataFrame:
    """A1 + W1: per-year totals, ratios and growth against the previous
    present year, newest first."""
    df = with_temporal(df, cols)
    t = (df.filter(F.col("Year").isNotNull()).groupBy("Year").agg(*_base_aggs(cols))
         .withColumns({
             "avg_amount_per_donation": safe_div(F.col("total_amount"), F.col("donation_count")),
             "avg_amount_per_donor": safe_div(F.col("total_amount"), F.col("donors")),
             "avg_donations_per_donor": safe_div(F.col("donation_count"), F.col("donors")),
         }))
    # One row per year: the unpartitioned window sees a few dozen rows.
    w = Window.orderBy("Year")
    t = t.withColumns({
        "YoY_total_growth_%": pct_change(F.col("total_amount"), F.lag("total_amount").over(w)),
        "YoY_donor_growth_%": pct_change(F.col("donors"), F.lag("donors").over(w)),
        "YoY_avg_donation_growth_%": pct_change(F.col("avg_amount_per_donation"),
                                                F.lag("avg_amount_per_donation").over(w)),
    })
    return t.orderBy(F.col("Year").desc())


def trend_year_major(df: DataFrame, threshold: float = _A.major_gift_threshold,
                     cols: ColumnMap = _C) -> DataFrame:
    """A2: the yearly trend over gifts at or above the major threshold."""
    return trend_year(df.filter(F.col(cols.amount) >= F.lit(threshold)), cols)


def trend_month(df: DataFrame, cols: ColumnMap = _C) -> DataFrame:
    """A3: per-month totals and ratios, newest first."""
    df = with_temporal(df, cols)
    t = (df.filter(F.col("MonthPeriod").isNotNull()).groupBy("MonthPeriod").agg(*_base_aggs(cols))
         .withColumn("Month", month_label(F.col("MonthPeriod"))))
    return t.select(
        "Month", "total_amount", "donors", "donation_count",
        safe_div(F.col("total_amount"), F.col("donation_count")).alias("avg_amount_per_donation"),
        safe_div(F.col("total_amount"), F.col("donors")).alias("avg_amount_per_donor"),
        safe_div(F.col("donation_count"), F.col("donors")).alias("avg_donations_per_donor"),
    ).orderBy(F.col("Month").desc())


def distribution(df: DataFrame, group_col: str, top_n: int | None = _A.top_n_categories,
                 cols: ColumnMap = _C) -> DataFrame:
    """A4/A5/A6 + T1: totals by category (null keys dropped), by total then
    count descending, optionally the top ``top_n`` (TakeOrderedAndProject,
    no global sort)."""
    t = (df.filter(F.col(group_col).isNotNull()).groupBy(group_col).agg(*_base_aggs(cols))
         .withColumns({
             "avg_amount_per_donation": safe_div(F.col("total_amount"), F.col("donation_count")),
             "avg_amount_per_donor": safe_div(F.col("total_amount"), F.col("donors")),
         }))
    t = t.orderBy(F.col("total_amount").desc(), F.col("donation_count").desc(),
                  F.col(group_col).asc())
    return t.limit(top_n) if top_n else t


def category_reports(df: DataFrame, columns: list[str], top_n: dict[str, int] | None = None,
                     cols: ColumnMap = _C) -> DataFrame:
    """A4-A6 + T1 for all ``columns`` in one scan: ``distribution`` of each, told
    apart by ``report``, its key as the text ``category``; ``top_n`` limits the
    reports it names.

    Gifts are summed up per donor and combination of categories, then per report,
    category and donor, so distinct donors are plain counts and a category that
    most gifts share is dealt out by donor."""
    columns = [c for c in columns if c in df.columns]
    per = df.groupBy(cols.donor_id, *columns).agg(F.sum(money(F.col(cols.amount))).alias("__amt"), F.count(F.lit(1)).alias("__n"))
    sets = F.array(*[F.struct(F.lit(c).alias("report"), F.col(c).cast("string").alias("category")) for c in columns])
    long = per.select(F.col(cols.donor_id).alias("__id"), "__amt", "__n", F.explode(sets).alias("x")).select("x.*", "__id", "__amt", "__n")
    long = long.filter(F.col("category").isNotNull()).groupBy("report", "category", "__id").agg(
        F.sum("__amt").alias("__amt"), F.sum("__n").alias("__n"))
    t = long.groupBy("report", "category").agg(F.sum("__amt").cast("double").alias("total_amount"), F.count("__id").alias("donors"),
                                               F.sum("__n").alias("donation_count")).withColumns({
        "avg_amount_per_donation": safe_div(F.col("total_amount"), F.col("donation_count")),
        "avg_amount_per_donor": safe_div(F.col("total_amount"), F.col("donors"))})
    order = [F.col("total_amount").desc(), F.col("donation_count").desc(), F.col("category").asc()]
    if top_n:
        limit = F.coalesce(*[F.when(F.col("report") == name, F.lit(n)) for name, n in top_n.items()])
        rank = F.row_number().over(Window.partitionBy("report").orderBy(*order))
        t = t.withColumn("__rank", rank).filter(limit.isNull() | (F.col("__rank") <= limit)).drop("__rank")
    return t.orderBy("report", *order)


def appeal_performance(df: DataFrame, cols: ColumnMap = _C) -> DataFrame:
    return distribution(df, cols.appeal, None, cols)


def fund_performance(df: DataFrame, cols: ColumnMap = _C) -> DataFrame:
    return distribution(df, cols.fund, None, cols)


def _binary_key(flags: list[str]):
    """8*CP + 4*PP + 2*PS + FP (relationship order)."""
    weights = (8, 4, 2, 1)
    return sum(F.col(c).cast("int") * w for c, w in zip(flags, weights))


def with_flag_key(df: DataFrame, cols: ColumnMap = _C, name: str = "RelationshipKey") -> DataFrame:
    """W11 as a column: the four relationship flags as one number, null if one is
    null or absent."""
    flags = cols.relationship
    key = _binary_key(flags) if len(flags) == 4 and set(flags) <= set(df.columns) else F.lit(None)
    return df.withColumn(name, key.cast("int"))


def _with_median(t: DataFrame, medians: DataFrame, keys: list[str]) -> DataFrame:
    """``t`` with its groups' medians; null keys are groups."""
    m = medians.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("q0").alias("median_amount"))
    same = F.lit(True)
    for k in keys:
        same = same & t[k].eqNullSafe(m[f"__{k}"])
    return t.join(m, same, "left").drop(*[f"__{k}" for k in keys])


def relationship_summary(df: DataFrame, cols: ColumnMap = _C, exact: bool = True) -> DataFrame:
    """Giving by relationship-flag combination, null keys kept."""
    flags = [c for c in cols.relationship if c in df.columns]
    a = F.col(cols.amount)
    t = df.groupBy(*flags).agg(
        F.countDistinct(cols.donor_id).alias("donors"),
        F.count(F.lit(1)).alias("donation_count"),
        money_sum(a).alias("total_amount"),
        money_avg(a).alias("avg_amount"),
        *([] if exact else [median(a, False).alias("median_amount")]))
    if exact:
        t = _with_median(t, grouped_quantiles(df, flags, a, [0.5]), flags)
    if len(flags) >= 4:
        return t.orderBy(_binary_key(flags).desc_nulls_last())
    return t.orderBy(F.col("total_amount").desc())


def relationship_trend(df: DataFrame, cols: ColumnMap = _C) -> DataFrame:
    """Year x flags totals (null keys dropped)."""
    df = with_temporal(df, cols)
    flags = [c for c in cols.relationship if c in df.columns]
    keys = ["Year"] + flags
    t = df.dropna(subset=keys).groupBy(*keys).agg(
        money_sum(F.col(cols.amount)).alias("total_amount"),
        F.count(F.lit(1)).alias("donation_count"))
    if len(flags) >= 4:
        return t.orderBy(F.col("Year").desc(), _binary_key(flags).desc())
    return t.orderBy(F.col("Year").desc())


def relationship_by_group(df: DataFrame, group_col: str = "AgeGroupAtDonation",
                          cols: ColumnMap = _C) -> DataFrame:
    """Flags x a demographic group (the reference uses age group at
    donation): donors, gifts, total and two ratios."""
    flags = [c for c in cols.relationship if c in df.columns]
    keys = flags + [group_col]
    return df.dropna(subset=keys).groupBy(*keys).agg(
        F.countDistinct(cols.donor_id).alias("donor_count"),
        F.count(F.lit(1)).alias("donation_count"),
        money_sum(F.col(cols.amount)).alias("total_amount"),
    ).withColumns({
        "avg_amount_per_donation": safe_div(F.col("total_amount"), F.col("donation_count")),
        "avg_amount_per_donor": safe_div(F.col("total_amount"), F.col("donor_count")),
    })


def attribute_distribution(gifts: DataFrame, attributes: DataFrame, group_col: str,
                           top_n: int | None = _A.top_n_categories, cols: ColumnMap = _C) -> DataFrame:
    """A4 when the category is a *donor* attribute held in its own table
    (one row per donor): identical to ``distribution`` over the joined wide
    frame, but gifts are first aggregated per donor (partial aggregation
    map-side, so a donor with a third of all gifts becomes one row), and
    only one row per donor is shuffled into the join."""
    per = gifts.groupBy(cols.donor_id).agg(
        F.sum(money(F.col(cols.amount))).alias("__amt"), F.count(F.lit(1)).alias("__n"))
    j = per.join(attributes.select(cols.donor_id, group_col), cols.donor_id, "left")
    # A donor without an attribute row has the category a blank one has.
    t = (j.withColumn(group_col, F.coalesce(group_col, F.lit(MISSING_CATEGORY))).groupBy(group_col)
         .agg(F.sum("__amt").cast("double").alias("total_amount"),
              F.count(F.lit(1)).alias("donors"), F.sum("__n").alias("donation_count"))
         .withColumns({
             "avg_amount_per_donation": safe_div(F.col("total_amount"), F.col("donation_count")),
             "avg_amount_per_donor": safe_div(F.col("total_amount"), F.col("donors")),
         }))
    t = t.orderBy(F.col("total_amount").desc(), F.col("donation_count").desc(), F.col(group_col).asc())
    return t.limit(top_n) if top_n else t


def attribute_relationship_trend(gifts: DataFrame, attributes: DataFrame, cols: ColumnMap = _C) -> DataFrame:
    """A8 when the flags live in the donor table: gifts are aggregated per
    (donor, year) first -- partial aggregation, one row per donor-year --
    and only then joined to the flags; equal to ``relationship_trend`` on
    the joined wide frame."""
    gifts = with_temporal(gifts, cols)
    flags = [c for c in cols.relationship if c in attributes.columns]
    per = (gifts.filter(F.col("Year").isNotNull()).groupBy(cols.donor_id, "Year")
           .agg(F.sum(money(F.col(cols.amount))).alias("__amt"), F.count(F.lit(1)).alias("__n")))
    j = per.join(attributes.select(cols.donor_id, *flags), cols.donor_id, "left").fillna(0, subset=flags)
    t = j.groupBy("Year", *flags).agg(F.sum("__amt").cast("double").alias("total_amount"),
                                      F.sum("__n").alias("donation_count"))
    if len(flags) >= 4:
        return t.orderBy(F.col("Year").desc(), _binary_key(flags).desc())
    return t.orderBy(F.col("Year").desc())


def attribute_relationship_summary(gifts: DataFrame, attributes: DataFrame, cols: ColumnMap = _C,
                                   exact: bool = True) -> DataFrame:
    """A7 when the flags live in the donor table.  Gifts are first reduced
    to (donor, amount, count) -- recurring gifts of one amount collapse
    map-side -- then joined to the flags; the median stays exact, an amount
    counting as often as it was given.  A donor without an attribute row
    has all flags 0, as one with blank flags has."""
    flags = [c for c in cols.relationship if c in attributes.columns]
    a = F.col(cols.amount)
    # The sketch takes no frequencies, so for it every gift stays a row.
    per = (gifts.groupBy(cols.donor_id, a.alias("__a")).agg(F.count(F.lit(1)).alias("__n")) if exact
           else gifts.select(cols.donor_id, a.alias("__a"), F.lit(1).alias("__n")))
    j = per.join(attributes.select(cols.donor_id, *flags), cols.donor_id, "left").fillna(0, subset=flags)
    amt = F.col("__a")
    total = F.sum(money(amt) * F.col("__n"))
    t = j.groupBy(*flags).agg(
        F.countDistinct(cols.donor_id).alias("donors"),
        F.sum("__n").alias("donation_count"),
        total.cast("double").alias("total_amount"),
        F.try_divide(total.cast("double"), F.sum(F.when(amt.isNotNull(), F.col("__n"))).cast("double"))
        .alias("avg_amount"),
        *([] if exact else [median(amt, False).alias("median_amount")]))
    if exact:
        t = _with_median(t, grouped_quantiles(j, flags, amt, [0.5], F.col("__n")), flags)
    if len(flags) >= 4:
        return t.orderBy(_binary_key(flags).desc_nulls_last())
    return t.orderBy(F.col("total_amount").desc())
