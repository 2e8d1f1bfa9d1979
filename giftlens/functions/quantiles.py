"""Exact quantiles and prefix sums over values, without a map of all values in one task.

A double becomes a 64-bit number in the same order.  Its high bits deal the
values into buckets; counts per bucket say in which one a wanted rank lies, and
only that bucket is looked at more closely, by the next bits.  Three levels
determine every bit, so no task sorts more rows than a level has buckets,
whatever the values are, and equal values are one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bits below each level; the levels are of 22 bits (sign, exponent and ten bits of
#: the fraction), 21 and 21.
SHIFTS = (42, 21, 0)
_FRACTION = 2.0**52


def _two_to(e: str) -> str:
    """SQL for 2.0 to the power ``e``, from -1022 to 1023, to the last bit: the product
    of two of 96 constants (``pow`` may be off by one)."""
    high = ", ".join(f"{2.0 ** (32 * i - 1024)!r}D" for i in range(64))
    low = ", ".join(f"{2.0**i!r}D" for i in range(32))
    at = f"cast({e} + 1024 AS int)"
    return f"(get(array({high}), shiftright({at}, 5)) * get(array({low}), {at} & 31))"


def keyed(df: DataFrame, value: Column, name: str = "k") -> DataFrame:
    """``df`` with the 64-bit numbers of a column of doubles, in the doubles' order; NaN
    and null have none.  The steps are columns, so none is computed twice."""
    df = df.withColumn("__x", value.cast("double"))
    df = df.withColumns({"__a": F.expr("abs(__x)"), "__e": F.expr("least(greatest(floor(log2(abs(__x))), -1021), 1022)")})
    df = df.withColumn("__p", F.expr(_two_to("__e")))
    # The logarithm may be rounded to either side of a power of two.
    df = df.withColumns({"__e": F.expr("__e + CASE WHEN __p > __a THEN -1 WHEN __p * 2 <= __a THEN 1 ELSE 0 END"),
                         "__p": F.expr("CASE WHEN __p > __a THEN __p * 0.5D WHEN __p * 2 <= __a THEN __p * 2 ELSE __p END")})
    k = f"""CASE WHEN __a = 0 THEN 0L WHEN __a = double('Infinity') THEN {2047 * 2**52}L
            ELSE (__e + 1023) * {2**52}L + cast((__a / __p - 1) * {_FRACTION!r}D AS bigint) END"""
    return df.withColumn(name, F.expr(f"CASE WHEN isnan(__x) THEN NULL WHEN __x < 0 THEN -({k}) WHEN __x >= 0 THEN {k} END")).drop("__x", "__a", "__e", "__p")


def key_value(k: str) -> Column:
    """The double of a key."""
    a = f"abs({k})"
    e, part = f"shiftright({a}, 52)", f"cast({a} & {2**52 - 1}L AS double)"
    return F.expr(f"""(CASE WHEN {k} < 0 THEN -1D ELSE 1D END) * CASE {e} WHEN 0 THEN {part} * {2.0**-52!r}D * {2.0**-1022!r}D
        WHEN 2047 THEN double('Infinity') ELSE ({part} / {_FRACTION!r}D + 1) * {_two_to(f"({e} - 1023)")} END""")


def _ranks(total: str, qs: list[float]) -> Column:
    """For each quantile its two ranks (ids 2j and 2j + 1, from 0) and how far it lies
    beyond the first."""
    out = []
    for j, q in enumerate(qs):
        at = f"(cast({total} - 1 AS double) * {q!r}D)"
        out += [f"named_struct('id', {2 * j + i}, 'rest', cast({end}({at}) AS bigint), 'part', {at} - floor({at}))" for i, end in enumerate(("floor", "ceil"))]
    return F.expr(f"array({', '.join(out)})")


def _within(ranks: Column, before: Column, count: Column) -> Column:
    """The ranks of a bucket, counted from its begin."""
    own = F.filter(ranks, lambda r: (r["rest"] >= before) & (r["rest"] < before + count))
    return F.transform(own, lambda r: F.struct(r["id"].alias("id"), (r["rest"] - before).alias("rest"), r["part"].alias("part")))


def _between(lo: Column, hi: Column, part: Column) -> Column:
    """Linear interpolation, rounded to 6 decimals so two engines agree to the last digit."""
    return F.round(F.when(part == 0, lo).otherwise((F.lit(1.0) - part) * lo + part * hi), 6)


def _running(c: str, *by) -> tuple[Column, Column]:
    """(sum over the rows before, sum over all) by key within ``by``."""
    over = Window.partitionBy(*by)
    return (F.coalesce(F.sum(c).over(over.orderBy("k").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long")),
            F.sum(c).over(over))


def quantiles(df: DataFrame, values: dict[str, Column], qs) -> Column:
    """Scalar struct of arrays: the quantiles ``qs`` of each of the ``values`` over all
    rows; null where no row has a value.  Interpolated linearly, rounded to 6 decimals.

    Each level is a scalar subquery of a few numbers for each wanted rank, so there is
    no join; a level's window is over its buckets, not over rows."""
    qs = [float(q) for q in qs]
    long = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("m"), c.cast("double").alias("v")) for i, c in enumerate(values.values())]))
                     .alias("x")).select("x.m", "x.v")
    # Equal values become one row, and every level reads the same shuffle.
    # The filter is on the value: on the key, it would be pushed below the key's steps.
    long = keyed(long.where("v is not null and not isnan(v)"), F.col("v")).groupBy("m", "k").agg(F.count(F.lit(1)).alias("c"))
    wanted, above = None, None
    for shift in SHIFTS:
        count = F.sum("c").alias("c")
        if wanted is None:
            level = long.groupBy("m", F.shiftright("k", shift).alias("k")).agg(count)
            before, total = _running("c", "m")
            level = level.withColumns({"before": before, "total": total}).withColumn("r", _ranks("total", qs))
        else:
            rows = long.withColumn("w", wanted).withColumn("up", F.shiftright("k", above))
            # The count, never 0, keeps the filter above the sums, where a row is a value.
            own = F.filter("w", lambda w: (w["m"] == F.col("m")) & (w["b"] == F.col("up")) & (F.col("c") > 0))
            rows = rows.withColumn("r", own).where(F.size("r") > 0)
            level = rows.groupBy("m", "up", "r", F.shiftright("k", shift).alias("k")).agg(count)
            level = level.withColumn("before", _running("c", "m", "up")[0])
        hits = level.select("m", F.col("k").alias("b"), F.explode(_within(F.col("r"), F.col("before"), F.col("c"))).alias("r"))
        if shift:
            wanted = hits.agg(F.collect_list(F.struct("m", "b", "r.id", "r.rest", "r.part"))).scalar()
        above = shift
    # One row for each value and rank, a handful: two ranks make a quantile.
    got = hits.select("m", F.floor(F.col("r.id") / 2).cast("int").alias("j"), F.col("r.id") % 2 == 0, F.col("r.part").alias("part"),
                      key_value("b").alias("v")).toDF("m", "j", "first", "part", "v")
    got = got.groupBy("m", "j").agg(F.max(F.when(F.col("first"), F.col("v"))).alias("lo"), F.max(F.when(~F.col("first"), F.col("v"))).alias("hi"),
                                    F.max("part").alias("part"))
    got = got.groupBy("m").agg(F.sort_array(F.collect_list(F.struct("j", _between(F.col("lo"), F.col("hi"), F.col("part")).alias("q")))).alias("q"))
    none = F.array(*[F.lit(None).cast("double") for _ in qs])
    row = got.agg(*[F.coalesce(F.get(F.collect_list(F.when(F.col("m") == m, F.col("q.q"))), F.lit(0)), none).alias(name) for m, name in enumerate(values)])
    return row.select(F.struct(*values)).scalar()


def _same(a: DataFrame, b: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    cond = None
    for x, y in pairs:
        c = a[x].eqNullSafe(b[y])
        cond = c if cond is None else cond & c
    return cond


def grouped_quantiles(df: DataFrame, by: list[str], value: Column, qs, weight: Column | None = None) -> DataFrame:
    """(by..., q0, q1, ...): quantiles of ``value`` in each group, a row counting ``weight``
    times; groups without a value have no row.  Null keys are groups.

    Rows are first summed up by value, then prefix counts go down the levels, so a
    group that holds a third of all rows is dealt out by its values."""
    qs, keys = [float(q) for q in qs], [f"__g{i}" for i in range(len(by))]
    per = df.select(*[F.col(b).alias(k) for b, k in zip(by, keys)], value.alias("v"), (weight if weight is not None else F.lit(1)).cast("long").alias("c"))
    per = (keyed(per.where("v is not null and not isnan(v) and c > 0"), F.col("v")).groupBy(*keys, "k").agg(F.sum("c").alias("c")))
    levels = [per]
    for shift, below in zip(SHIFTS[1::-1], SHIFTS[::-1]):
        levels.append(levels[-1].groupBy(*keys, F.shiftright("k", shift - below).alias("k")).agg(F.sum("c").alias("c")))
    hits = None
    for level, above, shift in zip(levels[::-1], (None, *SHIFTS), SHIFTS):
        if hits is None:
            before, total = _running("c", *keys)
            level = level.withColumns({"before": before, "total": total}).withColumn("r", _ranks("total", qs))
        else:
            level = level.withColumn("u", F.shiftright("k", above - shift))
            up = hits.select(*[F.col(k).alias(f"h{k}") for k in keys], F.col("k").alias("hk"), F.col("r").alias("hr"))
            level = level.join(up, _same(level, up, [("u", "hk"), *[(k, f"h{k}") for k in keys]]))
            before, _ = _running("c", *keys, "u")
            level = level.withColumn("before", before).withColumnRenamed("hr", "r")
        hits = level.select(*keys, "k", _within(F.col("r"), F.col("before"), F.col("c")).alias("r")).where(F.size("r") > 0)
    flat = hits.select(*keys, key_value("k").alias("v"), F.explode("r").alias("r"))
    got = flat.groupBy(*keys).agg(*[F.max(F.when(F.col("r.id") == i, F.col("v"))).alias(f"v{i}") for i in range(2 * len(qs))],
                                  *[F.max(F.when(F.col("r.id") == 2 * j, F.col("r.part"))).alias(f"p{j}") for j in range(len(qs))])
    return got.select(*[F.col(k).alias(b) for b, k in zip(by, keys)],
                      *[_between(F.col(f"v{2 * j}"), F.col(f"v{2 * j + 1}"), F.col(f"p{j}")).alias(f"q{j}") for j in range(len(qs))])


def sum_below(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """``df``, of distinct ``key`` values (see ``keyed``), with the sum of ``value`` over all
    smaller keys.  Each window is over one bucket of a level, and above all over the first
    level's buckets."""
    top, mid = SHIFTS[0], SHIFTS[1]
    zero = F.lit(0).cast("long")
    two = df.groupBy(F.shiftright(key, mid).alias("k")).agg(F.sum(value).alias("c"))
    one = two.groupBy(F.shiftright("k", top - mid).alias("k")).agg(F.sum("c").alias("c"))
    one = one.select(F.col("k").alias("u1"), _running("c")[0].alias("o1"))
    two = two.withColumn("u1", F.shiftright("k", top - mid)).join(one, "u1")
    two = two.select(F.col("k").alias("__u2"), (F.col("o1") + _running("c", "u1")[0]).alias("__o2"))
    rows = df.withColumn("__u2", F.shiftright(key, mid)).join(two, "__u2")
    within = Window.partitionBy("__u2").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn(name, F.col("__o2") + F.coalesce(F.sum(value).over(within), zero)).drop("__u2", "__o2")
