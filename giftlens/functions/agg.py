"""Aggregate expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from giftlens.functions.expr import elapsed_micros

# Four decimals below the unit and 24 digits above: amounts keep fractions of a
# cent, and no sum of them overflows.
MONEY = "decimal(28,4)"


def money(c: Column) -> Column:
    """An amount for exact sums; one of 1e24 or more is no amount (null)."""
    return c.try_cast(MONEY)


def money_sum(c: Column) -> Column:
    """Exact, order-independent sum of money: add decimals, cast once."""
    return F.sum(money(c)).cast("double")


def money_avg(c: Column) -> Column:
    """Mean of money: exact sum, then one double division."""
    return F.try_divide(money_sum(c), F.count(c).cast("double"))


def median(c: Column, exact: bool = True) -> Column:
    return quantile(c, 0.5, exact)


def quantile(c: Column, q, exact: bool = True) -> Column:
    """Linear-interpolated quantile(s), rounded to 6 decimals so two engines
    agree to the last digit.  ``exact=False`` uses the bounded-memory
    sketch (``percentile_approx``) for very high-cardinality inputs."""
    if isinstance(q, (list, tuple)):
        if exact:
            arr = F.percentile(c.cast("double"), F.array(*[F.lit(float(x)) for x in q]))
        else:
            arr = F.percentile_approx(c.cast("double"), [float(x) for x in q], 10000)
        return F.transform(arr, lambda x: F.round(x, 6))
    if exact:
        return F.round(F.percentile(c.cast("double"), F.lit(float(q))), 6)
    return F.round(F.percentile_approx(c.cast("double"), float(q), 10000).cast("double"), 6)


def order_number(date: Column, seq: Column | None = None) -> Column:
    """(date, input order) as one decimal in the same order, which hash aggregation can
    update in place, unlike a struct: microseconds, then 20 digits of input order.
    Rows without a date come first, and among equal dates those without a number."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    micros = F.coalesce(elapsed_micros(epoch, date), F.lit(-10**17))
    high = micros.cast("decimal(18,0)") * F.lit("1" + 20 * "0").cast("decimal(21,0)")
    low = F.coalesce(seq.try_cast("decimal(19,0)"), F.lit("-" + 19 * "9").cast("decimal(19,0)")) if seq is not None else F.lit(0).cast("decimal(19,0)")
    return (high + low).cast("decimal(38,0)")


def last_by(value: Column, date: Column, seq: Column | None) -> Column:
    """Value of the latest row by (date, input order); input order is a whole number."""
    return F.max_by(value, order_number(date, seq))
