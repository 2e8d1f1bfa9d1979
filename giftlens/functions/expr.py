"""Column expressions shared by the operators.

Everything here returns a ``Column`` built from ``pyspark.sql.functions``
so it stays inside whole-stage codegen; no Python UDFs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's behaviour.
#
# Strings that pandas' CSV reader turns into missing values by default
# (its documented default ``na_values``), matched exactly, no trimming:
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN",
             "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN",
             "None", "n/a", "nan", "null")
# Relationship-flag spellings (after trim + lower-case):
TRUTHY = ("1", "y", "yes", "true", "t")
FALSY = ("0", "n", "no", "false", "f", "")
# Categorical values treated as missing after trim:
MISSING_CATEGORY = "Missing"
MISSING_TOKENS = ("", "nan")
# ---------------------------------------------------------------------------

MICROS_PER_DAY = 86_400_000_000

# A plain decimal number: optional sign, digits with optional fraction, or a
# leading-dot fraction, optional exponent, optional surrounding blanks.  This
# is what a strict numeric parser accepts; Spark's lenient cast would also
# take "12d" (a Java float suffix), which must stay unparseable.
_NUMBER_RE = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"


def _micros_of_day(ts: Column) -> Column:
    return (F.hour(ts).cast("long") * 3_600_000_000
            + F.minute(ts).cast("long") * 60_000_000
            + (F.date_part(F.lit("SECOND"), ts) * 1_000_000).cast("long"))


def elapsed_micros(start: Column, end: Column) -> Column:
    """end - start in microseconds, independent of the session time zone
    (works on TIMESTAMP_NTZ and TIMESTAMP alike)."""
    return (F.datediff(F.to_date(end), F.to_date(start)).cast("long") * MICROS_PER_DAY
            + _micros_of_day(end) - _micros_of_day(start))


def elapsed_days(start: Column, end: Column) -> Column:
    """Whole elapsed days from start to end, floored (a timedelta's
    ``.days``): time of day counts, unlike ``datediff``."""
    return F.floor(elapsed_micros(start, end) / F.lit(MICROS_PER_DAY)).cast("long")


def add_days(ts: Column, days) -> Column:
    """ts + a fixed number of days (a duration, not a calendar offset)."""
    if isinstance(days, Column):
        return ts + F.make_dt_interval(days.cast("long"))
    return ts + F.make_dt_interval(F.lit(int(days)))


def strict_double(c: Column) -> Column:
    """Parse a string to double; anything not a plain decimal number, and
    NaN/inf, become null."""
    s = c.cast("string")
    parsed = F.when(s.rlike(_NUMBER_RE), F.trim(s).try_cast("double"))
    finite = F.abs(parsed) < F.lit(float("inf"))              # false for NaN too
    return F.when(finite, parsed)


def null_tokens_to_null(c: Column) -> Column:
    return F.when(c.isin(*NA_TOKENS), F.lit(None).cast("string")).otherwise(c)


def parse_flag(c: Column) -> Column:
    """Relationship flag -> int: truthy 1, falsy 0, else numeric
    truncated, else 0.  Out-of-domain numbers (2, 2.7 -> 2) survive."""
    s = F.lower(F.trim(c.cast("string")))
    num = strict_double(c)
    raw = (F.when(c.isNull(), F.lit(None).cast("double"))
           .when(s.isin(*TRUTHY), F.lit(1.0))
           .when(s.isin(*FALSY), F.lit(0.0))
           .otherwise(num))
    # Numbers beyond an int stay out of the domain at its ends.
    top = float(2**31 - 1)
    return F.greatest(F.lit(-top), F.least(F.lit(top), F.coalesce(raw, F.lit(0.0)))).cast("int")


def flag_value(c: Column) -> Column:
    """The numeric value a flag maps to before null -> 0 (for anomalies)."""
    s = F.lower(F.trim(c.cast("string")))
    return (F.when(c.isNull(), F.lit(None).cast("double"))
            .when(s.isin(*TRUTHY), F.lit(1.0))
            .when(s.isin(*FALSY), F.lit(0.0))
            .otherwise(strict_double(c)))


def normalize_categorical(c: Column) -> Column:
    s = F.trim(c.cast("string"))
    return F.when(s.isNull() | s.isin(*MISSING_TOKENS),
                  F.lit(MISSING_CATEGORY)).otherwise(s)


# Day first wherever day and month are both numbers.
DATE_FORMATS = ("d/M/yyyy", "yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "d/M/yyyy H:mm:ss",
                "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss.SSS", "yyyy-MM-dd'T'HH:mm:ss.SSS",
                "d/M/yyyy H:mm", "d/M/yyyy h:mm a", "d/M/yyyy h:mm:ss a", "yyyy-MM-dd HH:mm",
                "d-M-yyyy", "d.M.yyyy", "d MMM yyyy", "d-MMM-yyyy", "d MMMM yyyy", "d/M/yy", "yyyy/M/d", "yyyyMMdd")


def parse_timestamp(c: Column, formats=DATE_FORMATS) -> Column:
    """Timestamp by the first format that fits; unparseable -> null."""
    s = F.trim(c.cast("string"))
    return F.coalesce(*[F.try_to_timestamp(s, F.lit(f)) for f in formats]).cast("timestamp_ntz")


def safe_div(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def pct_change(cur: Column, prev: Column) -> Column:
    """(cur / prev - 1) * 100, the period-over-period growth."""
    return (safe_div(cur, prev) - F.lit(1.0)) * F.lit(100.0)


def order_key(date: Column, seq: Column | None) -> Column:
    """Total order of gifts: by date, then input order."""
    if seq is None:
        return F.struct(date.alias("d"))
    return F.struct(date.alias("d"), seq.alias("s"))


def month_start(ts: Column) -> Column:
    return F.trunc(ts, "MM")


def month_label(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def ntz_lit(value) -> Column:
    """A TIMESTAMP_NTZ literal parsed from text, so no session or process
    time zone is involved."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
