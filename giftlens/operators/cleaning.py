"""Ingest typing and preprocessing.

Every rule is a column expression; a whole stage is one ``select`` so the
cleaning of a wide frame is a single projection inside whole-stage
codegen.  Order follows the reference: type conversion (C1-C4) at load,
then temporal features, flag mapping, categorical normalisation and the
positive-amount filter (C5, C7, C6, C8).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from giftlens.config import ColumnMap
from giftlens.functions.expr import (DATE_FORMATS, flag_value, month_label, month_start,
                                     normalize_categorical, null_tokens_to_null,
                                     parse_flag, parse_timestamp, strict_double)

_C = ColumnMap()


def null_tokens(df: DataFrame) -> DataFrame:
    """Default missing-value spellings in string columns -> null."""
    return df.select(*[
        null_tokens_to_null(F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, StringType) else F.col(f.name)
        for f in df.schema.fields])


def coerce_amount(df: DataFrame, cols: ColumnMap = _C) -> DataFrame:
    """Amount -> double; unparseable, NaN -> null."""
    if cols.amount not in df.columns:
        return df
    return df.withColumn(cols.amount, strict_double(F.col(cols.amount)))


def normalize_id(df: DataFrame, cols: ColumnMap = _C, null_id: str | None = "nan") -> DataFrame:
    """Donor id as trimmed string (leading zeros kept).  A missing id
    becomes the literal ``null_id`` (reference parity: ``"nan"``); pass
    ``None`` to keep nulls."""
    if cols.donor_id not in df.columns:
        return df
    c = F.trim(F.col(cols.donor_id).cast("string"))
    if null_id is not None:
        c = F.coalesce(c, F.lit(null_id))
    return df.withColumn(cols.donor_id, c)


def parse_dates(df: DataFrame, cols: ColumnMap = _C, extra_formats: tuple[str, ...] = ()) -> DataFrame:
    """C4: day-first date parsing of the gift date and birth date, by the known
    formats and then ``extra_formats``."""
    out = df
    for c in (cols.date, cols.birthdate):
        if c and c in out.columns and not _is_timestamp(out, c):
            out = out.withColumn(c, parse_timestamp(F.col(c), DATE_FORMATS + tuple(extra_formats)))
    return out


def date_parse_loss(raw: DataFrame, cols: ColumnMap = _C, extra_formats: tuple[str, ...] = ()) -> DataFrame:
    """C4 warning: non-null raw dates that failed to parse, per column."""
    formats = DATE_FORMATS + tuple(extra_formats)
    checks = [c for c in (cols.date, cols.birthdate) if c and c in raw.columns]
    aggs = []
    for c in checks:
        aggs.append(F.struct(F.lit(c).alias("column"),
                             (F.count(F.col(c)) - F.count(parse_timestamp(F.col(c), formats))).alias("lost")))
    return raw.agg(F.array(*aggs).alias("a")).select(F.inline("a"))


def type_conversions(df: DataFrame, cols: ColumnMap = _C, null_id: str | None = "nan",
                     extra_formats: tuple[str, ...] = ()) -> DataFrame:
    """C1-C4 as the loader applies them to an all-string input."""
    return parse_dates(normalize_id(coerce_amount(null_tokens(df), cols), cols, null_id), cols, extra_formats)


def add_temporal(df: DataFrame, cols: ColumnMap = _C) -> DataFrame:
    """Year, MonthPeriod (month start) and Month ('yyyy-MM')."""
    if cols.date not in df.columns:
        return df
    d = F.col(cols.date)
    return df.withColumns({"Year": F.year(d), "MonthPeriod": month_start(d),
                           "Month": month_label(d)})


def map_flags(df: DataFrame, cols: ColumnMap = _C) -> DataFrame:
    """Relationship flags -> int (truthy/falsy words, else numeric,
    else 0; out-of-domain numbers are kept, truncated)."""
    return df.withColumns({c: parse_flag(F.col(c)) for c in cols.flags if c in df.columns})


def normalize_categoricals(df: DataFrame, cols: ColumnMap = _C) -> DataFrame:
    """Trim; empty, 'nan' and null -> 'Missing'.  Absent columns are
    skipped (the reference raises on them, trap X14)."""
    return df.withColumns({c: normalize_categorical(F.col(c))
                           for c in cols.categoricals if c in df.columns})


def positive_amounts(df: DataFrame, cols: ColumnMap = _C) -> DataFrame:
    """Keep amount > 0 (null and NaN fail)."""
    a = F.col(cols.amount)
    return df.filter((a > 0) & ~F.isnan(a))


def flag_anomalies(df: DataFrame, cols: ColumnMap = _C) -> DataFrame:
    """Rows whose flag maps to a number other than 0/1, long form
    (ID, FlagColumn, Value) -- one scan for all flags via unpivot."""
    flags = [c for c in cols.flags if c in df.columns]
    if not flags:
        return df.sparkSession.createDataFrame([], f"{cols.donor_id} string, FlagColumn string, Value double")
    vals = df.select(F.col(cols.donor_id), *[flag_value(F.col(c)).alias(c) for c in flags])
    long = vals.unpivot([cols.donor_id], flags, "FlagColumn", "Value")
    return long.filter(F.col("Value").isNotNull() & ~F.col("Value").isin(0.0, 1.0))


def year_slice(df: DataFrame, year_cutoff: int) -> DataFrame:
    """Year >= cutoff (null years drop)."""
    return df.filter(F.col("Year") >= F.lit(year_cutoff))


def drop_null_dates(df: DataFrame, cols: ColumnMap = _C) -> DataFrame:
    """C11."""
    return df.dropna(subset=[cols.date])


def dedup_exact(df: DataFrame) -> DataFrame:
    """C14 (promised by the reference's guide, never coded): drop exact
    duplicate rows."""
    return df.dropDuplicates()


def preprocess(df: DataFrame, cols: ColumnMap = _C) -> DataFrame:
    """Stage 2: temporal -> flags -> categoricals -> positive amounts."""
    return positive_amounts(normalize_categoricals(map_flags(add_temporal(df, cols), cols), cols), cols)


def preprocess_stats(typed: DataFrame, cols: ColumnMap = _C) -> DataFrame:
    """Rows and columns before and after preprocessing, one pass."""
    after_cols = preprocess(typed, cols).columns
    a = F.col(cols.amount)
    new_cols = sorted(set(after_cols) - set(typed.columns))
    return typed.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if((a > 0) & ~F.isnan(a)).alias("rows_after"),
    ).select("rows_before", "rows_after",
             (F.col("rows_before") - F.col("rows_after")).alias("rows_removed"),
             F.lit(len(typed.columns)).alias("cols_before"),
             F.lit(len(after_cols)).alias("cols_after"),
             F.lit(",".join(new_cols)).alias("new_columns"))


def _is_timestamp(df: DataFrame, c: str) -> bool:
    return df.schema[c].dataType.typeName() in ("timestamp", "timestamp_ntz", "date")
