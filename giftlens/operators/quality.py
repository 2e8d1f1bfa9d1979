"""Data-quality checks (V1-V5) folded into one aggregation pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from giftlens.config import ColumnMap
from giftlens.functions.expr import elapsed_micros, strict_double

_C = ColumnMap()
DAYS_PER_YEAR = 365.25


class ValidationError(ValueError):
    pass


def require_columns(df: DataFrame, cols: ColumnMap = _C) -> None:
    """V1: date, donor id and amount must exist (plan-time check)."""
    missing = [c for c in (cols.date, cols.donor_id, cols.amount) if c not in df.columns]
    if missing:
        raise ValidationError(f"Missing required columns: {missing}")


def quality_amount(df: DataFrame, cols: ColumnMap = _C) -> DataFrame:
    """V2+V3: rows, null / negative / zero amounts."""
    a = F.col(cols.amount)
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.count_if(a.isNull()).alias("null_count"),
                  F.count_if(a < 0).alias("negative_count"),
                  F.count_if(a == 0).alias("zero_count"))


def quality_dates(df: DataFrame, cols: ColumnMap = _C) -> DataFrame:
    """V4: date range and span in years (days / 365.25); severity says
    whether the span looks unusual (< 1 or > 50 years) or no date is valid."""
    d = F.col(cols.date)
    t = df.agg(F.count(d).alias("valid_dates"), F.min(d).alias("min_date"), F.max(d).alias("max_date"))
    span_days = F.floor(elapsed_micros(F.col("min_date"), F.col("max_date")) / F.lit(86_400_000_000))
    t = t.withColumn("span_years", span_days / F.lit(DAYS_PER_YEAR))
    return t.withColumn("severity",
                        F.when(F.col("valid_dates") == 0, "error")
                        .when(F.col("span_years") < 1, "warning")
                        .when(F.col("span_years") > 50, "warning")
                        .otherwise("ok"))


def quality_flags(df: DataFrame, cols: ColumnMap = _C) -> DataFrame:
    """V5: per flag, numeric values outside {0, 1}; text counts as valid."""
    flags = [c for c in cols.flags if c in df.columns]
    aggs = [F.count_if(strict_double(F.col(c)).isNotNull()
                       & ~strict_double(F.col(c)).isin(0.0, 1.0)).alias(c) for c in flags]
    wide = df.agg(*aggs)
    return wide.unpivot([], flags, "column", "invalid_count")


def quality_report(df: DataFrame, cols: ColumnMap = _C) -> DataFrame:
    """V2-V5 in one aggregation pass, as rows (check, column, value,
    severity).  The reference's hard errors (empty input, no valid date)
    are raised by the rows themselves when evaluated -- lazily, on the
    executors."""
    require_columns(df, cols)
    a, d = F.col(cols.amount), F.col(cols.date)
    flags = [c for c in cols.flags if c in df.columns]
    aggs = [F.count(F.lit(1)).alias("rows"), F.count_if(a.isNull()).alias("amount_null"),
            F.count_if(a < 0).alias("amount_negative"), F.count_if(a == 0).alias("amount_zero"),
            F.count(d).alias("valid_dates"), F.min(d).alias("min_date"), F.max(d).alias("max_date")]
    aggs += [F.count_if(strict_double(F.col(c)).isNotNull()
                        & ~strict_double(F.col(c)).isin(0.0, 1.0)).alias(f"flag_{c}") for c in flags]
    t = df.agg(*aggs)
    span = F.floor(elapsed_micros(F.col("min_date"), F.col("max_date")) / F.lit(86_400_000_000)) / F.lit(DAYS_PER_YEAR)

    def warn_if(cond):
        return F.when(cond, F.lit("warning")).otherwise(F.lit("ok"))

    def row(check, column, value, severity):
        return F.struct(F.lit(check).alias("check"), F.lit(column).cast("string").alias("column"),
                        value.cast("double").alias("value"), severity.cast("string").alias("severity"))

    n = F.col("rows")
    rows = [
        row("rows", None, n, F.when(n == 0, F.raise_error(F.lit("DataFrame is empty"))).otherwise(F.lit("ok"))),
        row("amount_null", cols.amount, F.col("amount_null"), warn_if(F.col("amount_null") > 0)),
        row("amount_negative", cols.amount, F.col("amount_negative"), warn_if(F.col("amount_negative") > 0)),
        row("amount_zero", cols.amount, F.col("amount_zero"), warn_if(F.col("amount_zero") > 0)),
        row("date_span_years", cols.date, span,
            F.when(F.col("valid_dates") == 0, F.raise_error(F.lit("No valid dates found")))
            .otherwise(warn_if((span < 1) | (span > 50)))),
    ]
    rows += [row("flag_invalid", c, F.col(f"flag_{c}"), warn_if(F.col(f"flag_{c}") > 0)) for c in flags]
    return t.select(F.inline(F.array(*rows)))


def validate(df: DataFrame, cols: ColumnMap = _C) -> DataFrame:
    """Run the checks now (stage 1b): the report is one aggregation; its
    few rows come back so the reference's hard errors raise here."""
    report = quality_report(df, cols)
    rows = report.collect()  # at most 5 + flags rows
    return df.sparkSession.createDataFrame(rows, report.schema)
