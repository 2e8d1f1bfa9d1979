"""Delimited-text input read as all strings.

Every column stays a string (no schema inference: a type guessed from a
sample is a type wrong for the rest of 100 TB), header names are trimmed,
and the reference's missing-value spellings become nulls (C1).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from giftlens.operators.cleaning import null_tokens


def read_gifts_csv(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """CSV scan, all strings, header trimmed, NA spellings -> null.  A
    missing path fails at analysis time, as the reference's file check.

    Quotes are doubled inside quoted text, and quoted text may span lines; for
    that a file is one task, so land many files rather than one huge one.  A
    file whose header has other columns or another order than the first fails,
    instead of putting values under the wrong names."""
    df = (spark.read.option("header", True).option("inferSchema", False)
          .option("sep", sep).option("encoding", encoding).option("quote", '"').option("escape", '"')
          .option("multiLine", True).option("enforceSchema", False).option("mode", "PERMISSIVE")
          .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
          .csv(path))
    df = df.toDF(*[c.strip() for c in df.columns])
    return null_tokens(df)


def write_gifts_csv(df: DataFrame, path: str) -> None:
    """Landing a frame as CSV with values byte-for-byte (no trimming)."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))
