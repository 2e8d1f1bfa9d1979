"""Reading the parquet tables a deployment points us at."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of the data directory (``{sf_dir}/{name}.parquet``), listed
    anew each time, so files that were added are read."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
