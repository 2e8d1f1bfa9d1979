"""Sinks (S4-S11): landing, cleaned data, reports, anomalies, metrics,
manifest, models and run records.  Every sink is a distributed write to
a (shared) path; nothing is funnelled through the driver."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from giftlens.config import ColumnMap

# Fixed order in which the reference lists its outputs; the rest follow
# alphabetically.
PRIORITY = ("prospecting_playbook", "rfm_table", "lapsed_targets", "high_potential_sleeper",
            "upgrade_candidates", "new_donors_90d", "dist_suburb", "relationship_summary",
            "relationship_agegroup", "relationship_trend", "trend_year", "trend_year_major",
            "trend_month", "dist_gender", "dist_agegroup", "dist_occupation", "dist_religion",
            "appeal_performance", "fund_performance", "lapsed_12m", "propensity_model_comparison",
            "major_gift_model_comparison")


def write_landing(df: DataFrame, path: str) -> None:
    """Raw extract to the landing zone (atomic job commit replaces the
    reference's delete-partial-file-on-failure)."""
    df.write.mode("overwrite").parquet(path)


def write_cleaned(df: DataFrame, path: str) -> None:
    """Every cleaned row, all years, partitioned by Year so later
    slices prune partitions."""
    df.write.mode("overwrite").partitionBy("Year").parquet(path)


def write_cleaned_by_donor(df: DataFrame, table: str, path: str, buckets: int, cols: ColumnMap = ColumnMap()) -> DataFrame:
    """S5 as a table bucketed and sorted by donor: what groups or joins by donor reads it
    without a shuffle.  One file a bucket; a donor's gifts are in one bucket, so choose
    buckets for the table's size.  Returns the table."""
    (df.repartition(buckets, cols.donor_id).write.mode("overwrite").bucketBy(buckets, cols.donor_id).sortBy(cols.donor_id)
     .option("path", path).saveAsTable(table))
    return df.sparkSession.table(table)


def write_reports(reports: dict[str, DataFrame], out: str, run_date: _dt.date | None = None) -> dict[str, str]:
    """One parquet dataset per report under ``run_date=...``; the path of each."""
    run_date = run_date or _dt.date.today()
    paths = {}
    for name, df in reports.items():
        p = f"{out.rstrip('/')}/run_date={run_date.isoformat()}/{name}"
        df.write.mode("overwrite").parquet(p)
        paths[name] = p
    return paths


def write_anomalies(df: DataFrame, path: str) -> None:
    """Flag anomalies."""
    df.write.mode("overwrite").parquet(path)


def write_metrics(metrics: dict[str, DataFrame], base: str) -> None:
    """S8 write: one JSON dataset per model, ``{base}/{name}_metrics.json``."""
    for name, df in metrics.items():
        df.coalesce(1).write.mode("overwrite").json(f"{base.rstrip('/')}/{name}_metrics.json")


def flatten_metrics(spark: SparkSession, base: str) -> DataFrame:
    """S8 read + U3: all metric files as one table (columns unioned by name,
    missing -> null) with the source file name first."""
    df = spark.read.json(f"{base.rstrip('/')}/*_metrics.json")
    src = F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/[^/]+$", 1)
    return df.select(src.alias("source_file"), *df.columns)


def report_manifest(reports: dict[str, DataFrame]) -> DataFrame:
    """(source, rows, cols, note, position) per report -- one job: a
    union of per-report counts.  Position follows the fixed priority list,
    then names alphabetically."""
    ordered = [n for n in PRIORITY if n in reports] + sorted(n for n in reports if n not in PRIORITY)
    parts = []
    for pos, name in enumerate(ordered):
        df = reports[name]
        parts.append(df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("source"), "rows", F.lit(len(df.columns)).alias("cols"),
            F.lit(pos).alias("position")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    note = F.concat(F.format_number(F.col("rows"), 0), F.lit(" rows x "), F.col("cols").cast("string"),
                    F.lit(" cols"))
    return out.withColumn("note", note).orderBy("position")


def save_model(model, path: str) -> None:
    """Spark ML writer (replaces pickles)."""
    model.write().overwrite().save(path)


def run_record(spark: SparkSession, started: _dt.datetime, finished: _dt.datetime, records: int,
               params: dict) -> DataFrame:
    """One row describing a run: duration, records, records/second,
    parameter echo.  Append it to a ``runs`` table."""
    secs = (finished - started).total_seconds()
    row = (finished.replace(microsecond=0), secs, records, records / secs if secs > 0 else 0.0,
           {k: str(v) for k, v in params.items()})
    return spark.createDataFrame([row], "execution_date timestamp, duration_seconds double, "
                                        "records_processed long, records_per_second double, "
                                        "config map<string,string>")
