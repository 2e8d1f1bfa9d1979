"""Monthly trend kept up to date on a stream of gifts (A3 as an incremental job).

Totals and counts are exact.  Distinct donors can't be kept exactly without every
donor's id in the state, so each month holds a mergeable HyperLogLog sketch of fixed
size: with 2^12 registers its standard error is 1.04 / sqrt(4096) = 1.6 %.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from giftlens.config import ColumnMap
from giftlens.functions.agg import money
from giftlens.functions.expr import month_label, month_start, safe_div

_C = ColumnMap()
LG_REGISTERS = 12


def standard_error(lg_registers: int = LG_REGISTERS) -> float:
    return 1.04 / 2 ** (lg_registers / 2)


def month_trend(gifts: DataFrame, late: str, cols: ColumnMap = _C, lg_registers: int = LG_REGISTERS) -> DataFrame:
    """Per month total, count and donor sketch of a stream (or table) of gifts.

    A month's state is dropped once the newest month is ``late`` ahead of it (e.g.
    ``"400 days"``); gifts that come later than that are not counted.  Gifts without a
    date are in no month."""
    month = month_start(F.col(cols.date)).cast("timestamp")
    g = gifts.filter(F.col(cols.date).isNotNull()).withColumn("MonthStart", month).withWatermark("MonthStart", late)
    return g.groupBy("MonthStart").agg(
        F.sum(money(F.col(cols.amount))).alias("amount"), F.count(F.lit(1)).alias("donation_count"),
        F.hll_sketch_agg(F.col(cols.donor_id), F.lit(lg_registers)).alias("donors"))


def run_month_trend(gifts: DataFrame, out_dir: str, checkpoint_dir: str, late: str = "400 days", cols: ColumnMap = _C) -> None:
    """Process what has landed, write the changed months of each batch, stop.  A batch that
    is run again after a failure overwrites its own folder only."""
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_dir}/batch={number}")

    (month_trend(gifts, late, cols).writeStream.outputMode("update").foreachBatch(write)
     .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start().awaitTermination())


def read_month_trend(spark: SparkSession, out_dir: str) -> DataFrame:
    """The latest state of every month, newest first, as in the batch report."""
    rows = spark.read.parquet(out_dir)
    latest = rows.groupBy("MonthStart").agg(F.max("batch").alias("batch"))
    t = rows.join(latest, ["MonthStart", "batch"])
    total, donors = F.col("amount").cast("double"), F.hll_sketch_estimate("donors")
    return t.select(month_label(F.col("MonthStart")).alias("Month"), total.alias("total_amount"), donors.alias("donors_estimate"),
                    "donation_count", safe_div(total, F.col("donation_count")).alias("avg_amount_per_donation")).orderBy(F.desc("Month"))
