"""Gift-shaped views over the driver's star-schema tables.

The reference ships no data; these map the test tables onto its input
model (orders as gifts, customers as donors, nations and regions as the
appeal and fund lookups, events as raw string receipts).  They are plain
DataFrame pipelines, so they grow with the tables they read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from giftlens.sources.extract import extract_wide
from giftlens.sources.tables import table

GIFT_COLUMNS = ("ReceiptSeq", "ID", "Date", "Amount", "Appeal", "Fund",
                "AppealDescription", "FundDescription", "Gender", "OccupDesc",
                "ReligionCode", "Suburb", "State", "Education", "CurrentParent",
                "PastParent", "PastStudent", "FutureParent")


def receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("ReceiptSeq"),
        F.col("o_custkey").cast("string").alias("ID"),
        F.col("o_orderdate").alias("Date"),
        F.col("o_totalprice").alias("Amount"),
        F.col("o_orderpriority").alias("Appeal"),
        F.concat(F.lit("F"), (F.col("o_orderkey") % 6).cast("string")).alias("Fund"),
        F.col("o_orderstatus").alias("Education"),
        (F.col("o_orderkey") % 27).cast("int").alias("AppealKey"),
        (F.col("o_orderkey") % 6).cast("int").alias("FundKey"),
    )


def donor_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    k = F.col("c_custkey")
    geo = n.join(r, n.n_regionkey == r.r_regionkey, "left") \
        .select("n_nationkey", F.col("n_name").alias("Suburb"), F.col("r_name").alias("State"))
    return c.join(geo, c.c_nationkey == geo.n_nationkey, "left").select(
        k.cast("string").alias("ID"),
        F.when(k % 4 == 0, "F").when(k % 4 == 1, " M ").when(k % 4 == 2, "").alias("Gender"),
        F.col("c_mktsegment").alias("OccupDesc"),
        F.concat(F.lit("R"), (k % 7).cast("string")).alias("ReligionCode"),
        "Suburb", "State",
        (k % 2).cast("int").alias("CurrentParent"),
        F.when(k % 4 >= 2, 1).otherwise(0).alias("PastParent"),
        F.when(k % 8 >= 4, 1).otherwise(0).alias("PastStudent"),
        F.when(k % 16 >= 8, 1).otherwise(0).alias("FutureParent"),
    )


def appeal_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.select(F.col("n_nationkey").alias("Code"), F.col("n_name").alias("Description"))


def fund_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "region")
    return r.select(F.col("r_regionkey").alias("Code"), F.col("r_name").alias("Description"))


def wide_extract(spark: SparkSession, sf_dir: str, appeals: bool = True, funds: bool = True) -> DataFrame:
    return extract_wide(receipts(spark, sf_dir), donor_attributes(spark, sf_dir),
                        appeal_lookup(spark, sf_dir) if appeals else None,
                        fund_lookup(spark, sf_dir) if funds else None,
                        appeal_on="AppealKey", fund_on="FundKey")


RECEIPT_ONLY = ("ReceiptSeq", "ID", "Date", "Amount", "Appeal", "Fund", "Education")


def gifts(spark: SparkSession, sf_dir: str, columns=None) -> DataFrame:
    """Clean gift transactions (FIXTURES §2 ``gifts``).

    ``columns`` narrows the view; when every requested column lives on
    the receipt itself the donor and lookup joins are skipped altogether
    (they are left joins on unique keys, so rows are unchanged).
    """
    cols = list(columns) if columns else list(GIFT_COLUMNS)
    if all(c in RECEIPT_ONLY for c in cols):
        return receipts(spark, sf_dir).select(*cols)
    return wide_extract(spark, sf_dir, "AppealDescription" in cols, "FundDescription" in cols).select(*cols)


def dirty_gifts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw string receipts exercising every cleaning rule."""
    e = table(spark, sf_dir, "events")
    eid, ts = F.col("event_id"), F.col("ts")
    uid = F.col("user_id").cast("string")
    dd = F.lpad(F.dayofmonth(ts).cast("string"), 2, "0")
    mm = F.lpad(F.month(ts).cast("string"), 2, "0")
    yy = F.year(ts).cast("string")
    return e.select(
        eid.alias("ReceiptSeq"),
        F.when(eid % 13 == 0, "NA").when(eid % 13 == 1, F.concat(F.lit(" 00"), uid, F.lit(" ")))
         .otherwise(F.concat(F.lit("00"), uid)).alias("ID"),
        F.when(eid % 5 == 0, F.concat(dd, F.lit("/"), mm, F.lit("/"), yy))
         .when(eid % 5 == 1, "not a date").when(eid % 5 == 2, F.lit(None).cast("string"))
         .otherwise(F.concat(yy, F.lit("-"), mm, F.lit("-"), dd)).alias("Date"),
        F.when(eid % 11 == 0, "abc").when(eid % 11 == 1, "").when(eid % 11 == 2, "-5")
         .when(eid % 11 == 3, "0").when(eid % 11 == 4, "12d").when(eid % 11 == 5, "NaN")
         .when(eid % 11 == 6, " 12.5 ").otherwise(F.col("value").cast("string")).alias("Amount"),
        F.when(eid % 12 == 0, "Y").when(eid % 12 == 1, " yes ").when(eid % 12 == 2, "T")
         .when(eid % 12 == 3, "1").when(eid % 12 == 4, "1.0").when(eid % 12 == 5, "N")
         .when(eid % 12 == 6, "").when(eid % 12 == 7, "false").when(eid % 12 == 8, "2")
         .when(eid % 12 == 9, "2.7").when(eid % 12 == 10, "maybe").alias("CurrentParent"),
        F.when(eid % 6 == 0, " click").when(eid % 6 == 1, "").when(eid % 6 == 2, F.lit(None).cast("string"))
         .when(eid % 6 == 3, "nan").otherwise(F.col("event_type")).alias("Gender"),
    )


def timed_gifts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gifts with time of day (elapsed-day semantics)."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_id").alias("ReceiptSeq"),
                    F.col("user_id").cast("string").alias("ID"),
                    F.col("ts").alias("Date"), F.col("value").alias("Amount"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Given binary scores, so metric operators have exact oracles."""
    lb = table(spark, sf_dir, "labels")
    return lb.select("doc_id", F.col("quality").alias("label"),
                     F.col("toxic").alias("prediction"),
                     ((F.col("doc_id") * 37) % 101).cast("double").__truediv__(F.lit(100.0)).alias("probability"))


def regression_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_extendedprice").alias("actual"),
                     (F.col("l_quantity") * 1000).alias("predicted"))


def class_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Given multiclass (label, prediction) pairs."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_returnflag").alias("label"),
                     F.when(F.col("l_linestatus") == "F", "R").otherwise("N").alias("prediction"))


def day_residual_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Given (actual, predicted) day counts for residual bands."""
    li = table(spark, sf_dir, "lineitem")
    return li.select((F.col("l_extendedprice") / 1000.0).alias("actual"),
                     F.col("l_quantity").alias("predicted"))
