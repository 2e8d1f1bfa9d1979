"""Model metrics as aggregates over prediction tables.

They take any DataFrame of (label, prediction[, score]) -- the output of
a fitted model's ``transform`` or a given table -- and return one-row
DataFrames, so held-out evaluation at scale is a distributed
aggregation, not a driver loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from giftlens.functions.agg import quantile
from giftlens.functions.quantiles import keyed, quantiles, sum_below

ROUND = 9


def auc(df: DataFrame, label: str = "label", score: str = "probability") -> DataFrame:
    """Exact ROC AUC (ties count one half) by rank sums over distinct
    scores.  The negatives below a score are summed up through levels of the
    scores' bits, so scores that crowd together are dealt out as well as
    spread ones; no window holds more than a level's buckets.  Rows without a
    score are in no pair but count in the classes' sizes.  Null when only one
    class is present."""
    s, y = F.col(score).cast("double"), F.col(label)
    per = keyed(df.select(y.alias("y"), s.alias("s")), F.col("s")).groupBy("k").agg(F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") != 1).alias("neg"))
    size = per.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")).select(F.struct("P", "N")).scalar()
    num = sum_below(per, "k", "neg", "below").agg(F.sum(F.col("pos") * (F.col("below") + F.col("neg") * 0.5)).alias("num"))
    return num.withColumn("z", size).select(F.when((F.col("z.P") > 0) & (F.col("z.N") > 0), F.round(
        F.coalesce("num", F.lit(0.0)) / (F.col("z.P") * F.col("z.N")), ROUND)).alias("auc"))


def _per_class(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Per-class support, predicted count and true positives over the
    union of true and predicted labels (one shuffle of a small table)."""
    y, p = F.col(label).cast("string"), F.col(prediction).cast("string")
    pairs = df.groupBy(y.alias("y"), p.alias("p")).agg(F.count(F.lit(1)).alias("n"))
    long = pairs.select(F.explode(F.array(
        F.struct(F.col("y").alias("c"), F.col("n").alias("support"), F.lit(0).cast("long").alias("pred"),
                 F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0).alias("tp")),
        F.struct(F.col("p").alias("c"), F.lit(0).cast("long").alias("support"), F.col("n").alias("pred"),
                 F.lit(0).cast("long").alias("tp")))).alias("x")).select("x.*")
    pc = long.groupBy("c").agg(F.sum("support").alias("support"), F.sum("pred").alias("pred"),
                               F.sum("tp").alias("tp"))
    prec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("pred").cast("double")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support").cast("double")), F.lit(0.0))
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(F.lit(0.0))
    return pc.select("c", "support", "pred", "tp", prec.alias("precision"), rec.alias("recall"), f1.alias("f1"))


def classification_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
                           score: str = "probability", model: str = "model") -> DataFrame:
    """AUC and support-weighted precision, recall, F1, support."""
    pc = _per_class(df, label, prediction)
    w = pc.agg(*[F.round(F.try_divide(F.sum(F.col(m) * F.col("support")),
                                      F.sum("support").cast("double")), ROUND).alias(m)
                 for m in ("precision", "recall", "f1")],
               F.sum("support").alias("support"))
    a = auc(df, label, score).scalar()
    return w.withColumn("auc", a).select(F.lit(model).alias("model"), "auc", "precision", "recall", "f1", "support")


def multiclass_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
                       model: str = "model", target: str = "preference") -> DataFrame:
    """Macro / weighted F1, accuracy, class count."""
    pc = _per_class(df, label, prediction)
    return pc.agg(
        F.round(F.avg("f1"), ROUND).alias("macro_f1"),
        F.round(F.try_divide(F.sum(F.col("f1") * F.col("support")), F.sum("support").cast("double")),
                ROUND).alias("weighted_f1"),
        F.round(F.try_divide(F.sum("tp").cast("double"), F.sum("support").cast("double")), ROUND).alias("accuracy"),
        F.count_if(F.col("support") > 0).alias("n_classes"),
    ).select(F.lit(model).alias("model"), F.lit(target).alias("target"),
             "macro_f1", "weighted_f1", "accuracy", "n_classes")


def regression_metrics(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """MAE, R2 = 1 - SSE/SST (not squared correlation), means."""
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    mean_y = df.agg(F.avg(y)).scalar()
    t = df.withColumn("__m", mean_y).agg(
        F.avg(F.abs(y - p)).alias("MAE"),
        F.sum((y - p) * (y - p)).alias("sse"),
        F.sum((y - F.col("__m")) * (y - F.col("__m"))).alias("sst"),
        F.avg(y).alias("mean_actual"), F.avg(p).alias("mean_predicted"))
    return t.select(F.round("MAE", 6).alias("MAE"),
                    F.round(F.lit(1.0) - F.try_divide(F.col("sse"), F.col("sst")), ROUND).alias("R2"),
                    F.round("mean_actual", 6).alias("mean_actual"),
                    F.round("mean_predicted", 6).alias("mean_predicted"))


def residual_quantiles(df: DataFrame, actual: str = "actual", predicted: str = "predicted",
                       exact: bool = True) -> DataFrame:
    """p20 / median / p80 of residuals (actual - predicted)."""
    r = F.col(actual).cast("double") - F.col(predicted).cast("double")
    qs = [0.2, 0.5, 0.8]
    q = (df.sparkSession.range(1).select(quantiles(df, {"r": r}, qs)["r"].alias("q")) if exact else
         df.agg(quantile(r, qs, False).alias("q")))
    return q.select(F.col("q")[0].alias("residual_p20"), F.col("q")[1].alias("residual_median"),
                    F.col("q")[2].alias("residual_p80"))
