"""Training rows lie over all cores; forests grown in parts are one forest."""

import tempfile

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from giftlens.config import AnalysisParams, ColumnMap, ModelParams
from giftlens.operators import models
from giftlens.plans import catalog, outputs
from test_batch import _planted

C = ColumnMap()
TREES = ModelParams(rf_n_estimators=10, gbt_n_estimators=2, time_rf_n_estimators=10, amount_rf_n_estimators=10, preference_n_estimators=10,
                    rf_max_depth=5, task_rows=500)
#: Rows by trees for about three parts of ten trees over the planted rows.
PARTED = TREES.with_(tree_rows=20_000)


def one_partition(spark, *drop):
    return _planted(spark).drop(*drop).coalesce(1)


def forests(model):
    return [s for s in model.stages if hasattr(s, "featureImportances")]


def test_rows_are_dealt_by_number(spark):
    one, cores = spark.range(1000).coalesce(1), spark.sparkContext.defaultParallelism
    for n_task, most, want in ((10, 10_000, cores), (10_000, 10_000, 1), (500, 10_000, 2), (10, 100, 10)):
        got = models.dealt(one, 1000, ModelParams(task_rows=n_task, most_task_rows=most))
        assert got.rdd.getNumPartitions() == want
        assert got.agg(F.count("*"), F.sum("id")).first()[:] == (1000, 499_500)


def test_every_model_is_fitted_on_all_cores(spark, monkeypatch):
    """A panel of one partition was fitted by one task."""
    seen = []
    for kind in (models.RandomForestClassifier, models.RandomForestRegressor, models.GBTClassifier, models.LogisticRegression):
        monkeypatch.setattr(kind, "fit", lambda self, df, *a, f=kind.fit: seen.append(df.rdd.getNumPartitions()) or f(self, df, *a))
    models.train_propensity(one_partition(spark, "DaysToNext", "TargetCategory", "FutureMedianAmount"), "ReDonate", C, AnalysisParams(), TREES)
    models.train_time(one_partition(spark, "ReDonate", "TargetCategory", "FutureMedianAmount"), C, AnalysisParams(), TREES)
    models.train_amount(one_partition(spark, "ReDonate", "TargetCategory", "DaysToNext", "CutoffDate"), C, AnalysisParams(), TREES)
    models.train_preference(one_partition(spark, "ReDonate", "DaysToNext", "FutureMedianAmount"), "fund", C, AnalysisParams(), TREES)
    assert seen == [spark.sparkContext.defaultParallelism] * 6


def test_panels_are_evened_out_before_they_are_kept(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(catalog, "_stable", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or df)
    catalog._panel(spark.range(10).coalesce(1))
    assert "REBALANCE_PARTITIONS" in plans[0]


def test_parts_have_all_trees():
    assert models.forest_sizes(500, 1000) == [500]
    for trees, rows in ((500, 6_500_000), (300, 35_000_000), (7, 10**9)):
        sizes = models.forest_sizes(trees, rows)
        assert sum(sizes) == trees and min(sizes) >= 1 and max(sizes) - min(sizes) <= 1
        assert max(sizes) == 1 or (max(sizes) - 1) * rows <= ModelParams().tree_rows


def test_classifier_in_parts(spark):
    panel = one_partition(spark, "DaysToNext", "TargetCategory", "FutureMedianAmount")
    t = models.train_propensity(panel, "ReDonate", C, AnalysisParams(), PARTED, ("RandomForest",))
    m = t.models["RandomForest"]
    assert len(forests(m)) > 1 and sum(f.getNumTrees for f in forests(m)) == 10
    scored = models.model_matrix(panel.limit(40), models.categorical_features(panel, C))
    rows = m.transform(scored).collect()
    for r in rows:
        votes = sum(np.array(tree.predictRaw(r.prop_features).toArray()) / sum(tree.predictRaw(r.prop_features).toArray())
                    for f in forests(m) for tree in f.trees)
        assert r.prop_raw.toArray() == pytest.approx(votes)
        assert r.prop_probability.toArray() == pytest.approx(votes / 10)
        assert r.prop_prediction == float(np.argmax(votes))
    path = tempfile.mkdtemp(prefix="giftlens-parts-") + "/m"
    outputs.save_model(m, path)
    assert [r.prop_probability for r in PipelineModel.load(path).transform(scored).collect()] == [r.prop_probability for r in rows]
    # Numeric slots come first; importances are means over all trees.
    imp = {r.field: r.importance for r in t.importance["RandomForest"].collect()}
    each = np.array([tree.featureImportances.toArray() for f in forests(m) for tree in f.trees]).mean(axis=0)
    assert sum(imp.values()) == pytest.approx(1.0) and imp["Recency"] == pytest.approx(each[0], rel=1e-6)
    assert t.comparison.first().auc > 0.9


def test_regressor_and_preference_in_parts(spark):
    time = models.train_time(one_partition(spark, "ReDonate", "TargetCategory", "FutureMedianAmount"), C, AnalysisParams(), PARTED)
    assert len(forests(time.model)) > 1 and time.metrics.first().R2 > 0.8
    base = one_partition(spark, "ReDonate", "DaysToNext", "FutureMedianAmount")
    for r in time.model.transform(models.model_matrix(base.limit(20), models.categorical_features(base, C), fill="")).collect():
        assert r.ttn_prediction == pytest.approx(np.mean([tree.predict(r.ttn_features) for f in forests(time.model) for tree in f.trees]))
    t = models.train_preference(base, "fund", C, AnalysisParams(), PARTED)
    assert len(forests(t.model)) > 1 and t.metrics.first().accuracy > 0.6


def test_boosting_keeps_no_node_numbers(spark):
    """Each of the 1,500 passes of a boosting wrote every row's node number anew; the model is the same without."""
    rows = (spark.range(400).select(F.when(F.col("id") % 7 < 3, 1.0).otherwise(0.0).alias("y"), F.lit(1.0).alias("w"),
                                    F.array((F.col("id") % 7).cast("double"), (F.col("id") % 11).cast("double")).alias("a"))
            .select("y", "w", models.array_to_vector("a").alias("f")).coalesce(2).cache())
    est = models._classifier("GBT", "f", "y", "w", TREES.with_(gbt_n_estimators=4), "b")
    assert not est.getCacheNodeIds() and est.getMaxIter() == 4 and est.getMaxDepth() == 5
    with_numbers = est.copy().setCacheNodeIds(True).fit(rows)
    assert est.fit(rows).toDebugString.split("\n")[1:] == with_numbers.toDebugString.split("\n")[1:]


def test_moved_rows_lie_beside_their_like(spark):
    """Rows dealt anew came in random order, so a pass over a forest's deep levels found no node's statistics in the cache."""
    rows = spark.range(1000).select((F.col("id") % 10).cast("string").alias("Gender"), F.expr("if(id % 9 = 0, null, id % 13 * 1.0d)").alias("Monetary"),
                                    F.col("id").cast("double").alias("Recency")).coalesce(1)
    assert models._alike(["Gender"], ["Recency", "Monetary"]) == ["Gender", "Monetary", "Recency"]
    got = models.dealt(rows, 1000, ModelParams(task_rows=250), models._alike(["Gender"], ["Recency", "Monetary"]))
    parts = got.rdd.glom().collect()
    assert len(parts) == min(4, spark.sparkContext.defaultParallelism) and sorted(r.Recency for p in parts for r in p) == list(range(1000))
    for p in parts:
        key = [(r.Gender, r.Monetary is not None, r.Monetary or 0.0, r.Recency) for r in p]
        assert key == sorted(key)
    spread = spark.range(100, numPartitions=8)
    assert models.dealt(spread, 100, ModelParams(), ["id"]) is spread


def test_rows_for_all_cores_lie_in_no_more_partitions(spark):
    """Nine partitions on six cores were left as they were: two waves, the second half empty, and unsorted."""
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(1000, numPartitions=2 * cores + 1).withColumn("x", F.expr("(id * 7919) % 1000"))
    for most, want in ((10_000, cores), (1000 // (2 * cores), 2 * cores)):
        got = models.dealt(rows, 1000, ModelParams(task_rows=100, most_task_rows=most), ["x"])
        parts = [[r.x for r in p] for p in got.rdd.glom().collect()]
        assert len(parts) == want and all(p == sorted(p) for p in parts) and sum(map(len, parts)) == 1000
        assert models.dealt(got, 1000, ModelParams(task_rows=100, most_task_rows=most), ["x"]) is got


def test_large_forests_grow_in_parts_that_fit_the_cache():
    """All trees grew at once up to tree_rows, so deep levels' statistics were far larger than the CPU's cache."""
    p = ModelParams()
    assert models.forest_sizes(500, 10_000) == [500] and models.forest_sizes(500, 79_000) == [500]
    for trees, rows in ((500, 650_000), (300, 5_850_000), (400, 470_000)):
        sizes = models.forest_sizes(trees, rows)
        assert sum(sizes) == trees and len(sizes) > 1
        assert max(sizes) <= p.part_trees or min(sizes) * rows >= 0.9 * p.part_rows


def test_parts_of_a_forest_read_kept_rows(spark, monkeypatch):
    """Every pass before the first level, of every part, made the features anew."""
    plans = []
    monkeypatch.setattr(models.RandomForestRegressor, "fit", lambda self, df, *a, f=models.RandomForestRegressor.fit:
                        plans.append(df._jdf.queryExecution().analyzed().toString()) or f(self, df, *a))
    models.train_time(one_partition(spark, "ReDonate", "TargetCategory", "FutureMedianAmount"), C, AnalysisParams(), PARTED)
    assert len(plans) > 1 and all(x.startswith("LogicalRDD") and "\n" not in x.strip() for x in plans)
