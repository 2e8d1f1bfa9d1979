"""Toxicity by cumulative-link ordinal regression on sparse text features.

Grades 0 < 1 < 2 share one weight vector; ordered thresholds separate them:
P(grade <= k | x) = sigmoid(theta_k - w.x).  A document's expected severity is
the sum over k of P(grade > k).  Features are a text's distinct words and their
four- and five-byte beginnings (inflected and compounded insults share a stem).
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from giftlens.llm.common import alnum_words, read


@dataclass(frozen=True)
class ToxicityParams:
    """``max_train``: labelled rows the fit is bounded to, taken by the order of
    a hash of the id (all of them while there are fewer); half of the bound is
    for grade 0, half for the higher grades.  ``max_words``: training rows of
    more words than this are passed over (scoring has no such bound).
    ``min_docs``, ``min_z``: training documents a feature must occur in, and by how
    many standard errors more often in the higher grades.  ``reject_at``:
    expected severity from which a document is rejected."""

    max_train: int = 6000
    max_words: int = 20_000
    min_docs: int = 4
    min_z: float = 5.0
    max_features: int = 2000
    l2: float = 1.0
    steps: int = 200
    reject_at: float = 0.2


def features(text: str | None) -> set[bytes]:
    words = set(alnum_words(text))
    stems = {w[:5] for w in words if len(w) > 5} | {w[:4] for w in words if len(w) > 4}
    return words | {b"~" + s for s in stems}


def _sigmoid(z):
    return 0.5 * (1.0 + np.tanh(0.5 * z))


class OrdinalModel:
    """A fitted cumulative-link model: a weight per feature, ordered thresholds."""

    def __init__(self, weights: dict[bytes, float], thetas: list[float]):
        self.weights, self.thetas = weights, thetas

    def margin(self, text: str | None) -> float:
        w = self.weights
        return sum(w[f] for f in w.keys() & features(text))

    def above(self, margin: float) -> list[float]:
        """P(grade > k) for each threshold k."""
        return [float(_sigmoid(margin - t)) for t in self.thetas]

    def severity(self, text: str | None) -> float:
        return sum(self.above(self.margin(text)))


def fit(texts: list[str | None], grades: list[int], params: ToxicityParams = ToxicityParams(),
        levels: int | None = None) -> OrdinalModel:
    """Penalised maximum likelihood by gradient steps with Adam's scaling.

    Features occur in ``min_docs`` training texts and in the higher grades more
    often than by chance (``min_z`` standard errors; the ``max_features``
    strongest).  Their weights are not negative: harmless words around an insult
    don't excuse it, however many they are.  Thresholds are theta_0 and positive gaps, so they stay
    ordered, also next to a grade without examples.  Without any row of a
    higher grade, or without rows, nothing is ever severe."""
    levels = levels or (max(grades, default=1) + 1)
    y = np.asarray(grades, dtype=np.int64)
    if not len(y) or y.max() == 0:
        return OrdinalModel({}, [30.0 + k for k in range(max(levels - 1, 1))])
    # Hash bins bound the memory: most features are too rare, and a bin's count
    # is no less than its features'.
    bins = np.zeros(1 << 20, np.int32)
    for t in texts:
        at = np.array([zlib.crc32(f) for f in features(t)], np.int64) & (len(bins) - 1)
        np.add.at(bins, at, 1)
    df: Counter = Counter()
    high: Counter = Counter()
    for t, g in zip(texts, grades, strict=True):
        f = {x for x in features(t) if bins[zlib.crc32(x) & (len(bins) - 1)] >= params.min_docs}
        df.update(f)
        if g:
            high.update(f)
    n, share = len(y), float((y > 0).mean())
    score = {f: (high[f] - c * share) / (c * share * (1 - share) + 1e-9) ** 0.5
             for f, c in df.items() if c >= params.min_docs}
    names = sorted((f for f, z in score.items() if z >= params.min_z),
                   key=lambda f: (-score[f], f))[:params.max_features]
    index = {f: i for i, f in enumerate(names)}
    # Each feature's value is its smoothed log-count ratio (higher grades against 0).
    n_high = int((y > 0).sum())
    value = np.array([np.log((high[f] + 0.5) / (n_high + 1.0))
                      - np.log((df[f] - high[f] + 0.5) / (n - n_high + 1.0)) for f in names])
    rows, cols = [], []
    for r, t in enumerate(texts):
        ids = [index[x] for x in index.keys() & features(t)]
        cols.extend(ids)
        rows.extend([r] * len(ids))
    rows, cols = np.asarray(rows, np.int64), np.asarray(cols, np.int64)
    k = levels - 1
    start = np.concatenate([[-np.log(share / (1 - share + 1e-9) + 1e-9)], np.zeros(k - 1)])
    par = np.concatenate([np.zeros(len(names)), start])
    m, v = np.zeros_like(par), np.zeros_like(par)
    one = np.arange(k)[None, :]
    for step in range(1, params.steps + 1):
        w, at = par[:len(names)], par[len(names):]
        gaps = np.exp(at[1:])
        theta = at[0] + np.concatenate([[0.0], np.cumsum(gaps)])
        x = np.bincount(rows, (w * value)[cols], minlength=n)
        up = _sigmoid(x[:, None] - theta[None, :])           # P(grade > k)
        ext = np.concatenate([np.ones((n, 1)), up, np.zeros((n, 1))], axis=1)
        p = np.maximum(ext[np.arange(n), y] - ext[np.arange(n), y + 1], 1e-12)
        d = up * (1 - up)
        # d log p / d theta_k: the cell's lower bound falls, its upper bound rises.
        side = np.where(one == y[:, None] - 1, -1.0, np.where(one == y[:, None], 1.0, 0.0))
        gt = side * d / p[:, None]
        gx = -gt.sum(axis=1)
        g_theta = -gt.sum(axis=0)
        gw = -value * np.bincount(cols, gx[rows], minlength=len(names)) + params.l2 * w
        g_at = np.concatenate([[g_theta.sum()],
                               [g_theta[i + 1:].sum() * gaps[i] for i in range(k - 1)]])
        g_at[1:] += 0.1 * at[1:]                             # unseen grades: gaps stay near 1
        grad = np.concatenate([gw, g_at]) / n
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        par = par - 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        par[:len(names)] = np.maximum(par[:len(names)], 0.0)
    w, at = par[:len(names)] * value, par[len(names):]
    theta = at[0] + np.concatenate([[0.0], np.cumsum(np.exp(at[1:]))])
    return OrdinalModel({f: float(w[i]) for f, i in index.items() if abs(w[i]) > 1e-3}, theta.tolist())


def training_rows(docs: DataFrame, labels: DataFrame, params: ToxicityParams) -> DataFrame:
    """``(text, grade)`` of a bounded sample of the labelled documents.

    Grade 0: not toxic; 1: toxic; 2: toxic and of low quality.  Labels with a
    null id or flag are passed over; an id labelled twice takes its highest
    grade; an id that several documents share gives one row for each."""
    lab = (labels.select(F.col("doc_id").cast("long").alias("lab_id"),
                         F.col("toxic").cast("int").alias("toxic"),
                         F.col("quality").cast("int").alias("quality"))
           .where("lab_id is not null and toxic is not null")
           .groupBy("lab_id").agg(F.max(F.when(F.col("toxic") <= 0, 0)
                                        .when(F.col("quality") == 0, 2).otherwise(1)).alias("grade")))
    half = params.max_train // 2
    order = F.xxhash64("lab_id", F.lit(41))
    some = (lab.where("grade = 0").orderBy(order, "lab_id").limit(half)
            .union(lab.where("grade > 0").orderBy(order, "lab_id").limit(half)))
    src = docs.select(F.col("doc_id").cast("long").alias("lab_id"), F.col("text").cast("string").alias("text"))
    rows = some.join(src, "lab_id").where(F.col("text").isNotNull())
    return (rows.where(F.size(F.split("text", " ")) <= params.max_words)
            .select("text", "grade", order.alias("o"))
            .orderBy("o", "text").limit(params.max_train).select("text", "grade"))


def train(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams()) -> OrdinalModel:
    rows = training_rows(docs, labels, params).collect()   # at most max_train rows
    return fit([r.text for r in rows], [r.grade for r in rows], params, levels=3)


def _severity(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = OrdinalModel(*model.value)
        for b in batches:
            up = [fitted.above(fitted.margin(t.as_py())) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array([round(sum(u), 6) for u in up], pa.float64()),
                pa.array([sum(p >= 0.5 for p in u) for u in up], pa.int32()),
            ], names=["doc_id", "severity", "grade"])
    return run


def score(docs: DataFrame, model: OrdinalModel, params: ToxicityParams = ToxicityParams()) -> DataFrame:
    """``(doc_id, severity, grade, toxic)``, a row per row of ``docs``.

    ``severity``: expected grade; ``grade``: the median grade; ``toxic``:
    severity of at least ``reject_at``.  A null, empty or wordless text has no
    features and gets the prior's low severity.  Whole texts are read; rows are
    scored one by one, so repeated rows and null ids need no rule."""
    bc = docs.sparkSession.sparkContext.broadcast((model.weights, model.thetas))
    out = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _severity(bc), "doc_id long, severity double, grade int")
    return out.withColumn("toxic", F.col("severity") >= params.reject_at)


def drop_toxic(docs: DataFrame, model: OrdinalModel, params: ToxicityParams = ToxicityParams()) -> DataFrame:
    """The rows of ``docs`` that are not rejected, all columns, in one pass."""
    bc = docs.sparkSession.sparkContext.broadcast((model.weights, model.thetas))
    at, limit = docs.columns.index("text"), params.reject_at

    def run(batches):
        fitted = OrdinalModel(*bc.value)
        for b in batches:
            text = b.column(at).cast(pa.string())
            yield b.filter(pa.array([round(fitted.severity(t.as_py()), 6) < limit for t in text], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return score(docs, train(docs, read(spark, sf_dir, "labels")))
