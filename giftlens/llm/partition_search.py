"""Approximate nearest neighbours by learned partitions.

A neighbour graph over a bounded sample is cut into balanced parts: breadth-first
runs of equal length, then moves and swaps of vertices that gain inner edges.  A
small network, trained on the parts of each sample row's neighbours, gives every
row its most probable part, so the index holds all rows.  A query goes to its most
probable parts until they hold a share of its probability, which is set on
held-out rows, and all rows there are ranked by their exact cosine.

The cosines of a part are taken in blocks of a bounded number of rows, so a part
that holds a third of all rows is many tasks; each sends on its best few.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from giftlens.llm.common import cut, read, runs
from giftlens.llm.vectors import matrix, usable


@dataclass(frozen=True)
class SearchParams:
    """``sample``: most rows that graph and network are fitted on, a quarter of them
    held out; ``neighbours``: edges of a vertex; ``spread``: a table of n rows has
    sqrt(n) / spread parts, ``parts`` at most; ``slack``: a part's size over the mean;
    ``recall``: share of the held-out rows' neighbours that the queried parts must
    hold; ``block``: rows compared at once, about."""

    sample: int = 8192
    neighbours: int = 10
    spread: float = 8.0
    parts: int = 256
    slack: float = 1.1
    hidden: int = 64
    epochs: int = 30
    rate: float = 0.01
    recall: float = 0.94
    block: int = 4096
    top: int = 5
    seed: int = 13


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1.  Powers of two are taken out first, which changes no bit."""
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True, initial=0))[1])
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``a`` with the same row of ``b``, in double precision: equal
    rows give equal numbers wherever they stand."""
    a = np.ldexp(a, -np.frexp(np.abs(a).max(axis=1, keepdims=True))[1])
    b = np.ldexp(b, -np.frexp(np.abs(b).max(axis=1, keepdims=True))[1])
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


# ---- graph and network, on the sample ------------------------------------------------------

def neighbours(x: np.ndarray, k: int) -> np.ndarray:
    """The k rows nearest to each row of unit vectors, itself left out."""
    k = min(k, len(x) - 1)
    out = np.empty((len(x), k), np.int64)
    for at in range(0, len(x), 512):
        s = x[at:at + 512] @ x.T
        s[np.arange(len(s)), np.arange(at, at + len(s))] = -np.inf
        out[at:at + 512] = np.argpartition(-s, k - 1, axis=1)[:, :k] if k else 0
    return out


def balanced_parts(near: np.ndarray, parts: int, slack: float, sweeps: int = 12) -> np.ndarray:
    """A part for each vertex; none is larger than ``slack`` times the mean (rounded up)."""
    n, k = near.shape
    u, v = np.repeat(np.arange(n), k), near.ravel()
    u, v = np.concatenate((u, v)), np.concatenate((v, u))
    by = np.argsort(u, kind="stable")
    ends, start = v[by], np.searchsorted(u[by], np.arange(n + 1))
    seen, order = np.zeros(n, bool), []
    for root in range(n):
        if seen[root]:
            continue
        seen[root], queue = True, deque([root])
        while queue:
            i = queue.popleft()
            order.append(i)
            for j in ends[start[i]:start[i + 1]].tolist():
                if not seen[j]:
                    seen[j] = True
                    queue.append(j)
    part = np.empty(n, np.int64)
    part[order] = np.arange(n) * parts // n
    most = int(np.ceil(slack * n / parts))
    for _ in range(sweeps):
        count = np.zeros((n, parts), np.int32)
        np.add.at(count, (u, part[v]), 1)
        own = count[np.arange(n), part]
        best = count.argmax(axis=1)
        gain = count[np.arange(n), best] - own
        size = np.bincount(part, minlength=parts)
        waiting: dict = {}
        moved = 0
        for i in np.argsort(-gain, kind="stable").tolist():
            a, b = int(part[i]), int(best[i])
            if gain[i] <= 0:
                break
            if size[b] < most:
                size[a] -= 1
                size[b] += 1
                part[i] = b
                moved += 1
            elif waiting.get((b, a)):                              # full: two vertices change places
                j = waiting[(b, a)].pop()
                part[i], part[j] = b, a
                moved += 2
            else:
                waiting.setdefault((a, b), []).append(i)
        if moved <= n // 500:
            break
    return part


class Router:
    """softmax(tanh(x W1 + b1) W2 + b2) over the parts."""

    def __init__(self, size: int, parts: int, p: SearchParams):
        r = np.random.default_rng(p.seed)
        self.par = [r.standard_normal((size, p.hidden)) / np.sqrt(size), np.zeros(p.hidden),
                    r.standard_normal((p.hidden, parts)) / np.sqrt(p.hidden), np.zeros(parts)]

    def _forward(self, x):
        w1, b1, w2, b2 = self.par
        h = np.tanh(x @ w1 + b1)
        z = h @ w2 + b2
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return h, e / e.sum(axis=1, keepdims=True)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return self._forward(x * np.sqrt(x.shape[1]))[1]

    def fit(self, x: np.ndarray, target: np.ndarray, p: SearchParams) -> None:
        """Cross entropy with the target shares, by Adam in batches."""
        x, r = x * np.sqrt(x.shape[1]), np.random.default_rng(p.seed)
        m, s, step = [np.zeros_like(w) for w in self.par], [np.zeros_like(w) for w in self.par], 0
        for _ in range(p.epochs):
            for rows in np.array_split(r.permutation(len(x)), max(1, len(x) // 256)):
                h, prob = self._forward(x[rows])
                dz = (prob - target[rows]) / len(rows)
                dh = (dz @ self.par[2].T) * (1 - h * h)
                grad = [x[rows].T @ dh, dh.sum(axis=0), h.T @ dz, dz.sum(axis=0)]
                step += 1
                for i, g in enumerate(grad):
                    m[i] = 0.9 * m[i] + 0.1 * g
                    s[i] = 0.99 * s[i] + 0.01 * g * g
                    self.par[i] -= p.rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(s[i] / (1 - 0.99**step)) + 1e-8)


def before(prob: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(order, mass)``: parts by falling probability, and how much stands before each."""
    order = np.argsort(-prob, axis=1, kind="stable")
    ranked = np.take_along_axis(prob, order, axis=1)
    return order, np.cumsum(ranked, axis=1) - ranked


def fit(sample: np.ndarray, rows: int, p: SearchParams = SearchParams()) -> tuple[Router, float]:
    """``(router, share)`` from sample vectors of a table of ``rows``.  The share of its
    probability that a query's parts must hold is the least with which the held-out
    rows' nearest held-out rows are found; those lie farther off than the nearest of
    the whole table, so the whole table's recall is no lower as a rule."""
    x = unit(np.unique(sample, axis=0)) if len(sample) else sample
    x = x[np.random.default_rng(p.seed).permutation(len(x))]
    parts = max(1, min(p.parts, len(x) // 64, round(rows**0.5 / p.spread)))
    router = Router(x.shape[1] if x.ndim == 2 else 1, parts, p)
    if parts == 1:
        return router, 1.0
    held, used = x[:len(x) // 4], x[len(x) // 4:]
    near = neighbours(used, p.neighbours)
    part = balanced_parts(near, parts, p.slack)
    target = np.zeros((len(used), parts))
    np.add.at(target, (np.repeat(np.arange(len(used)), near.shape[1]), part[near].ravel()), 1.0)
    np.add.at(target, (np.arange(len(used)), part), 1.0)
    router.fit(used, target / target.sum(axis=1, keepdims=True), p)
    prob = router.probabilities(held)
    order, mass = before(prob)
    at = np.empty_like(mass)
    np.put_along_axis(at, order, mass, axis=1)
    needed = np.take_along_axis(at, prob.argmax(axis=1)[neighbours(held, p.top)], axis=1)
    return router, float(np.quantile(needed, p.recall)) + 1e-9


# ---- index and search, on all rows ---------------------------------------------------------

def _map(size: int, of, fields: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                extra = of(unit(matrix(b.column(1), size)))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *extra], schema=fields)
    return run


def _best(ids: np.ndarray, null: np.ndarray, x: np.ndarray, asked: np.ndarray, y: np.ndarray, top: int):
    """(query row, candidate row, score) of each query's best rows of a block."""
    approx = unit(y) @ unit(x).T
    approx[(asked[:, None] == ids[None, :]) & ~null[None, :]] = -np.inf
    k = min(top, approx.shape[1])
    least = -np.partition(-approx, k - 1, axis=1)[:, k - 1]
    q, c = np.nonzero((approx >= least[:, None] - 1e-9) & np.isfinite(approx))
    score = np.concatenate([cosines(y[q[i:i + 50_000]], x[c[i:i + 50_000]]) for i in range(0, len(q), 50_000)] or [np.zeros(0)])
    order = np.lexsort((ids[c], null[c], -score, q))
    q, c, score = q[order], c[order], score[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    return q[place < top], c[place < top], score[place < top]


def _one(t: pa.Table, name: str) -> pa.Array:
    c = t.column(name).combine_chunks()
    return c.chunk(0) if isinstance(c, pa.ChunkedArray) else c


def _compare(size: int, top: int):
    """Rows sorted by (part, block, asked): a block's rows, then its queries."""
    schema = pa.schema([("query_id", pa.int64()), ("query", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, ["part", "block"]):
            t = t.combine_chunks()
            flag = t.column("asked").to_numpy(zero_copy_only=False)
            split = int((~flag).sum())                              # False sorts first
            if not split or split == len(flag):
                continue
            ids = _one(t, "vec_id")
            null = ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
            hashes = t.column("query").to_numpy(zero_copy_only=False)
            vectors = _one(t, "embedding")
            x = matrix(vectors.slice(0, split), size)
            for at in range(split, len(flag), 64):
                to = min(at + 64, len(flag))
                q, c, s = _best(ids[:split], null[:split], x, ids[at:to], matrix(vectors.slice(at, to - at), size), top)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at:to][q]), pa.array(hashes[at:to][q]), pa.array(ids[c], mask=null[c]), pa.array(s)], schema=schema)
    return run


def search(embeddings: DataFrame, asked: str = "vec_id % 50 = 0", p: SearchParams = SearchParams()) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row that the condition ``asked``
    holds for, the nearest rows found by cosine, ties to the smaller vec_id.

    Left out are null, empty and zero vectors, null and non-finite entries, and vectors
    of another length than most.  Rows with a query's vec_id are its own row; queries
    that repeat id and vector are one, other repeated rows are rows.  A null vec_id is
    no query, but a candidate, after others of equal score.  At least ``sample / 64``
    rows are ranked for a query, or all, so small tables give exact results; an empty
    one gives none.  Other columns are ignored.
    """
    rows, size = usable(embeddings)
    spark = rows.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    if not size:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.exists("embedding", lambda x: x != 0))
    mark = F.xxhash64("vec_id", "embedding")
    picked = rows.orderBy(mark, "vec_id").limit(p.sample).select("embedding").toArrow()    # the sample: a bounded number
    if not picked.num_rows:
        return spark.createDataFrame([], schema)
    router, share = fit(matrix(_one(picked, "embedding"), size), rows.count(), p)
    vector = ("vec_id", pa.int64()), ("embedding", pa.list_(pa.float64()))
    parts = pa.schema([*vector, ("part", pa.int32())])
    index = cut(rows.mapInArrow(_map(size, lambda x: [pa.array(router.probabilities(x).argmax(axis=1).astype(np.int32))], parts),
                                "vec_id long, embedding array<double>, part int").withColumn("query", mark))
    sizes = {r.part: r["count"] for r in index.groupBy("part").count().collect()}           # as many rows as parts
    count = np.array([sizes.get(i, 0) for i in range(len(router.par[3]))])
    blocks = F.array(*[F.lit(max(1, -(-int(c) // p.block))) for c in count])
    enough = p.sample // 64

    def route(x):
        order, mass = before(router.probabilities(x))
        ranked = np.cumsum(count[order], axis=1) - count[order]
        go = (mass < share) | (ranked < enough)
        lengths = go.sum(axis=1)
        return [pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lengths))), pa.int32()), pa.array(order[go].astype(np.int32)))]

    routes = pa.schema([*vector, ("to", pa.list_(pa.int32()))])
    queries = rows.where(asked).dropDuplicates(["vec_id", "embedding"]).mapInArrow(
        _map(size, route, routes), "vec_id long, embedding array<double>, to array<int>").withColumn("query", mark)
    queries = queries.select("vec_id", "embedding", "query", F.explode("to").alias("part"))
    queries = queries.select("vec_id", "embedding", "query", "part", F.explode(F.sequence(F.lit(0), F.get(blocks, "part") - 1)).alias("block"))
    block = F.pmod("query", F.get(blocks, "part")).cast("int")
    both = index.select("vec_id", "embedding", "query", "part", block.alias("block"), F.lit(False).alias("asked")).union(
        queries.select("*", F.lit(True).alias("asked")))
    found = both.repartition("part", "block").sortWithinPartitions("part", "block", "asked").mapInArrow(
        _compare(size, p.top), "query_id long, query long, vec_id long, score double")
    over = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return (found.withColumn("rank", F.row_number().over(over)).where(F.col("rank") <= p.top)
            .select("query_id", "rank", "vec_id", "score"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read(spark, sf_dir, "embeddings"))
