"""MinHash-family near-duplicate detection with SetSketch registers.

A document's set is its distinct five-word shingles.  A SetSketch keeps, for
each of ``m`` hash functions, the minimum over the set on an exponential scale
of base ``b``, truncated to 16 bits: sketches of parts merge by maximum, and
equal registers are as likely as the sets are similar.

Steps:

1. One pass over the texts gives each document its set's 128-bit hash, size and
   sketch.  Documents with equal sets form a class; only classes go on, so a
   text copied a million times costs one row.
2. Registers are banded; each band is a bucket key.  Buckets of one class are
   dropped, buckets with the same members are one.  A bucket too large for a
   task is dealt into chunks and every pair of chunks becomes a unit, so no
   task holds an unbounded bucket and no pair is lost.
3. In a unit, the joint likelihood of the registers (given the exact set
   sizes) estimates each pair's similarity.  Of the pairs that may link, only a
   maximum spanning forest leaves the unit: at most one row per member.
4. The forest's pairs are confirmed on full shingle sets and joined into
   components.  Units whose members are still apart although further pairs may
   link are then confirmed pair by pair on full sets, and the components are
   computed again.  So nothing rests on a rejected estimate but pairs the
   estimate puts far below the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from giftlens.llm.common import blank_words, cut, read, runs
from giftlens.llm.components import components


@dataclass(frozen=True)
class NearDedupParams:
    """``percent``: link at ``100 * intersection >= percent * union``.
    ``bands * rows`` registers; with 24 x 6 a pair at the threshold 0.85 shares
    no bucket with probability 1e-5.  ``margin``: how far below the threshold an
    estimate may lie and still be confirmed (0.15 is five standard errors).
    ``unit_classes``/``unit_shingles`` bound what one task holds."""

    percent: int = 85
    shingle: int = 5
    bands: int = 24
    rows: int = 6
    base: float = 1.02
    rate: float = 20.0
    margin: float = 0.15
    unit_classes: int = 1024
    unit_shingles: int = 500_000


_U = np.uint64
_MASK = (1 << 64) - 1


def _constants(n: int, seed: int) -> np.ndarray:
    r = np.random.default_rng(seed).integers(0, 1 << 63, size=n, dtype=np.uint64)
    return (r << _U(1)) | _U(1)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return h ^ (h >> _U(32))


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_set(words: list[bytes], k: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the ``k``-word shingles; with fewer words the
    whole sequence is one shingle; without words the set is empty."""
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    size = min(n, k)
    mul = _constants(k, 11)
    h = np.full(n - size + 1, _U(size), np.uint64)
    for i in range(size):
        h += w[i:n - size + 1 + i] * mul[i]
    return np.unique(_mix(h))


def sketch(shingles: np.ndarray, mul: np.ndarray, p: NearDedupParams) -> np.ndarray:
    """SetSketch registers: floor(1 - log_b(min of Exp(rate) hashes)), 16 bits."""
    low = np.full(len(mul), _MASK, np.uint64)
    for at in range(0, len(shingles), 1024):
        x = mul[:, None] * shingles[None, at:at + 1024]
        x ^= x >> _U(29)
        x *= _U(0xBF58476D1CE4E5B9)
        x ^= x >> _U(32)
        np.minimum(low, x.min(axis=1), out=low)
    e = -np.log1p(-(low.astype(np.float64) + 0.5) / 2.0**64) / p.rate
    e = np.maximum(e, 1e-300)
    return np.clip(np.floor(1.0 - np.log(e) / np.log(p.base)), 0, 65535).astype(np.uint16)


def _set_key(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def _sketches(p: NearDedupParams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, mul = WordHashes(), _constants(p.bands * p.rows, 7)
        for b in batches:
            n, ck, sk = [], [], []
            for text in b.column(0):
                s = shingle_set(blank_words(text.as_py()), p.shingle, hashes)
                n.append(len(s))
                ck.append(_set_key(s) if len(s) else None)
                sk.append(sketch(s, mul, p).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[1:], pa.array(n, pa.int64()), pa.array(ck, pa.binary()),
                 pa.array(sk, pa.binary())], names=[*b.schema.names[1:], "n_shingles", "ck", "sketch"])
    return run


def _matrix(col: pa.ChunkedArray | pa.Array) -> np.ndarray:
    rows = col.to_pylist()
    return np.frombuffer(b"".join(rows), np.uint16).reshape(len(rows), -1)


def _band_keys(p: NearDedupParams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mul = _constants(p.rows, 13)
        for b in batches:
            if not b.num_rows:
                continue
            k = _matrix(b.column(1)).reshape(-1, p.bands, p.rows).astype(np.uint64)
            h = _mix((k * mul).sum(axis=2) + np.arange(p.bands, dtype=np.uint64) * mul[0])
            ck = b.column(0).take(pa.array(np.repeat(np.arange(b.num_rows), p.bands)))
            n = b.column(2).take(pa.array(np.repeat(np.arange(b.num_rows), p.bands)))
            yield pa.RecordBatch.from_arrays(
                [ck, n, pa.array(h.reshape(-1).view(np.int64))], names=["ck", "n", "key"])
    return run


def joint_similarity(more: np.ndarray, less: np.ndarray, same: np.ndarray,
                     nu: np.ndarray, nv: np.ndarray, base: float) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of pairs of sets of known sizes.

    ``more``/``less``/``same``: registers of U above, below and equal to V's.
    With shares u and v of the sizes, a register of U is above V's with
    probability p(u - vJ), below with p(v - uJ), where
    p(x) = -log_b(1 - x(b-1)/b).  The likelihood is concave in J."""
    u = nu / (nu + nv)
    v = 1.0 - u
    c = (base - 1.0) / base
    ln = np.log(base)

    def loglik(j):
        a = -np.log1p(-np.maximum(u - v * j, 0) * c) / ln
        b = -np.log1p(-np.maximum(v - u * j, 0) * c) / ln
        tiny = 1e-12
        return (more * np.log(np.maximum(a, tiny)) + less * np.log(np.maximum(b, tiny))
                + same * np.log(np.maximum(1 - a - b, tiny)))

    lo, hi = np.zeros_like(u), np.minimum(u / v, v / u)
    for _ in range(24):
        third = (hi - lo) / 3
        up = loglik(lo + third) < loglik(hi - third)
        lo, hi = np.where(up, lo + third, lo), np.where(up, hi, hi - third)
    return (lo + hi) / 2


def _forest(order, us, vs, n: int) -> list[int]:
    """Positions in ``order`` of the edges of a spanning forest."""
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    kept, left = [], n - 1
    for e in order:
        a, b = find(us[e]), find(vs[e])
        if a != b:
            root[b] = a
            kept.append(e)
            left -= 1
            if not left:
                break
    return kept


def _estimate_unit(t: pa.Table, p: NearDedupParams):
    """Forest of a unit's pairs that may link, and whether more such pairs exist."""
    k = _matrix(t.column("sketch"))
    n = t.column("n").to_numpy().astype(np.float64)
    chunk = t.column("chunk").to_numpy()
    low = p.percent / 100.0
    us, vs, est = [], [], []
    for i in range(len(n) - 1):
        js = np.arange(i + 1, len(n))
        if chunk[0] != chunk[-1] or t.column("i")[0].as_py() != t.column("j")[0].as_py():
            js = js[chunk[js] != chunk[i]]           # the other pairs have units of their own
        js = js[np.minimum(n[js], n[i]) >= low * np.maximum(n[js], n[i]) - 1e-9]
        if not len(js):
            continue
        same = (k[js] == k[i]).sum(axis=1)
        js, same = js[same >= (low - 2 * p.margin) * k.shape[1]], same[same >= (low - 2 * p.margin) * k.shape[1]]
        if not len(js):
            continue
        more = (k[js] < k[i]).sum(axis=1)
        s = joint_similarity(more, k.shape[1] - same - more, same,
                             np.full(len(js), n[i]), n[js], p.base)
        ok = s >= low - p.margin
        us.append(np.full(int(ok.sum()), i))
        vs.append(js[ok])
        est.append(s[ok])
    if not us:
        return [], False
    us, vs, est = np.concatenate(us), np.concatenate(vs), np.concatenate(est)
    kept = _forest(np.lexsort((vs, us, -est)).tolist(), us.tolist(), vs.tolist(), len(n))
    return [(int(us[e]), int(vs[e])) for e in kept], len(us) > len(kept)


def _unit_pairs(p: NearDedupParams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, ["key", "i", "j"]):
            if t.num_rows < 2:
                continue
            pairs, more = _estimate_unit(t, p)
            if not pairs:
                continue
            ck = t.column("ck").to_pylist()
            m = len(pairs)
            yield pa.RecordBatch.from_arrays(
                [pa.array([t.column(c)[0].as_py()] * m, pa.int64()) for c in ("key", "i", "j")]
                + [pa.array([min(ck[a], ck[b]) for a, b in pairs], pa.binary()),
                   pa.array([max(ck[a], ck[b]) for a, b in pairs], pa.binary()),
                   pa.array([more] * m, pa.bool_())],
                names=["key", "i", "j", "u", "v", "more"])
    return run


def _exact_unit(sets: dict[bytes, np.ndarray], percent: int) -> list[tuple[bytes, bytes]]:
    """A spanning forest of the true links among ``sets``."""
    cks = sorted(sets)
    n = np.array([len(sets[c]) for c in cks])
    at = np.concatenate(([0], np.cumsum(n)[:-1]))
    _, ids = np.unique(np.concatenate([sets[c] for c in cks]), return_inverse=True)
    mark = np.zeros(int(ids.max()) + 1, np.int64)
    root = np.arange(len(cks))
    out = []
    for i in range(len(cks) - 1):
        mine = ids[at[i]:at[i] + n[i]]
        mark[mine] = 1
        rest = ids[at[i + 1]:]
        inter = np.add.reduceat(mark[rest], at[i + 1:] - at[i + 1])
        mark[mine] = 0
        linked = np.flatnonzero(100 * inter >= percent * (n[i] + n[i + 1:] - inter)) + i + 1
        for j in linked:
            if root[i] != root[j]:
                root[root == root[j]] = root[i]
                out.append((cks[i], cks[j]))
    return out


def _exact_links(p: NearDedupParams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for t in runs(batches, ["unit"]):
            sets = {}
            for ck, text in zip(t.column("ck").to_pylist(), t.column("text").to_pylist(), strict=True):
                if ck not in sets:
                    sets[ck] = shingle_set(blank_words(text), p.shingle, hashes)
            if len(sets) < 2:
                continue
            out = _exact_unit(sets, p.percent)
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([a for a, _ in out], pa.binary()),
                     pa.array([b for _, b in out], pa.binary())], names=["u", "v"])
    return run


def _own_text(p: NearDedupParams):
    """Drops rows whose text is not the class's (ids that two texts share)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            ok = [_set_key(shingle_set(blank_words(t.as_py()), p.shingle, hashes)) == c.as_py()
                  for c, t in zip(b.column(0), b.column(1), strict=True)]
            yield b.filter(pa.array(ok, pa.bool_()))
    return run


def _confirm(members: DataFrame, texts: DataFrame, p: NearDedupParams) -> DataFrame:
    """Links (u, v) among the members of each unit, on full sets."""
    rows = members.join(texts, "ck").select("unit", "ck", "text")
    return (rows.repartition("unit").sortWithinPartitions("unit")
            .mapInArrow(_exact_links(p), "u binary, v binary"))


def _row_keys(docs: DataFrame) -> list:
    """Columns that tell rows apart, null ids too: the id, two hashes of the
    text and one of the other columns."""
    others = [F.col(c).cast("string") for c in docs.columns if c not in ("doc_id", "text")]
    text = F.col("text").cast("string")
    return [F.col("doc_id").cast("long").alias("key_id"), F.xxhash64(text).alias("key_t1"),
            F.xxhash64(F.lit(1), text).alias("key_t2"),
            F.xxhash64(F.lit(0), *[x for c in others for x in (c.isNull(), c)]).alias("key_row")]


def near_duplicates(docs: DataFrame, params: NearDedupParams = NearDedupParams()) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per row of ``docs``.

    Reads ``doc_id`` and ``text`` only; other columns are ignored, whatever
    their names.  A null or blank text has an empty set, is linked with nothing,
    and is its own component.  Of rows with a null ``doc_id`` the component is
    the smallest id reachable, null if there is none; they are kept only then.
    Repeated rows are equal sets, so they share a component.  An empty table
    gives an empty result.
    """
    base, ids = _classes(docs, [F.col("doc_id").cast("long").alias("doc_id")], params)
    least = ids.groupBy("root").agg(F.min("rep").alias("component_id"))
    ids = ids.join(least, "root").select("ck", "component_id")
    return (base.select("doc_id", "n_shingles", "ck").join(ids, "ck", "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("n_shingles") > 0, F.col("component_id"))
                    .otherwise(F.col("doc_id")).alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def _classes(docs: DataFrame, keys: list, params: NearDedupParams) -> tuple[DataFrame, DataFrame]:
    """``(base, ids)``: the ``keys`` (the id first) with n_shingles and the class
    ck, a row per row of ``docs``; and (ck, rep, root), a row per class."""
    p = params
    rows = docs.select(F.col("text").cast("string").alias("text"), *keys)
    names = rows.columns[1:]
    base = cut(rows.mapInArrow(_sketches(p), ", ".join(f"{c} long" for c in names)
                               + ", n_shingles long, ck binary, sketch binary"))
    classes = cut(base.where("n_shingles > 0")
                  .groupBy("ck", F.col("n_shingles").alias("n"), "sketch")
                  .agg(F.min(names[0]).alias("rep")))
    keys = classes.select("ck", "sketch", "n").mapInArrow(_band_keys(p), "ck binary, n long, key long")
    buckets = (keys.groupBy("key")
               .agg(F.count(F.lit(1)).alias("g"), F.sum("n").alias("total"),
                    F.bit_xor(F.xxhash64("ck")).alias("s1"),
                    F.bit_xor(F.xxhash64("ck", F.lit(1))).alias("s2"))
               .where("g > 1")
               .groupBy("g", "total", "s1", "s2").agg(F.min("key").alias("key"))
               .select("key", F.greatest(F.ceil(F.col("g") / p.unit_classes),
                                         F.ceil(F.col("total") / p.unit_shingles)).alias("chunks")))
    members = (keys.join(buckets, "key")
               .withColumn("chunk", F.expr("pmod(xxhash64(ck, 2), chunks)"))
               .withColumn("other", F.explode(F.expr("sequence(0, chunks - 1)")))
               .select("key", F.least("chunk", "other").alias("i"),
                       F.greatest("chunk", "other").alias("j"), "chunk", "ck"))
    members = cut(members)
    unit = ["key", "i", "j"]
    pairs = cut(members.join(classes.select("ck", "n", "sketch"), "ck")
                .repartition(*unit).sortWithinPartitions(*unit, "chunk", "ck")
                .select(*unit, "chunk", "ck", "n", "sketch")
                .mapInArrow(_unit_pairs(p), "key long, i long, j long, u binary, v binary, more boolean"))

    # Texts of the classes that may link, each once.
    open_units = pairs.where("more").select(*unit).distinct()
    wanted = (pairs.select(F.explode(F.array("u", "v")).alias("ck"))
              .union(members.join(open_units, unit, "left_semi").select("ck")).distinct())
    reps = wanted.join(classes, "ck").select("ck", F.col("rep").alias("rep_id"))
    src = docs.select(F.col("doc_id").cast("long").alias("src_id"), F.col("text").cast("string").alias("text"))
    texts = cut(reps.join(src, reps.rep_id.eqNullSafe(src.src_id)).select("ck", "text")
                .mapInArrow(_own_text(p), "ck binary, text string").dropDuplicates(["ck"]))

    edge = pairs.select("u", "v").distinct().withColumn("unit", F.concat("u", "v"))
    links = cut(_confirm(edge.select("unit", F.explode(F.array("u", "v")).alias("ck")), texts, p))
    roots = components(links)

    left = members.join(open_units, unit, "left_semi").join(
        roots.withColumnRenamed("node", "ck"), "ck", "left").withColumn("root", F.coalesce("root", "ck"))
    apart = left.groupBy(*unit).agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a != b").select(*unit)
    left = cut(left.join(apart, unit, "left_semi")
               .select(F.concat_ws(":", *unit).cast("binary").alias("unit"), "ck"))
    if not left.isEmpty():
        roots = components(links.union(_confirm(left, texts, p)))

    ids = classes.select("ck", "rep").join(roots.withColumnRenamed("node", "ck"), "ck", "left")
    return base, ids.withColumn("root", F.coalesce("root", "ck"))


def drop_near_duplicates(docs: DataFrame, params: NearDedupParams = NearDedupParams()) -> DataFrame:
    """The rows of ``docs`` that stay, all columns: one row of each component,
    that of the smallest id (null ids last, then by the text's hash), and every
    row without words.  Rows are told apart by id, text and the other columns,
    so neither a null nor a shared id takes another text along; only rows equal
    in every column are one document seen twice."""
    names = ["key_id", "key_t1", "key_t2", "key_row"]
    base, ids = _classes(docs, _row_keys(docs), params)
    order = F.struct(F.col("key_id").isNull().alias("last"), *names)
    first = base.where("n_shingles > 0").groupBy("ck").agg(F.min(order).alias("first")).join(ids.select("ck", "root"), "ck")
    stay = first.groupBy("root").agg(F.min("first").alias("first")).select("first.*")
    # Join keys without nulls: rows that stay are told apart where the join puts them.
    plain = [F.col("key_id").isNull().alias("key_none"), F.coalesce("key_id", F.lit(0)).alias("key_some")]
    keys = ["key_none", "key_some", *names[1:]]
    stay = stay.select(*plain, *names[1:], F.lit(True).alias("stays"))
    words = F.coalesce(F.col("text").cast("string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    src = docs.select(F.struct(*docs.columns).alias("row"), words.alias("has_words"), *_row_keys(docs))
    both = src.select("row", "has_words", *plain, *names[1:]).join(stay, keys, "left")
    return both.where(~F.col("has_words") | F.col("stays")).dropDuplicates(keys).select("row.*")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []
    WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g
  FROM w
), d AS (SELECT DISTINCT doc_id, g FROM s),
n AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
i AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS x
  FROM d a JOIN d b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), e AS (
  SELECT u, v FROM i JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v
  WHERE 100 * x >= 85 * (a.n + b.n - x)
), e2 AS (SELECT u, v FROM e UNION ALL SELECT v, u FROM e),
r AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, e2.v FROM r JOIN e2 ON r.b = e2.u
), c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, w.doc_id = c.component_id AS kept
FROM w LEFT JOIN n USING (doc_id) JOIN c ON c.a = w.doc_id
"""
