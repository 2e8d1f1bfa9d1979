"""Benchmark decontamination by Wu-Manber multi-pattern search.

A window is 13 consecutive words of a benchmark item (an item of fewer words,
but not none, is one window).  Documents and windows are written as words
joined by single blanks with a blank at either end, so a window occurs as
words exactly where its bytes occur.

The search slides over a document's bytes.  The last ``block`` bytes of the
position select a shift: how far the position can jump without missing a
pattern.  Where the shift is zero, the block is a pattern's last one; the
patterns filed under that suffix are compared directly.  Short patterns would
make every jump short, so patterns are searched in length classes, each with
tables of its own.

The benchmark goes to the executors in blocks of bounded bytes; each batch of
documents is searched for every block in turn, so neither the driver nor a
task ever holds more than one block of items and one or two blocks of tables.
"""

from __future__ import annotations

from collections import OrderedDict, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from giftlens.llm.common import alnum_words, read

WINDOW = 13
#: Text bytes of one block of benchmark items.
BLOCK_BYTES = 4_000_000
#: Built blocks a Python worker keeps.
BLOCKS_KEPT = 2
#: A document is contaminated if hit words are at least one in this many.
SHARE = 20


class WuManber:
    """Search tables for byte patterns of at least ``shortest`` bytes."""

    def __init__(self, patterns: list[bytes], block: int = 8):
        self.m = min(map(len, patterns))
        self.block = b = max(1, min(block, self.m))
        self.jump = self.m - b + 1
        shift: dict[bytes, int] = {}
        self.ends: dict[bytes, list[tuple[bytes, int]]] = defaultdict(list)
        for i, p in enumerate(patterns):
            for at in range(b, self.m + 1):
                s = p[at - b:at]
                d = self.m - at
                if shift.get(s, self.jump) > d:
                    shift[s] = d
            self.ends[p[self.m - b:self.m]].append((p, i))
        self.shift = shift

    def find(self, text: bytes) -> Iterator[tuple[int, int]]:
        """(start, pattern index) of every occurrence, by start."""
        m, b, jump, n = self.m, self.block, self.jump, len(text)
        shift, ends = self.shift.get, self.ends
        at = m
        while at <= n:
            key = text[at - b:at]
            d = shift(key, jump)
            if d:
                at += d
                continue
            begin = at - m
            for p, i in ends[key]:
                if text.startswith(p, begin):
                    yield begin, i
            at += 1


class Searcher:
    """All windows of some items: distinct windows, the items of each, tables
    by length class."""

    #: Windows under these many bytes get tables of their own.
    CLASSES = (12, 32)

    def __init__(self, items: list[tuple[int | None, bytes]], window: int = WINDOW):
        owners: dict[bytes, set] = defaultdict(set)
        for item, joined in items:
            w = joined.split()
            for i in range(max(1, len(w) - window + 1) if w else 0):
                owners[b" " + b" ".join(w[i:i + window]) + b" "].add(item)
        self.windows = sorted(owners)
        self.owners = [owners[p] for p in self.windows]
        self.words = [p.count(b" ") - 1 for p in self.windows]
        classes: dict[int, list[int]] = defaultdict(list)
        for i, p in enumerate(self.windows):
            classes[sum(len(p) >= c for c in self.CLASSES)].append(i)
        self.tables = [(WuManber([self.windows[i] for i in ids]), ids) for ids in classes.values()]

    def hits(self, text: bytes) -> Iterator[tuple[int, int]]:
        """(index of the first word, window index) of every occurrence."""
        for table, ids in self.tables:
            seen, words = 0, 0
            for start, i in table.find(text):
                words += text.count(b" ", seen, start)
                seen = start
                yield words, ids[i]


_BUILT: OrderedDict[int, Searcher] = OrderedDict()


def _searcher(block) -> Searcher:
    if block.id not in _BUILT:
        _BUILT[block.id] = Searcher(block.value[1], block.value[0])
        while len(_BUILT) > BLOCKS_KEPT:
            _BUILT.popitem(last=False)
    _BUILT.move_to_end(block.id)
    return _BUILT[block.id]


class _Block:
    """A broadcast block and its identity on the workers."""

    def __init__(self, broadcast):
        self.id, self.broadcast = broadcast._jbroadcast.id(), broadcast

    def __getstate__(self):
        return {"id": self.id, "broadcast": self.broadcast}

    @property
    def value(self):
        return self.broadcast.value


def _blocks(benchmark: DataFrame, window: int, block_bytes: int) -> list[_Block]:
    """Broadcast the items, read one partition at a time, ``block_bytes`` apiece."""
    sc = benchmark.sparkSession.sparkContext
    out, part, held = [], [], 0
    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    for item, text in rows.toLocalIterator():
        joined = b" ".join(alnum_words(text))
        if not joined:
            continue
        part.append((item, joined))
        held += len(joined)
        if held >= block_bytes:
            out.append(_Block(sc.broadcast((window, part))))
            part, held = [], 0
    if part:
        out.append(_Block(sc.broadcast((window, part))))
    return out


def _covered(spans: list[tuple[int, int]]) -> int:
    total, upto = 0, 0
    for a, b in sorted(spans):
        total += max(0, b - max(a, upto))
        upto = max(upto, b)
    return total


def _search(blocks: list[_Block], share: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [alnum_words(t.as_py()) for t in b.column(1)]
            count = [len(w) for w in texts]
            texts = [b" " + b" ".join(w) + b" " for w in texts]
            spans: list[list] = [[] for _ in texts]
            items: list[set] = [set() for _ in texts]
            for block in blocks:
                s = _searcher(block)
                for k, text in enumerate(texts):
                    for at, i in s.hits(text):
                        spans[k].append((at, at + s.words[i]))
                        items[k] |= s.owners[i]
            hit = [_covered(x) for x in spans]
            named = [sorted(str(x) for x in ids if x is not None) for ids in items]
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array(count, pa.int64()), pa.array(hit, pa.int64()),
                pa.array(named, pa.list_(pa.string())),
                pa.array([h > 0 and share * h >= n for h, n in zip(hit, count, strict=True)], pa.bool_()),
            ], names=["doc_id", "n_words", "n_hit", "items", "contaminated"])
    return run


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  share: int = SHARE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(doc_id, n_words, n_hit, items, contaminated)``, a row per row of ``docs``.

    ``n_hit``: words inside any occurrence of a window; ``items``: ids, as
    sorted strings, of the items with occurring windows; ``contaminated``:
    ``n_hit > 0`` and ``share * n_hit >= n_words``.  Null and blank texts have
    no words and are clean; null and blank items have no windows.  Items sharing
    an id are one item; an item with a null id is searched for like the others
    but has no id to list.  Rows are judged one by one, so repeated rows and
    null ids need no rule.  An empty benchmark leaves every document clean.
    Reads ``doc_id``/``text`` and ``item_id``/``text`` only.
    """
    blocks = _blocks(benchmark, window, block_bytes)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _search(blocks, share),
        "doc_id long, n_words long, n_hit long, items array<string>, contaminated boolean")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                      share: int = SHARE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The clean rows of ``docs``, all columns, in one pass without a shuffle."""
    blocks = _blocks(benchmark, window, block_bytes)
    judge = _search(blocks, share)
    at = docs.columns.index("text")

    def run(batches):
        for b in batches:
            text = b.column(at).cast(pa.string())
            pair = pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(b.num_rows, np.int64)), text], names=["doc_id", "text"])
            for out in judge(iter([pair])):
                yield b.filter(pa.array([not x for x in out.column(4).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(len(ws), 13) AS k, unnest(list_transform(
    range(1, greatest(len(ws) - 13, 0) + 2),
    lambda i: array_to_string(ws[i:i + least(len(ws), 13) - 1], ' '))) AS g
  FROM b WHERE len(ws) > 0
), ks AS (SELECT DISTINCT k FROM win),
occ AS (
  SELECT doc_id, k, unnest(range(1, len(ws) - k + 2)) AS pos, ws FROM d, ks WHERE len(ws) >= k
), hit AS (
  SELECT o.doc_id, o.pos, o.k, w.item_id FROM (
    SELECT doc_id, k, pos, array_to_string(ws[pos:pos + k - 1], ' ') AS g FROM occ) o
  JOIN win w ON w.k = o.k AND w.g = o.g
), words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
    SELECT doc_id, unnest(range(pos, pos + k)) AS p FROM hit) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
    sha256(string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR)) AS h
  FROM hit GROUP BY doc_id
)
SELECT d.doc_id, len(d.ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, coalesce(h, sha256('')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.ws) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
