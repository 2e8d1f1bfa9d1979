"""Conversation prefix trie: a node for every distinct prefix of turns, with its
conversations, children, leaves and the tokens that sharing the prefix saves.

* Conversations with the same turns are one path with a number of members.
* A path is cut into layers of ``span`` turns.  Below one boundary prefix, a
  layer's paths are dealt into shards by their shortest prefix that at most
  ``shard`` paths share, so a common first turn is many shards.
* A shard's task numbers its turns densely, packs the paths into a double array
  (BASE and CHECK), and walks them through it for the nodes' aggregates.
* Prefixes above the shards are shared by several: every shard gives its part of
  their aggregates, and Spark merges the parts.
* A path that is alone below a boundary is a tail: its nodes need no trie.
* Totals of deeper layers come to the boundary nodes by pointer doubling.

Prefixes are known by the XOR of their turns' position-dependent 128-bit hashes.
XOR can be summed up in parts, so a conversation that holds a third of all rows
is never gathered: ranks and prefixes are sums over pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from giftlens.llm.common import cut, read, runs

FAMILY, HEADS = 5, 9        # fixed by the contract: c - c % 5 lends crc32(c) % 9 turns
EMPTY_SHA = sha256(b"").hexdigest()


@dataclass(frozen=True)
class TrieParams:
    """``span``: turns of a layer; ``shard``: most distinct paths of a shard, so a
    task holds ``span * shard`` turns at most."""

    span: int = 32
    shard: int = 512


def ranked_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, t1, t2, nb): turns numbered from 0 within their conversation by
    (turn, nulls first, role, text), with a 128-bit hash and the text's bytes.

    Rows are sorted by range, so a long conversation spans several tasks; each
    adds its rows' place to the rows of earlier tasks.  Rows without a conv_id
    belong to no conversation and are left out."""
    t = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # The row number only parts equal rows, so that many of them span tasks, too.
    order = ["conv_id", "turn", "role", "text", "row"]
    t = t.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    t = cut(t.select("conv_id", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"),
                     F.xxhash64("role", "text").alias("t1"), F.xxhash64(F.lit(1), "text", "role").alias("t2"),
                     F.octet_length("text").cast("long").alias("nb")))
    pieces = t.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    pieces = pieces.select("conv_id", "part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"))
    return t.join(pieces, ["conv_id", "part"]).select("conv_id", (F.col("at") + F.col("shift")).alias("pos"), "t1", "t2", "nb")


def rebuild(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(paths, convs)``: the rebuilt conversations' turns (c, d, t1, t2, nb, z1, z2),
    d from 1, and all conversations (c).  The lender's turns are at most eight."""
    lent = F.pmod(F.crc32(F.col("c").cast("string").cast("binary")), F.lit(HEADS))
    turns = cut(turns.withColumnRenamed("conv_id", "c"))
    heads = turns.where(F.col("pos") < HEADS - 1).groupBy(F.col("c").alias("lender")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "t1", "t2", "nb"))).alias("head"))
    convs = turns.select("c").distinct().withColumn("h", lent)
    convs = convs.withColumn("lender", F.col("c") - F.col("c") % FAMILY).join(heads, "lender", "left")
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h").cast("int")), F.array().cast("array<struct<pos:bigint,t1:bigint,t2:bigint,nb:bigint>>"))
    convs = cut(convs.select("c", "h", head.alias("head")))
    taken = convs.select("c", F.explode("head").alias("x")).select("c", (F.col("x.pos") + 1).alias("d"), "x.t1", "x.t2", "x.nb")
    shift = convs.select("c", (F.size("head") - F.col("h")).alias("shift"))
    own = (turns.where(F.col("pos") >= lent).join(shift, "c")
           .select("c", (F.col("pos") + F.col("shift") + 1).alias("d"), "t1", "t2", "nb"))
    paths = taken.union(own).withColumns({"z1": F.xxhash64("d", "t1", "t2"), "z2": F.xxhash64(F.lit(1), "d", "t1", "t2")})
    return cut(paths), convs.select("c")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (n, x1, x2, c): a row for each run of equal (n, x1, x2) in a batch, with
    its smallest c, its number and its ids comma-joined."""
    for b in batches:
        if not b.num_rows:
            continue
        n, x1, x2, c = (b.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        new = np.flatnonzero((n[1:] != n[:-1]) | (x1[1:] != x1[:-1]) | (x2[1:] != x2[:-1])) + 1
        lo = np.concatenate(([0], new))
        hi = np.concatenate((new, [len(c)]))
        ids = c.tolist()
        yield pa.RecordBatch.from_arrays(
            [pa.array(n[lo]), pa.array(x1[lo]), pa.array(x2[lo]), pa.array(c[lo]), pa.array(hi - lo, pa.int64()),
             pa.array([",".join(map(str, ids[a:z])) for a, z in zip(lo.tolist(), hi.tolist())], pa.string())],
            names=["n", "x1", "x2", "c", "members", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks sorted by (n, x1, x2, c): a row for each path, with the SHA-256 over
    its chunks, one after the other; one chunk is held at a time."""
    key, out, state = None, [], None

    def close():
        out.append((*key, first, members, state.hexdigest()))

    def rows():
        cols = list(zip(*out))
        return pa.RecordBatch.from_arrays([*[pa.array(x, pa.int64()) for x in cols[:5]], pa.array(cols[5], pa.string())],
                                          names=["n", "x1", "x2", "c", "members", "ends"])

    for b in batches:
        for k1, k2, k3, c, m, ids in zip(*[b.column(i).to_pylist() for i in range(6)]):
            if (k1, k2, k3) == key:
                state.update(b"," + ids.encode())
                members += m
                continue
            if key is not None:
                close()
            key, first, members, state = (k1, k2, k3), c, m, sha256(ids.encode())
            if len(out) >= 10_000:
                yield rows()
                out.clear()
    if key is not None:
        close()
    if out:
        yield rows()


def distinct_paths(paths: DataFrame, convs: DataFrame) -> DataFrame:
    """(n, c, members, ends): a row for each distinct sequence of turns, with its
    smallest conversation and the hash of all.  Members are sorted by range and
    joined in chunks first, so a sequence of many members is several tasks' work
    and few rows in the last one."""
    path = paths.groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.bit_xor("z1").alias("x1"), F.bit_xor("z2").alias("x2"))
    zero = F.lit(0).cast("long")
    path = convs.join(path, "c", "left").select(*[F.coalesce(k, zero).alias(k) for k in ("n", "x1", "x2")], "c")
    order = ["n", "x1", "x2", "c"]
    chunks = path.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _chunks, "n long, x1 long, x2 long, c long, members long, ids string")
    return (chunks.repartition("n", "x1", "x2").sortWithinPartitions(*order)
            .mapInArrow(_digests, "n long, x1 long, x2 long, c long, members long, ends string"))


class DoubleArray:
    """A trie over dense labels from 1 in two arrays: the child of state s by label x
    is t = BASE[s] + x if CHECK[t] = s.  State 0 is the root."""

    def __init__(self, paths: list[list[int]]):
        self.base, self.check, self._low = [0], [0], 1
        order = sorted(range(len(paths)), key=paths.__getitem__)
        todo = [(0, 0, len(order), 0)]
        while todo:
            state, lo, hi, d = todo.pop()
            while lo < hi and len(paths[order[lo]]) == d:
                lo += 1
            if lo == hi:
                continue
            starts, labels = [lo], [paths[order[lo]][d]]
            for i in range(lo + 1, hi):
                x = paths[order[i]][d]
                if x != labels[-1]:
                    starts.append(i)
                    labels.append(x)
            at = self._place(labels)
            self.base[state] = at
            for x, a, z in zip(labels, starts, [*starts[1:], hi]):
                self.check[at + x] = state
                todo.append((at + x, a, z, d + 1))

    def _place(self, labels: list[int]) -> int:
        """The first base at which all of the labels' slots are free."""
        check, top = self.check, len(self.check)
        while self._low < top and check[self._low] >= 0:
            self._low += 1
        at = max(self._low - labels[0], 0)
        while not all(at + x >= top or check[at + x] < 0 for x in labels):
            at += 1
        if (more := at + labels[-1] + 1 - top) > 0:
            check.extend([-1] * more)
            self.base.extend([0] * more)
        return at

    def child(self, state: int, label: int) -> int:
        t = self.base[state] + label
        return t if 0 < t < len(self.check) and self.check[t] == state else -1


_PACKED = "layer long, p1 long, p2 long, k int, h1 long, h2 long, c long, members long, ends string, goes_on boolean, " \
          "t1 array<long>, t2 array<long>, z1 array<long>, z2 array<long>, nb array<long>"
_NODE = "kind string, layer long, p1 long, p2 long, depth long, h1 long, h2 long, g1 long, g2 long, conv_id long, " \
        "parent_conv long, n_convs long, n_children long, n_leaves long, saved long, own_saved long, nb long, " \
        "ends string, goes_on boolean, a1 array<long>, a2 array<long>"


def shard_nodes(shard: list[tuple], span: int) -> list[tuple]:
    """Rows of ``_NODE`` for one shard's rows of ``_PACKED``: its nodes, and its part
    of the prefixes above (kind ``part``).  Leaves and savings are the layer's."""
    layer, p1, p2, k = shard[0][:4]
    dense: dict = {}
    paths = []
    for r in shard:
        paths.append([dense.setdefault(t, len(dense) + 1) for t in zip(r[10][k - 1:], r[11][k - 1:])])
    trie = DoubleArray(paths)
    size = len(trie.check)
    convs, least, level, ends, more = [0] * size, [None] * size, [0] * size, [None] * size, [False] * size
    h1, h2, nb = [0] * size, [0] * size, [0] * size
    top1, top2 = [p1], [p2]                              # prefixes above the shard, from the boundary on
    for a, b in zip(shard[0][12][:k - 1], shard[0][13][:k - 1]):
        top1.append(top1[-1] ^ a)
        top2.append(top2[-1] ^ b)
    order = []
    for r, path in zip(shard, paths):
        c, members, s, a, b = r[6], r[7], 0, top1[-1], top2[-1]
        for i, label in enumerate(path, k - 1):
            s = trie.child(s, label)
            a, b = a ^ r[12][i], b ^ r[13][i]
            if not convs[s]:
                level[s], h1[s], h2[s], nb[s] = i + 1, a, b, r[14][i]
                order.append(s)
            convs[s] += members
            least[s] = c if least[s] is None else min(least[s], c)
        if path:
            ends[s] = r[8] if r[8] is not None else ends[s]
            more[s] = more[s] or r[9]
    children, leaves, saved = [0] * size, [0] * size, [0] * size
    order.sort(key=level.__getitem__, reverse=True)
    for s in order:
        leaves[s] += not children[s] and not more[s]
        saved[s] += (convs[s] - 1) * nb[s]
        if level[s] > k:
            up = trie.check[s]
            children[up] += 1
            leaves[up] += leaves[s]
            saved[up] += saved[s]
    out = []
    for s in order:
        up = trie.check[s]
        own = level[s] == k                              # its parent is above the shard
        out.append(("node", layer, p1, p2, layer * span + level[s], h1[s], h2[s], top1[-1] if own else h1[up],
                    top2[-1] if own else h2[up], least[s], None if own else least[up], convs[s], children[s], leaves[s],
                    saved[s], (convs[s] - 1) * nb[s], nb[s], ends[s], more[s], None, None))
    all_convs, all_least = sum(r[7] for r in shard), min(r[6] for r in shard)
    tops = [s for s in order if level[s] == k]
    for j in range(0 if layer == 0 else 1, k):
        here = [r for r, path in zip(shard, paths) if not path and j == k - 1]
        sha = [r[8] for r in here if r[8] is not None]
        out.append(("part", layer, p1, p2, layer * span + j, top1[j], top2[j], top1[j - 1] if j else None,
                    top2[j - 1] if j else None, all_least, None, all_convs, 0, sum(leaves[s] for s in tops),
                    sum(saved[s] for s in tops), 0, shard[0][14][j - 1] if j else 0, sha[0] if sha else None,
                    any(r[9] for r in here), top1[:j + 1], top2[:j + 1]))
    return out


def _build(span: int):
    schema = pa.schema([(n, {"string": pa.string(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64())}
                         .get(t, pa.int64())) for n, t in (x.split(" ") for x in _NODE.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), schema)], schema=schema)

        for t in runs(batches, ["layer", "k", "h1", "h2"]):
            shard = list(zip(*[t.column(i).to_pylist() for i in range(t.num_columns)]))
            out += shard_nodes(shard, span)
            if len(out) >= 20_000:
                yield rows()
                out.clear()
        if out:
            yield rows()
    return run


def _xor(c) -> Column:
    return F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(x))


def _before(df: DataFrame, c: str, at: str, cols: list[str]) -> DataFrame:
    """``df`` with ``b_COL``: XOR over the rows of the same ``c`` with a smaller ``at``,
    summed in blocks, so that no task takes all rows of one c."""
    df = df.withColumn("block", F.floor(F.col(at) / 64))
    behind = Window.unboundedPreceding, -1
    block = df.groupBy(c, "block").agg(*[F.bit_xor(x).alias(x) for x in cols])
    over = Window.partitionBy(c).orderBy("block").rowsBetween(*behind)
    zero = F.lit(0).cast("long")
    block = block.select(c, "block", *[F.coalesce(F.bit_xor(x).over(over), zero).alias(f"s_{x}") for x in cols])
    within = Window.partitionBy(c, "block").orderBy(at).rowsBetween(*behind)
    df = df.select("*", *[F.coalesce(F.bit_xor(x).over(within), zero).alias(f"b_{x}") for x in cols])
    df = df.join(block, [c, "block"])
    return df.withColumns({f"b_{x}": F.col(f"b_{x}").bitwiseXOR(F.col(f"s_{x}")) for x in cols}).drop(
        "block", *[f"s_{x}" for x in cols])


def _shards(rows: DataFrame, p: TrieParams) -> DataFrame:
    """``rows`` with (k, h1, h2): each path's shard, its shortest prefix of the layer that
    at most ``shard`` paths share, or all of it."""
    done, k = None, 1
    while True:
        first = [F.col(f"p{i}").bitwiseXOR(_xor(F.slice(f"z{i}", F.lit(1), F.lit(k)))).alias(f"h{i}") for i in (1, 2)]
        rows = rows.select("*", F.lit(k).alias("k"), *first)
        hot = cut(rows.where(F.size("z1") >= k).groupBy("layer", "h1", "h2").count().where(F.col("count") > p.shard))
        if hot.isEmpty():
            return rows if done is None else done.unionByName(rows)
        dealt = rows.join(hot, ["layer", "h1", "h2"], "left")
        # A path that ends above a crowded prefix is a shard of its own kind.
        crowded = F.col("count").isNotNull() & (F.size("z1") >= k)
        ready = dealt.where(~crowded).drop("count")
        done = ready if done is None else done.unionByName(ready)
        rows, k = cut(dealt.where(crowded).drop("count", "k", "h1", "h2")), k + 1


def _totals(groups: DataFrame) -> DataFrame:
    """(layer, p1, p2, leaves, saved, children) of everything below each boundary, from the layers'
    own (layer, p1, p2, q1, q2, ...), q being the boundary one layer up: by pointer
    doubling, after r rounds a boundary has the sums of 2^r layers."""
    total = groups.select("layer", "p1", "p2", "leaves", "saved", "children")
    up = groups.where("layer > 1").select("layer", "p1", "p2", F.col("q1").alias("u1"), F.col("q2").alias("u2"))
    step = 1
    while not up.isEmpty():
        far = (total.join(up, ["layer", "p1", "p2"]).groupBy((F.col("layer") - step).alias("layer"), F.col("u1").alias("p1"), F.col("u2").alias("p2"))
               .agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s")))
        zero = F.lit(0).cast("long")
        total = cut(total.join(far, ["layer", "p1", "p2"], "left").select(
            "layer", "p1", "p2", (F.col("leaves") + F.coalesce("l", zero)).alias("leaves"),
            (F.col("saved") + F.coalesce("s", zero)).alias("saved"), "children"))
        next_up = up.select((F.col("layer") + step).alias("layer"), F.col("p1").alias("v1"), F.col("p2").alias("v2"),
                            F.col("layer").alias("l0"), "p1", "p2", "u1", "u2")
        a = up.select("layer", "p1", "p2", F.col("u1").alias("m1"), F.col("u2").alias("m2"), (F.col("layer") - step).alias("ml"))
        b = next_up.select(F.col("l0").alias("ml"), F.col("v1").alias("m1"), F.col("v2").alias("m2"), "u1", "u2")
        up = cut(a.join(b, ["ml", "m1", "m2"]).select("layer", "p1", "p2", "u1", "u2"))
        step *= 2
    return total


def prefix_trie(conversations: DataFrame, p: TrieParams = TrieParams()) -> DataFrame:
    """A row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256``.

    Turns are ordered by (turn, nulls first, role, text); null roles and texts
    are empty, repeated rows are repeated turns.  Rows with a null conv_id are
    in no conversation.  Empty texts save nothing.  A table without a
    conversation has no node, not even the root.  Other columns are ignored.
    """
    paths, convs = rebuild(ranked_turns(conversations))
    path = cut(distinct_paths(paths, convs))
    seg = (paths.join(path.select("c"), "c").groupBy("c", F.floor((F.col("d") - 1) / p.span).alias("layer"))
           .agg(F.sort_array(F.collect_list(F.struct("d", "t1", "t2", "z1", "z2", "nb"))).alias("s")))
    seg = seg.join(path.select("c", "n", "members", "ends"), "c")
    last = (F.col("layer") + 1) * p.span >= F.col("n")
    arrays = [F.col(f"s.{f}").alias(f) for f in ("t1", "t2", "z1", "z2", "nb")]
    seg = cut(seg.select("layer", "c", "n", "members", F.when(last, F.col("ends")).alias("ends"), (~last).alias("goes_on"), *arrays))
    zero = F.lit(0).cast("long")
    none = F.array().cast("array<long>")
    turnless = path.where("n = 0").select(zero.alias("layer"), "c", "n", "members", "ends", F.lit(False).alias("goes_on"),
                                          *[none.alias(f) for f in ("t1", "t2", "z1", "z2", "nb")])
    base = [zero.alias("p1"), zero.alias("p2")]
    short = seg.where(F.col("n") <= p.span).union(turnless).select("*", *base)
    long = seg.where(F.col("n") > p.span)
    deep = not long.isEmpty()
    if deep:
        long = long.select("*", _xor("z1").alias("x1"), _xor("z2").alias("x2"))
        long = cut(_before(long, "c", "layer", ["x1", "x2"]).withColumnsRenamed({"b_x1": "p1", "b_x2": "p2"}))
        crowd = long.groupBy("layer", "p1", "p2").agg(F.sum("members").alias("crowd"))
        alone = long.where("layer > 0").join(crowd.where("crowd = 1"), ["layer", "p1", "p2"]).groupBy("c").agg(F.min("layer").alias("tail"))
        long = cut(long.join(alone, "c", "left"))
        tails = long.where("layer >= tail")
        shared = long.where("tail is null or layer < tail")
        # Paths that go on alike are one path of the layer.
        on = shared.where("goes_on").groupBy("layer", "p1", "p2", "x1", "x2").agg(
            F.min("c").alias("c"), F.first("n").alias("n"), F.sum("members").alias("members"),
            *[F.first(f).alias(f) for f in ("t1", "t2", "z1", "z2", "nb")])
        on = cut(on.select("layer", "c", "n", "members", F.lit(None).cast("string").alias("ends"), F.lit(True).alias("goes_on"),
                           "t1", "t2", "z1", "z2", "nb", "p1", "p2", "x1", "x2"))
        short = short.unionByName(shared.where("not goes_on").select(*short.columns)).unionByName(on.select(*short.columns))
    dealt = _shards(short.drop("n"), p)
    fields = [x.split(" ")[0] for x in _PACKED.split(", ")]
    keys = ["layer", "k", "h1", "h2"]
    nodes = cut(dealt.select(*fields).repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_build(p.span), _NODE))
    keep = ["layer", "p1", "p2", "depth", "h1", "h2", "g1", "g2", "conv_id", "parent_conv", "n_convs", "n_children",
            "n_leaves", "saved", "own_saved", "ends", "goes_on"]
    upper = nodes.where("kind = 'part'").groupBy("h1", "h2").agg(
        *[F.max(x).alias(x) for x in ("layer", "p1", "p2", "depth", "g1", "g2", "nb", "ends", "goes_on")],
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_leaves").alias("below"),
        F.sum("saved").alias("deeper"), F.first("a1").alias("a1"), F.first("a2").alias("a2"))
    upper = cut(upper.withColumn("own_saved", (F.col("n_convs") - 1) * F.col("nb")))
    node = nodes.where("kind = 'node'")
    up = (upper.select(F.explode(F.arrays_zip("a1", "a2")).alias("a"), "own_saved")
          .groupBy(F.col("a.a1").alias("h1"), F.col("a.a2").alias("h2")).agg(F.sum("own_saved").alias("within")))
    # Children below a boundary are counted with the deeper layer.
    inside = "g1 is not null and (layer = 0 or g1 != p1 or g2 != p2)"
    kids = (node.where("parent_conv is null").where(inside).select("g1", "g2").union(upper.where(inside).select("g1", "g2"))
            .groupBy(F.col("g1").alias("h1"), F.col("g2").alias("h2")).agg(F.count(F.lit(1)).alias("kids")))
    upper = upper.join(up, ["h1", "h2"], "left").join(kids, ["h1", "h2"], "left")
    upper = upper.select(
        "layer", "p1", "p2", "depth", "h1", "h2", "g1", "g2", "conv_id", F.lit(None).cast("long").alias("parent_conv"),
        "n_convs", F.coalesce("kids", zero).alias("n_children"),
        F.when(F.col("kids").isNull() & ~F.col("goes_on"), F.lit(1).cast("long")).otherwise(F.col("below")).alias("n_leaves"),
        (F.col("deeper") + F.coalesce("within", zero)).alias("saved"), "own_saved", "ends", "goes_on")
    upper = cut(upper)
    every = node.select(*keep).union(upper.select(*keep))
    parents = node.where("goes_on").select("h1", "h2", "conv_id").union(upper.select("h1", "h2", "conv_id"))
    if deep:
        every, parents = _join_layers(every, parents, on, tails, p)
    open_parent = every.where("parent_conv is null")
    parents = parents.select(F.col("h1").alias("g1"), F.col("h2").alias("g2"), F.col("conv_id").alias("found"))
    named = open_parent.join(parents, ["g1", "g2"], "left").withColumn("parent_conv", F.col("found")).select(*every.columns)
    out = every.where("parent_conv is not null").union(named)
    return out.select("conv_id", "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                      F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.lit(EMPTY_SHA)).alias("ends_sha256"))


def _join_layers(every: DataFrame, parents: DataFrame, on: DataFrame, tails: DataFrame, p: TrieParams) -> tuple[DataFrame, DataFrame]:
    """The nodes with what lies in deeper layers, and the nodes of the tails."""
    zero = F.lit(0).cast("long")
    one = F.lit(1).cast("long")
    every = cut(every)
    # What each layer has below its boundary; a tail is one leaf and saves nothing.
    inner = every.where("layer > 0").groupBy("layer", "p1", "p2").agg(
        F.sum(F.when((F.col("n_children") == 0) & ~F.col("goes_on"), 1).otherwise(0)).alias("leaves"), F.sum("own_saved").alias("saved"),
        F.sum(((F.col("g1") == F.col("p1")) & (F.col("g2") == F.col("p2"))).cast("long")).alias("children"))
    first = tails.where("layer = tail").select("layer", "p1", "p2", one.alias("leaves"), zero.alias("saved"), one.alias("children"))
    ahead = on.select((F.col("layer") + 1).alias("layer"), F.col("p1").bitwiseXOR(F.col("x1")).alias("b1"),
                      F.col("p2").bitwiseXOR(F.col("x2")).alias("b2"), F.col("p1").alias("q1"), F.col("p2").alias("q2"))
    groups = inner.union(first).withColumnsRenamed({"p1": "b1", "p2": "b2"}).join(ahead, ["layer", "b1", "b2"]).withColumnsRenamed({"b1": "p1", "b2": "p2"})
    total = _totals(cut(groups)).select(F.col("p1").alias("b1"), F.col("p2").alias("b2"), "leaves", F.col("saved").alias("more_saved"), "children")
    # Every node of a path that goes on has what lies below the path's end.
    on = on.select("layer", "p1", "p2", "z1", "z2", F.col("p1").bitwiseXOR(F.col("x1")).alias("b1"), F.col("p2").bitwiseXOR(F.col("x2")).alias("b2"))
    on = on.join(total, ["b1", "b2"])
    steps = F.sequence(F.when(F.col("layer") == 0, 0).otherwise(1), F.size("z1"))
    at = on.select("*", F.explode(steps).alias("j"))
    at = at.select(*[F.col(f"p{i}").bitwiseXOR(_xor(F.slice(f"z{i}", F.lit(1), F.col("j")))).alias(f"h{i}") for i in (1, 2)],
                   "leaves", "more_saved", F.when(F.col("j") == F.size("z1"), F.col("children")).otherwise(zero).alias("children"))
    more = at.groupBy("h1", "h2").agg(*[F.sum(x).alias(x) for x in ("leaves", "more_saved", "children")])
    cols = every.columns
    every = every.join(more, ["h1", "h2"], "left").withColumns({
        "n_leaves": F.col("n_leaves") + F.coalesce("leaves", zero), "saved": F.col("saved") + F.coalesce("more_saved", zero),
        "n_children": F.col("n_children") + F.coalesce("children", zero)}).select(*cols)
    at = tails.select("*", F.posexplode("z1").alias("j", "z"))
    depth = F.col("layer") * p.span + F.col("j") + 1
    none = F.lit(None).cast("long")
    top = (F.col("layer") == F.col("tail")) & (F.col("j") == 0)
    tail = at.select(
        "layer", "p1", "p2", depth.alias("depth"), none.alias("h1"), none.alias("h2"), F.when(top, F.col("p1")).alias("g1"),
        F.when(top, F.col("p2")).alias("g2"), F.col("c").alias("conv_id"), F.when(~top, F.col("c")).alias("parent_conv"),
        one.alias("n_convs"), (depth < F.col("n")).cast("long").alias("n_children"), one.alias("n_leaves"), zero.alias("saved"),
        zero.alias("own_saved"), F.when(depth == F.col("n"), F.col("ends")).alias("ends"), F.lit(False).alias("goes_on"))
    return every.union(tail.select(*cols)), parents


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(read(spark, sf_dir, "conversations"))


ORACLE = r"""
WITH t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos,
    {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS x
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (SELECT c, list(x ORDER BY pos) AS xs FROM t GROUP BY c),
h AS (
  SELECT c, xs, xor(4294967295::BIGINT, list_reduce(
    [4294967295::BIGINT] || list_transform(string_split(c::VARCHAR, ''), lambda s: ascii(s)::BIGINT),
    lambda a, b: list_reduce([xor(a, b)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0],
      lambda r, z: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END))) % 9 AS h
  FROM own
), p AS (
  SELECT h.c, coalesce(list_slice(o.xs, 1, h.h), []) || list_slice(h.xs, h.h + 1, len(h.xs)) AS path
  FROM h LEFT JOIN own o ON o.c = h.c - h.c % 5
), n AS (
  SELECT c, d, md5(to_json(list_slice(path, 1, d))::VARCHAR) AS node,
    CASE WHEN d > 0 THEN md5(to_json(list_slice(path, 1, d - 1))::VARCHAR) END AS parent,
    d = len(path) AS ends, CASE WHEN d > 0 THEN strlen(path[d].text) ELSE 0 END AS nb
  FROM (SELECT c, path, unnest(range(len(path) + 1)) AS d FROM p)
), g AS (
  SELECT node, any_value(parent) AS parent, any_value(d) AS depth, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(nb) AS own,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM n GROUP BY node
), k AS (SELECT parent, count(*) AS kids FROM g GROUP BY parent),
a AS (SELECT DISTINCT s.node AS top, e.node AS node FROM n s JOIN n e ON s.c = e.c AND s.d <= e.d),
u AS (
  SELECT a.top, sum(g.own)::BIGINT AS saved, count(*) FILTER (k.kids IS NULL) AS leaves
  FROM a JOIN g ON g.node = a.node LEFT JOIN k ON k.parent = g.node GROUP BY a.top
)
SELECT g.conv_id, g.depth::BIGINT AS depth, q.conv_id AS parent_conv_id, g.n_convs, coalesce(k.kids, 0)::BIGINT AS n_children,
  u.leaves AS n_leaves, u.saved AS saved_tokens, g.ends_sha256
FROM g LEFT JOIN g q ON q.node = g.parent LEFT JOIN k ON k.parent = g.node JOIN u ON u.top = g.node
"""
