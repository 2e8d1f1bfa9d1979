"""Masked pseudo-likelihood scores from a bidirectional window network.

The network predicts every token from its neighbours on both sides: an
embedding for the left and one for the right token, a tanh layer, and a softmax
over the corpus' most frequent words, a boundary, and classes of other words.
A word's probability is its class's, times its share of the class by the
corpus' word counts: a word with at least ``rarest`` of all tokens has a share of
its own (so there are at most 1 / ``rarest`` of them, at any size of the corpus),
rarer ones share evenly what they have together.  A document's score is the sum
of the conditional log-probabilities of its tokens.

The network knows words outside its vocabulary by class only, so its counts stop at
V^3.  A corpus' own documents are therefore scored by the counts of real words
besides (``score_corpus``): in a context (left, right) with a word outside the
vocabulary, P = (c + prior * P_network) / (C + prior), where C counts the context and
c the word in it at all other places of the corpus.  The place itself is masked,
so what occurs once has the network's word and what occurs twice is known.  These
counts are over every token and grow with the corpus; they are made where a hash
of the context sends them, and no task or driver holds them all.

With one token a side the network's input
is one of V x V contexts, so

* training needs only the counts of (left, token, right) over the corpus: Spark
  aggregates them over every token of every document, and the network is fitted
  to all of them in numpy, without sampling, in an order-free way that a lost
  executor cannot disturb;
* a fitted network is a table of V x V x V log-probabilities, so scoring a
  token is one lookup.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from giftlens.llm.common import alnum_words, cut, read


@dataclass(frozen=True)
class LmParams:
    """``words``: frequent words with a token of their own; ``classes``: tokens
    for the rest; ``rarest``: share of all tokens from which a word of a class is
    told from others.  With the boundary, V = words + classes + 1; memory is V^3
    floats.  ``smooth``: probability added to every token in a context when the
    table is read off.  ``prior``: the network's weight against counts, in tokens.
    ``piece``: tokens whose places are sent together, and are counted at a time."""

    words: int = 95
    classes: int = 32
    rarest: float = 2.0**-20
    hidden: int = 32
    steps: int = 250
    rate: float = 0.02
    smooth: float = 1e-4
    prior: float = 4.0
    piece: int = 1 << 19
    seed: int = 5

    @property
    def size(self) -> int:
        return self.words + self.classes + 1


def class_of(word: bytes, classes: int) -> int:
    """A rest word's class: by length and last byte."""
    return (min(len(word), 15) * 7 + word[-1]) % classes


class Encoder(dict):
    """Word to token number, or, for words of a class with a share of their own
    (``own``), to ``size`` and their place there; remembers other words up to a bound."""

    def __init__(self, vocabulary: list[bytes], p: LmParams, own: list[bytes] = ()):
        super().__init__({w: p.size + i for i, w in enumerate(own)})
        self.update((w, i + 1) for i, w in enumerate(vocabulary))
        self.fixed, self.p = len(self), p

    def __missing__(self, word: bytes) -> int:
        t = 1 + self.p.words + class_of(word, self.p.classes)
        if len(self) < self.fixed + 300_000:
            self[word] = t
        return t

    def tokens(self, text: str | None) -> np.ndarray:
        """Token numbers between two boundaries (0)."""
        words = alnum_words(text)
        out = np.zeros(len(words) + 2, np.int64)
        out[1:-1] = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return out


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of all words of all documents, counted in each task, then by shuffle."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter
        c: Counter = Counter()

        def rows():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c.keys()), pa.binary()), pa.array(list(c.values()), pa.int64())], names=["word", "n"])
        for b in batches:
            for t in b.column(0):
                c.update(alnum_words(t.as_py()))
                if len(c) > 200_000:
                    yield rows()
                    c.clear()
        if c:
            yield rows()

    return (docs.select(F.col("text").cast("string")).mapInArrow(count, "word binary, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


def vocabulary(docs: DataFrame, p: LmParams, words: DataFrame | None = None) -> list[bytes]:
    """The ``words`` most frequent words, ties by the word."""
    words = word_counts(docs) if words is None else words
    top = words.orderBy(F.desc("n"), "word").limit(p.words).collect()   # the vocabulary: p.words rows
    return [bytes(r.word) for r in top]


@dataclass(frozen=True)
class Shares:
    """Of words within their class: ``own`` words, their tokens and log shares, and for
    each class the log share of any other word."""

    own: list[bytes]
    tokens: np.ndarray
    logs: np.ndarray
    rest: np.ndarray


def shares(words: DataFrame, vocab: list[bytes], p: LmParams) -> Shares:
    """Every class's shares, from the counts of all words; a class's sum to 1."""
    known = words.where(~F.col("word").isin([bytearray(w) for w in vocab])) if vocab else words
    total = words.agg(F.sum("n")).first()[0] or 0
    often = F.col("n") >= max(1, total * p.rarest)
    table = known.where(often).orderBy("word").toArrow()                # at most 1 / rarest words
    own = table.column("word").to_pylist()
    n = table.column("n").to_numpy().astype(np.float64)
    classes = np.array([class_of(w, p.classes) for w in own], np.int64)
    last = F.conv(F.hex(F.substring("word", -1, 1)), 16, 10).cast("long")
    of = (F.least(F.octet_length("word"), F.lit(15)) * 7 + last) % p.classes
    rare = known.where(~often).groupBy(of.alias("c")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("types")).collect()
    mass, types = np.zeros(p.classes), np.ones(p.classes)
    for r in rare:                                                      # a row for each class
        mass[r.c], types[r.c] = r.n, r.types
    # A class without rare words keeps half a count for words that are new.
    mass = np.where(mass > 0, mass, 0.5)
    every = mass + np.bincount(classes, n, p.classes)
    return Shares(own, (1 + p.words + classes).astype(np.int32), np.log(n / every[classes]).astype(np.float32),
                  np.log(mass / types / every).astype(np.float32))


def _trigrams(vocab: list[bytes], p: LmParams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, v = Encoder(vocab, p), p.size
        total = np.zeros(v**3, np.int32)
        for b in batches:
            for t in b.column(0):
                x = enc.tokens(t.as_py())
                if len(x) > 2:
                    np.add.at(total, (x[:-2] * v + x[1:-1]) * v + x[2:], 1)
        at = np.flatnonzero(total)
        for k in range(0, len(at), 100_000):
            part = at[k:k + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int64()), pa.array(total[part].astype(np.int64))], names=["cell", "n"])
    return run


def counts(docs: DataFrame, vocab: list[bytes], p: LmParams) -> np.ndarray:
    """Counts [left, right, token] over all documents.  Each task counts its
    share, Spark adds up the cells; the driver gets at most V^3 numbers,
    however large the corpus."""
    v = p.size
    cells = (docs.select(F.col("text").cast("string")).mapInArrow(_trigrams(vocab, p), "cell long, n long")
             .groupBy("cell").agg(F.sum("n").alias("n")))
    table = cut(cells).toArrow()
    out = np.zeros(v**3, np.float64)
    out[table.column("cell").to_numpy()] = table.column("n").to_numpy()
    return out.reshape(v, v, v).transpose(0, 2, 1)


class WindowNetwork:
    """softmax(U tanh(L[left] + R[right] + a) + b)."""

    def __init__(self, p: LmParams):
        r, v, h = np.random.default_rng(p.seed), p.size, p.hidden
        self.par = {"L": 0.3 * r.standard_normal((v, h)), "R": 0.3 * r.standard_normal((v, h)),
                    "a": np.zeros(h), "U": 0.1 * r.standard_normal((h, v)), "b": np.zeros(v)}

    def _forward(self, left, right):
        q = self.par
        hid = np.tanh(q["L"][left] + q["R"][right] + q["a"])
        z = hid @ q["U"] + q["b"]
        z -= z.max(axis=1, keepdims=True)
        e = np.exp(z)
        return hid, e / e.sum(axis=1, keepdims=True)

    def log_table(self, smooth: float) -> np.ndarray:
        """log P(token | left, right) for all contexts, [left, right, token]."""
        v = len(self.par["b"])
        out = np.empty((v, v, v), np.float32)
        right = np.arange(v)
        for left in range(v):
            prob = self._forward(np.full(v, left), right)[1]
            out[left] = np.log((prob + smooth) / (1 + v * smooth))
        return out

    def fit(self, n: np.ndarray, p: LmParams) -> list[float]:
        """Cross entropy over all counted tokens, by Adam on all contexts at
        once; returns the loss in nats a token at each step."""
        v = p.size
        weight = n.sum(axis=2)
        left, right = np.nonzero(weight)
        if not len(left):
            return []
        w = weight[left, right]
        target = n[left, right] / w[:, None]
        w = w / w.sum()
        m = {k: np.zeros_like(x) for k, x in self.par.items()}
        s = {k: np.zeros_like(x) for k, x in self.par.items()}
        loss = []
        for step in range(1, p.steps + 1):
            hid, prob = self._forward(left, right)
            loss.append(float(-(w * (target * np.log(prob + 1e-12)).sum(axis=1)).sum()))
            dz = (prob - target) * w[:, None]
            dh = (dz @ self.par["U"].T) * (1 - hid**2)
            g = {"U": hid.T @ dz, "b": dz.sum(axis=0), "a": dh.sum(axis=0),
                 "L": np.zeros((v, p.hidden)), "R": np.zeros((v, p.hidden))}
            np.add.at(g["L"], left, dh)
            np.add.at(g["R"], right, dh)
            for k, x in self.par.items():
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                s[k] = 0.99 * s[k] + 0.01 * g[k]**2
                x -= p.rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.99**step)) + 1e-9)
        return loss


def train(docs: DataFrame, p: LmParams = LmParams()) -> tuple[list[bytes], np.ndarray]:
    """``(vocabulary, table)`` of a network fitted to every token of ``docs``.
    Without any word the network stays as initialised."""
    return _train(docs, vocabulary(docs, p), p)


def _train(docs: DataFrame, vocab: list[bytes], p: LmParams) -> tuple[list[bytes], np.ndarray]:
    net = WindowNetwork(p)
    net.fit(counts(docs, vocab, p), p)
    return vocab, net.log_table(p.smooth)


def score(docs: DataFrame, vocab: list[bytes], table: np.ndarray, p: LmParams = LmParams(),
          within: Shares | None = None) -> DataFrame:
    """``(doc_id, n_tokens, pll, mean_pll)``, a row per row of ``docs``: the sum
    of the log-probabilities of all its tokens given both neighbours, and the
    mean.  Without ``within`` they are the classes' probabilities.  Texts are read whole.  Null, empty and wordless texts have no tokens,
    a sum of 0 and a null mean.  Rows are scored one by one: repeated rows get
    equal scores, null ids need no rule."""
    if within is None:
        within = Shares([], np.zeros(0, np.int32), np.zeros(0, np.float32), np.zeros(p.classes, np.float32))
    # V^3 floats (8 MB) and at most 1 / rarest words (2^20, some 20 MB).
    bc = docs.sparkSession.sparkContext.broadcast((vocab, table, within))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, tab, sh = bc.value
        enc = Encoder(words, p, sh.own)
        token = np.concatenate((np.arange(p.size), sh.tokens))
        log = np.concatenate((np.zeros(1 + p.words, np.float32), sh.rest, sh.logs))
        for b in batches:
            n, total = [], []
            for t in b.column(1):
                symbols = enc.tokens(t.as_py())
                x = token[symbols]
                n.append(len(x) - 2)
                total.append(float((tab[x[:-2], x[2:], x[1:-1]].astype(np.float64) + log[symbols[1:-1]]).sum()) if len(x) > 2 else 0.0)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(total, pa.float64())],
                names=["doc_id", "n_tokens", "pll"])

    out = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_tokens long, pll double")
    return _rounded(out)


def _rounded(scores: DataFrame) -> DataFrame:
    return scores.select("doc_id", "n_tokens", F.round("pll", 4).alias("pll"),
                         F.round(F.try_divide("pll", "n_tokens"), 6).alias("mean_pll"))


class _Words(dict):
    """Word to its number in ``hashes`` and ``symbols``; the boundary has number 0."""

    def __init__(self, enc: Encoder):
        super().__init__()
        self.enc, self.new = enc, []
        self.hashes, self.symbols = np.full(1, 0x9E3779B97F4A7C15, np.uint64), np.zeros(1, np.int64)

    def __missing__(self, word: bytes) -> int:
        self[word] = i = len(self) + 1
        self.new.append(word)
        return i

    def learn(self) -> None:
        """Hashes and symbols of the words met since the last call."""
        own = np.frombuffer(b"".join(blake2b(w, digest_size=8).digest() for w in self.new), np.uint64)
        self.hashes = np.concatenate((self.hashes, own))
        self.symbols = np.concatenate((self.symbols, np.fromiter(map(self.enc.__getitem__, self.new), np.int64, len(self.new))))
        self.new = []


def _places(left: np.ndarray, word: np.ndarray, right: np.ndarray) -> np.ndarray:
    """64 bits by word hashes: 48 of the context, then 16 of the word in it."""
    x = left * np.uint64(0xFF51AFD7ED558CCD) + right * np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    return (x & ~np.uint64(0xFFFF)) | (word & np.uint64(0xFFFF))


_ROW = "bucket long, piece long, n int, body binary"
_FINE = 2048.0          # steps of a nat in which a place sends the network's log-probability


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of equal length as planes of their bytes, compressed."""
    planes = [c.view(np.uint8).reshape(len(c), c.itemsize).T.tobytes() for c in columns]
    return pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def _unpack(n: int, body: bytes, *types: str) -> list[np.ndarray]:
    kinds = [np.dtype(t) for t in types]
    raw, at, out = pa.decompress(body, decompressed_size=n * sum(k.itemsize for k in kinds), codec="zstd", asbytes=True), 0, []
    for k in kinds:
        plane = np.frombuffer(raw, np.uint8, n * k.itemsize, at).reshape(k.itemsize, n)
        out.append(plane.T.copy().view(k).ravel())
        at += n * k.itemsize
    return out


def _sent(bc, p: LmParams, bits: int):
    """Of documents: their own rows (bucket -1 - piece: id, tokens, the network's sum),
    and each bucket's places of a piece, sorted: the key, the document's place in the
    piece and the network's log-probability in steps."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        words, tab, sh = bc.value
        enc = Encoder(words, p, sh.own)
        token = np.concatenate((np.arange(p.size), sh.tokens))
        log = np.concatenate((np.zeros(1 + p.words, np.float32), sh.rest, sh.logs))
        index, piece = _Words(enc), TaskContext.get().partitionId() << 32
        ids, texts, held = [], [], 0

        def rows() -> pa.RecordBatch:
            index.learn()
            n = np.array([len(t) for t in texts], np.int64)
            at = np.zeros(n.sum() + len(n) + 1, np.int64)       # a boundary before, between and after
            slot = np.repeat(np.arange(len(n)), n)
            own = np.arange(len(slot)) + slot + 1
            at[own] = np.concatenate(texts)
            symbol, h = index.symbols[at], index.hashes[at]
            x = token[symbol]
            p_net = tab[x[own - 1], x[own + 1], x[own]].astype(np.float64) + log[symbol[own]]
            total = np.bincount(slot, p_net, len(n))
            null = np.array([i is None for i in ids], np.uint8)
            out = [(-1 - piece, piece, len(n), _pack(np.array([i or 0 for i in ids], np.int64), null, n, total))]
            classed = x > p.words
            own, slot, p_net = (c[classed[own - 1] | classed[own + 1]] for c in (own, slot, p_net))
            key = _places(h[own - 1], h[own], h[own + 1])
            order = np.argsort(key)
            key, slot = key[order], slot[order].astype(np.uint32)
            steps = np.minimum(np.rint(-_FINE * p_net[order]), 65535).astype(np.uint16)
            ends = np.searchsorted(key, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else []
            ends = [0, *ends, len(key)]
            for bucket, (a, b) in enumerate(zip(ends, ends[1:])):
                if b > a:
                    out.append((bucket, piece, int(b - a), _pack(np.diff(key[a:b], prepend=np.uint64(0)), slot[a:b], steps[a:b])))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int32(), pa.binary()))],
                                              names=["bucket", "piece", "n", "body"])

        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                words_of = alnum_words(t.as_py())
                ids.append(i)
                texts.append(np.fromiter(map(index.__getitem__, words_of), np.int64, len(words_of)))
                held += len(words_of) + 1
                if held >= p.piece:
                    yield rows()
                    ids, texts, held, piece = [], [], 0, piece + 1
                    if len(index) > 500_000:
                        index = _Words(enc)
        if ids:
            yield rows()
    return run


def _counted(p: LmParams):
    """A bucket's places to what each piece's documents gain by their counts; own rows pass."""
    def run(rows: pa.Table) -> pa.Table:
        if rows.column("bucket")[0].as_py() < 0:
            return rows
        n = rows.column("n").to_numpy()
        parts = [_unpack(k, b.as_py(), "u8", "u4", "u2") for k, b in zip(n, rows.column("body"))]
        key = np.concatenate([np.cumsum(d, dtype=np.uint64) for d, _, _ in parts])
        order = np.argsort(key)
        ranked = key[order]

        def others(x: np.ndarray) -> np.ndarray:
            """For each place, how many others have its value; ``x`` is sorted."""
            new = np.concatenate(([True], x[1:] != x[:-1]))
            times = np.diff(np.append(np.flatnonzero(new), len(x)))
            out = np.empty(len(x))
            out[order] = (times - 1)[np.cumsum(new) - 1]
            return out

        word, context = others(ranked), others(ranked >> np.uint64(16))
        p_net = np.exp(np.concatenate([s for _, _, s in parts]) / -_FINE)
        gain = np.log((word + p.prior * p_net) / ((context + p.prior) * p_net))
        out, at = [], 0
        for k, piece, (_, slot, _) in zip(n, rows.column("piece").to_pylist(), parts):
            known = np.flatnonzero(context[at:at + k])
            if len(known):
                docs, which = np.unique(slot[known], return_inverse=True)
                out.append((piece, len(docs), _pack(docs, np.bincount(which, gain[at + known]).astype(np.float32))))
            at += k
        pieces, docs, body = zip(*out) if out else ((), (), ())
        return pa.table({"bucket": pa.array([rows.column("bucket")[0].as_py()] * len(out), pa.int64()), "piece": pa.array(pieces, pa.int64()),
                         "n": pa.array(docs, pa.int32()), "body": pa.array(body, pa.binary())})
    return run


def _summed(rows: pa.Table) -> pa.Table:
    """A piece's documents: the network's sums and the gains of all buckets, in their order."""
    rows = rows.sort_by("bucket")
    own = [_unpack(n, b.as_py(), *types) for n, b, types in zip(
        rows.column("n").to_pylist(), rows.column("body"), [("i8", "u1", "i8", "f8")] + [("u4", "f4")] * (rows.num_rows - 1))]
    ids, null, n, total = own[0]
    for slot, gain in own[1:]:
        total[slot] += gain
    return pa.table({"doc_id": pa.array(ids, pa.int64(), mask=null.astype(bool)), "n_tokens": pa.array(n), "pll": pa.array(total)})


def score_corpus(docs: DataFrame, vocab: list[bytes], table: np.ndarray, p: LmParams, within: Shares, tokens: int) -> DataFrame:
    """``score`` of the corpus' own documents, with the counts of real words (see above);
    ``tokens`` is the corpus' number of tokens.  Every place is sent once to the bucket
    of its context's hash, ``p.piece`` places to a bucket on average, and a bucket
    answers with a number for each document: some 8 and 2 bytes a token.  Places of
    one context meet in one task, so contexts of two frequent words, which the
    network holds exactly, aren't sent.  A place sends its network log-probability
    in steps of 1/2048, which a gain is as exact as."""
    bits = max(0, ceil(log2(max(1, tokens) / p.piece)))
    bc = docs.sparkSession.sparkContext.broadcast((vocab, table, within))
    sent = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_sent(bc, p, bits), _ROW)
    gains = sent.groupBy("bucket").applyInArrow(_counted(p), _ROW)
    return _rounded(gains.groupBy("piece").applyInArrow(_summed, "doc_id long, n_tokens long, pll double"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    p = LmParams()
    words = cut(word_counts(docs))
    vocab, table = _train(docs, vocabulary(docs, p, words), p)
    tokens = words.agg(F.sum("n")).first()[0] or 0
    return score_corpus(docs, vocab, table, p, shares(words, vocab, p), tokens)
