"""The language model against a plain network and plain counts."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from conftest import MEDIUM
from giftlens.llm import lm_score as lm


def plain_words(t):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().lower())


def plain_class(w, p):
    return (min(len(w), 15) * 7 + w[-1]) % p.classes


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    words = [f"w{i}" + "é" * (i % 3) for i in range(300)]
    return [" ".join(rng.choices(words, weights=[1 / (i + 1) for i in range(300)], k=rng.randint(0, 60))) for _ in range(300)] + ["", None, "THE end"]


def test_scores_equal_a_plain_network_and_plain_shares(spark, corpus):
    p = lm.LmParams(words=12, classes=5, hidden=8, steps=40, rarest=1 / 2000)
    df = spark.createDataFrame(list(enumerate(corpus)), "doc_id long, text string")
    words = lm.word_counts(df)
    count = Counter(w for t in corpus for w in plain_words(t))
    assert {bytes(r.word): r.n for r in words.collect()} == count
    vocab, table = lm.train(df, p)
    assert vocab == sorted(count, key=lambda w: (-count[w], w))[:12]
    sh = lm.shares(words, vocab, p)
    total = sum(count.values())
    rest = {w: n for w, n in count.items() if w not in vocab}
    assert set(sh.own) == {w for w, n in rest.items() if n >= total / 2000}

    def share(w):
        if w in vocab:
            return 0.0
        same = {x: n for x, n in rest.items() if plain_class(x, p) == plain_class(w, p)}
        rare = [n for n in same.values() if n < total / 2000]
        every = sum(same.values()) + (0 if rare else 0.5)
        if w in sh.own:
            return math.log(count[w] / every)
        return math.log((sum(rare) if rare else 0.5) / max(len(rare), 1) / every)

    # The network once more, one token at a time.
    n = lm.counts(df, vocab, p)
    net = lm.WindowNetwork(p)
    net.fit(n, p)
    q = net.par

    def token(w):
        return vocab.index(w) + 1 if w in vocab else 1 + p.words + plain_class(w, p)

    def log_p(left, right, at):
        h = np.tanh(q["L"][left] + q["R"][right] + q["a"])
        e = np.exp(h @ q["U"] + q["b"])
        return math.log((e[at] / e.sum() + p.smooth) / (1 + p.size * p.smooth))

    extra = ["zzz quite new wé0", corpus[0]]
    scored = spark.createDataFrame(list(enumerate(corpus + extra)), "doc_id long, text string")
    for r in lm.score(scored, vocab, table, p, sh).collect():
        w = plain_words((corpus + extra)[r.doc_id])
        x = [0, *map(token, w), 0]
        want = sum(log_p(x[i], x[i + 2], x[i + 1]) + share(w[i]) for i in range(len(w)))
        assert r.n_tokens == len(w) and r.pll == pytest.approx(want, abs=2e-3)


def test_shares_of_a_class_sum_to_one(spark, corpus):
    p = lm.LmParams(words=3, classes=4, rarest=1 / 500)
    df = spark.createDataFrame(list(enumerate(corpus)), "doc_id long, text string")
    words = lm.word_counts(df)
    vocab = lm.vocabulary(df, p, words)
    sh = lm.shares(words, vocab, p)
    kinds = Counter(plain_class(bytes(r.word), p) for r in words.collect() if bytes(r.word) not in vocab and bytes(r.word) not in sh.own)
    for c in range(p.classes):
        own = sum(math.exp(x) for x, t in zip(sh.logs, sh.tokens) if t == 1 + p.words + c)
        assert own + kinds[c] * math.exp(sh.rest[c]) == pytest.approx(1.0, abs=1e-5)


def test_nonsense_of_equal_shape_scores_lower(spark, corpus):
    p = lm.LmParams(words=5, classes=4, steps=30, rarest=1 / 5000)
    df = spark.createDataFrame(list(enumerate(corpus)), "doc_id long, text string")
    words = lm.word_counts(df)
    vocab, table = lm.train(df, p)
    sh = lm.shares(words, vocab, p)
    known, odd = "w9 w12 w15 w18", "q9 q12 q15 q18"
    got = {r.doc_id: r.mean_pll for r in lm.score(spark.createDataFrame([(0, known), (1, odd)], "doc_id long, text string"), vocab, table, p, sh).collect()}
    assert got[0] > got[1]


def test_most_tokens_have_a_probability_of_their_own(spark):
    p = lm.LmParams()
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    words = lm.word_counts(docs)
    sh = lm.shares(words, lm.vocabulary(docs, p, words), p)
    total, rare = words.selectExpr("sum(n)", "count(1)").first()
    assert len(sh.own) <= 1 / p.rarest and len(sh.own) > 0.9 * (rare - p.words)


def test_no_words(spark):
    df = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    words = lm.word_counts(df)
    p = lm.LmParams(words=4, classes=3, steps=5)
    vocab, table = lm.train(df, p)
    got = lm.score(df, vocab, table, p, lm.shares(words, vocab, p)).collect()
    assert vocab == [] and sorted((r.doc_id, r.n_tokens, r.pll, r.mean_pll) for r in got) == [(1, 0, 0.0, None), (2, 0, 0.0, None)]


@pytest.mark.parametrize("piece", [200, 1 << 19])
def test_corpus_scores_equal_plain_counts_of_real_words(spark, corpus, piece):
    """Counts stopped at the network's classes: no context of a word outside the vocabulary was counted."""
    p = lm.LmParams(words=12, classes=5, hidden=8, steps=20, rarest=1 / 2000, piece=piece)
    rows = [*enumerate(corpus + [corpus[0], corpus[7], "once upon wé0 time"]), (None, corpus[1]), (3, corpus[3])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    words = lm.word_counts(df)
    vocab, table = lm.train(df, p)
    sh, tokens = lm.shares(words, vocab, p), words.groupBy().sum("n").first()[0]
    plain = {(r.doc_id, r.n_tokens): r.pll for r in lm.score(df, vocab, table, p, sh).collect()}
    texts = [[b"", *plain_words(t), b""] for _, t in rows]
    known = {b"", *vocab}
    word, context = Counter(), Counter()
    for x in texts:
        for i in range(1, len(x) - 1):
            word[x[i - 1:i + 2][0], x[i], x[i + 1]] += 1
            context[x[i - 1], x[i + 1]] += 1
    share = dict(zip(sh.own, zip(sh.tokens, sh.logs)))

    def log_net(x, i):
        def symbol(w):
            return 0 if w == b"" else vocab.index(w) + 1 if w in vocab else 1 + p.words + plain_class(w, p)
        own = 0.0 if x[i] in vocab else share[x[i]][1] if x[i] in share else sh.rest[plain_class(x[i], p)]
        return float(table[symbol(x[i - 1]), symbol(x[i + 1]), symbol(x[i])]) + float(own)

    want = []
    for (i, _), x in zip(rows, texts):
        total = 0.0
        for k in range(1, len(x) - 1):
            net = log_net(x, k)
            if not known.issuperset((x[k - 1], x[k + 1])):
                c, n = word[x[k - 1], x[k], x[k + 1]] - 1, context[x[k - 1], x[k + 1]] - 1
                net = math.log((c + p.prior * math.exp(net)) / (n + p.prior))
            total += net
        want.append((i, len(x) - 2, total))
    got = [(r.doc_id, r.n_tokens, r.pll) for r in lm.score_corpus(df, vocab, table, p, sh, tokens).collect()]
    order = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert len(got) == len(rows)
    for g, w in zip(sorted(got, key=order), sorted(want, key=order)):
        assert g[:2] == w[:2] and g[2] == pytest.approx(w[2], abs=0.02)
    assert any(abs(pll - plain[i, n]) > 1 for i, n, pll in got)


def test_documents_that_occur_twice_score_apart(spark, tmp_path):
    """A model of class counts alone scored them like all others."""
    rng = random.Random(8)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(3000)], weights=[1 / (i + 1) for i in range(3000)], k=rng.randint(20, 60))) for _ in range(400)]
    rows = list(enumerate(texts + texts[:20]))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.mean_pll for r in lm.op2(spark, str(tmp_path)).collect()}
    bar = sorted(got[i] for i in range(20, 400))[342]
    assert len(got) == 420 and sum(got[i] > bar for i in [*range(20), *range(400, 420)]) == 40


def test_corpus_without_words(spark):
    p = lm.LmParams(words=4, classes=3, steps=5)
    for rows, want in ([(1, None), (None, "")], [(1, 0, 0.0, None), (None, 0, 0.0, None)]), ([], []):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        words = lm.word_counts(df)
        vocab, table = lm.train(df, p)
        got = lm.score_corpus(df, vocab, table, p, lm.shares(words, vocab, p), 0).collect()
        assert sorted(((r.doc_id, r.n_tokens, r.pll, r.mean_pll) for r in got), key=str) == sorted(want, key=str)
