"""The text operators against brute force, and on awkward tables."""

import hashlib
import math
import random
import re

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from conftest import SMALL
from giftlens.llm import (chat_format, decontam, line_dedup, lm_score, mixing, near_dedup,
                          quality_rules, queries, secrets, toxicity, url_filter)
from giftlens.llm.components import components
from giftlens.sources.tables import TABLES
from tools.oracle_check import table_hash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, gone_id string, root int, n long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(400)) for _ in range(n))


def awkward(spark):
    """Nulls, empty and long texts, ties, repeated rows, clashing column names."""
    rng = random.Random(3)
    long = "\n".join(sentence(rng, 40) for _ in range(150))
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t ", "en", "a", 4), (4, long, "en", "b", 1),
            (5, long, None, "b", 1), (5, long, None, "b", 1), (6, "one two", "en", None, 7), (None, long, "en", "b", 1),
            (None, None, "en", "b", 1), (7, sentence(rng, 60), "de", "c", 9), (8, "\ue000 token=abcdefgh1 \ue001", "de", "c", 1)]
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", sorted(queries.oracle_sql()))
def test_matches_oracle(spark, duck, key):
    df = queries.queries()[key](spark, SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(queries.oracle_sql()[key])
    cols = [d[0] for d in cur.description]
    want = [tuple(r) for r in cur.fetchall()]
    assert sorted(df.columns) == sorted(cols)
    assert table_hash(rows, df.columns)[0] == table_hash(want, cols)[0]


def test_components(spark):
    rng = random.Random(1)
    ids = [hashlib.md5(str(i).encode()).hexdigest() for i in range(300)]
    chain = list(zip(ids[:100], ids[1:100]))
    star = [(ids[100], x) for x in ids[101:200]]
    links = chain + star + [(b, a) for a, b in chain[:5]] + [(ids[0], ids[0]), (None, ids[1])]
    rng.shuffle(links)
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "u string, v string")).collect()}
    assert len(got) == 200
    assert {got[x] for x in ids[:100]} == {min(ids[:100])}
    assert {got[x] for x in ids[100:200]} == {min(ids[100:200])}
    assert components(spark.createDataFrame([], "u string, v string")).count() == 0


# --- near duplicates

def brute_groups(docs):
    sets = {}
    for i, t in docs:
        w = (t or "").lower().split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                x = len(sets[a] & sets[b])
                if 100 * x >= 85 * len(sets[a] | sets[b]):
                    ra, rb = sorted((find(a), find(b)))
                    root[rb] = ra
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_near_dedup_brute_force(spark):
    rng = random.Random(5)
    docs, i = [], 0
    for _ in range(12):
        base = sentence(rng, 150).split()
        for _ in range(14):
            w = list(base)
            for _ in range(rng.randrange(4)):
                w[rng.randrange(len(w))] = "changed" + str(rng.randrange(10**6))
            docs.append((i, " ".join(w)))
            i += 1
    docs += [(i, "a b c"), (i + 1, "A b  C"), (i + 2, ""), (i + 3, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute_groups(docs)
    for params in (near_dedup.NearDedupParams(), near_dedup.NearDedupParams(unit_classes=4)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(df, params).collect()}
        assert got == want
    kept = {r.doc_id for r in near_dedup.drop_near_duplicates(df).collect()}
    assert kept == {d for d, (_, c) in want.items() if d == c}


def test_near_dedup_decides_by_row(spark):
    rng = random.Random(12)
    a, b, c, d, e = (sentence(rng, 60) for _ in range(5))
    rows = [(1, a, 0), (None, a, 0),                                  # a copy without an id
            (None, b, 0), (None, None, 0), (None, None, 1),           # rows of their own
            (2, a + " more", 0), (2, c, 0),                           # a copy and another text share an id
            (None, d, 0), (None, d + " x", 0), (None, d, 0),          # copies, none has an id
            (3, e, 0), (3, e, 1), (4, "", 0), (4, "", 1), (4, "", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n long")
    out = [tuple(r) for r in near_dedup.drop_near_duplicates(df).collect()]
    texts = [t for _, t, _ in out]
    assert (1, a, 0) in out and (None, b, 0) in out and (2, c, 0) in out and not texts.count(a + " more")
    assert texts.count(a) == texts.count(b) == texts.count(e) == 1
    assert len([t for t in texts if t and t.startswith(d)]) == 1
    assert sorted(n for i, t, n in out if i is None and t is None) == [0, 1]
    assert sorted(n for i, t, n in out if i == 4) == [0, 1]
    assert len(out) == 9
    left = near_dedup.drop_near_duplicates(awkward(spark)).collect()
    assert [r.text for r in left if r.doc_id is None] == [None]


def test_pipeline_near_dedup_from_080(spark):
    rng = random.Random(13)
    docs = []
    for k in range(12):                                               # one changed word: 5 shingles of 50 differ
        w = sentence(rng, 54).split()
        docs += [(2 * k, " ".join(w)), (2 * k + 1, " ".join([*w[:25], "changed", *w[26:]]))]
    docs += [(100, "a b c d e f g"), (101, "a b c d e f h")]          # 2 of 4 shingles
    df = spark.createDataFrame(docs, "doc_id long, text string")
    kept = corpus_pipeline.stage_near_dedup(spark, df, SMALL)
    assert sorted(r.doc_id for r in kept.collect()) == [*range(0, 24, 2), 100, 101]
    assert near_dedup.drop_near_duplicates(df).count() == len(docs)   # op7's threshold: 45 / 55 is below 0.85


def test_sketch_estimates():
    p = near_dedup.NearDedupParams()
    mul = near_dedup._constants(p.bands * p.rows, 7)
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**63, 2000, dtype=np.uint64)
    for shared in (400, 1200, 1800):
        b = np.concatenate([a[:shared], rng.integers(0, 2**63, 2000 - shared, dtype=np.uint64)])
        ka, kb = near_dedup.sketch(a, mul, p), near_dedup.sketch(b, mul, p)
        both = near_dedup.sketch(np.concatenate([a, b]), mul, p)
        assert (np.maximum(ka, kb) == both).all()                    # mergeable
        n = np.array([2000.0])
        j = near_dedup.joint_similarity(np.array([(ka > kb).sum()]), np.array([(ka < kb).sum()]),
                                        np.array([(ka == kb).sum()]), n, n, p.base)[0]
        assert abs(j - shared / (4000 - shared)) < 0.13


# --- decontamination

def test_wu_manber_brute_force():
    rng = random.Random(2)
    text = "".join(rng.choice("ab ") for _ in range(3000)).encode()
    patterns = sorted({bytes(text[i:i + rng.randrange(3, 12)]) for i in (5, 60, 700, 1500, 2900)} | {b"abab", b"zzz"})
    found = sorted((s, patterns[i]) for s, i in decontam.WuManber(patterns, 3).find(text))
    want = sorted((s, p) for p in patterns for s in range(len(text)) if text.startswith(p, s))
    assert found == want


def test_decontam_cases(spark):
    rng = random.Random(9)
    long = sentence(rng, 20)
    items = [(1, long), (1, "Short Item"), (2, "short  item!"), (3, None), (None, "null id"), (4, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = [(1, f"x {long} y", ), (2, "a short; item"), (3, None), (4, "null-ID"), (None, "clean"),
            (5, "clean " * 200 + "short item"), (6, " ".join(long.split()[:12]))]
    df = spark.createDataFrame([(i, t) for i, t in docs], "doc_id long, text string")
    for size in (decontam.BLOCK_BYTES, 20):                             # one block, and many
        got = {r.doc_id: r for r in decontam.contamination(df, bench, block_bytes=size).collect()}
        assert (got[1].n_words, got[1].n_hit, got[1].items, got[1].contaminated) == (22, 20, ["1"], True)
        assert (got[2].n_hit, got[2].items) == (2, ["1", "2"])
        assert (got[3].n_words, got[3].contaminated) == (0, False)
        assert (got[4].n_hit, got[4].items, got[4].contaminated) == (2, [], True)
        assert not got[None].contaminated
        assert (got[5].n_hit, got[5].contaminated) == (2, False)
        assert got[6].n_hit == 0
    left = decontam.drop_contaminated(df, bench).collect()
    assert {r.doc_id for r in left} == {3, None, 5, 6}
    assert decontam.contamination(df, bench.limit(0)).where("contaminated").count() == 0


# --- secrets

BASE = [("assign", re.compile(secrets.ASSIGN.replace("(?i)", ""), re.I | re.A), 8),
        ("access", re.compile("AKIA[A-Z0-9]+"), 16), ("hex", re.compile("[0-9a-f]+"), 32)]


def brute_base(text):
    out = []
    for k, (kind, pattern, least) in enumerate(BASE):
        for m in pattern.finditer(text or ""):
            if len(m.group(2) if kind == "assign" else m.group()) >= least:
                out.append((m.start(), k, m.end(), kind))
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(out))


def test_secrets_brute_force(spark):
    rng = random.Random(4)
    parts = ["password", " = ", "=", ":", "'", '"', "Token", "api_key", "secret", "AKIA", "0123456789ABCDEF", "é", "\U0001f600",
             "deadbeef" * 4, "abc", "\n", " ", "x" * 9, "\ue000", "\ue001", "Passwd", "q8Zr+x/9Lk2"]
    texts = ["".join(rng.choice(parts) for _ in range(30)) for _ in range(300)] + ["", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in secrets.scan(df).collect()}
    for i, t in enumerate(texts):
        assert got[i].base == brute_base(t)
        assert [x for x in got[i].spans.split(",") if x and not x.startswith("entropy")] == [x for x in got[i].base.split(",") if x]


def test_entropy_windows(spark):
    p = secrets.EntropyParams()
    keys = ["q8ZrXx9Lk2vB7nM4tY6w", "aaaaaaaaaaaaaaaaaaaa1", "q8ZrXx9Lk2vB7nM4tY6w" + "a1" * 30, "thisisjustaverylongwordindeed",
            "EXAMPLE1EXAMPLE2EXAMPLE", "9f" * 12, "3f9a0c7be15d482690fe"]

    def entropy(s):
        return -sum(s.count(c) / len(s) * math.log2(s.count(c) / len(s)) for c in set(s))

    def want(s):
        if not re.search("[0-9]", s) or not re.search("[A-Za-z]", s) or re.search(secrets.ALLOWED, s):
            return ""
        bits = p.hex_bits if re.fullmatch("[0-9a-f]+", s) else p.alnum_bits
        over = [i for i in range(len(s) - p.window + 1) if entropy(s[i:i + p.window]) >= bits - 1e-9]
        return f"entropy:{4 + over[0]}:{4 + over[-1] + p.window}" if over else ""

    df = spark.createDataFrame([(i, f"see {s} ok") for i, s in enumerate(keys)], "doc_id long, text string")
    got = {r.doc_id: ",".join(x for x in r.spans.split(",") if x.startswith("entropy")) for r in secrets.scan(df).collect()}
    assert got == {i: want(s) for i, s in enumerate(keys)}
    assert got[0] and not got[1] and not got[3] and not got[4]


# --- line dedup

def test_line_dedup(spark):
    rng = random.Random(8)
    same, other = sentence(rng, 30), sentence(rng, 30)
    edited = " ".join(["Changed"] + same.split()[1:])
    docs = [(1, f"{same}\n\nown line one here\n---"), (2, f"x y\n{same.upper()}\n---\nX Y "), (3, f"{other}\n{same}"), (4, None), (5, "")]
    out = {r.doc_id: r for r in line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert out[1].text == docs[0][1] and out[1].n_removed_lines == 0
    assert out[2].text == "x y\n---" and out[2].n_removed_lines == 2
    assert out[3].text == other
    assert out[4].text is None and out[5].text == ""
    # Fuzzy groups equal brute force over fingerprints within five bits and the edit similarity.
    lines = [same, edited] + [" ".join(w if rng.random() > 0.02 else "z" + w for w in sentence(random.Random(k % 6), 60).split())
                              for k in range(60)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "doc_id long, text string")
    table, roots = line_dedup.line_groups(df)
    rows = {r.key: r for r in table.collect()}
    got = {r.key: r.root for r in roots.collect()}

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            prev, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
        return row[-1]

    keys = sorted(rows)
    for a in keys:
        for b in keys:
            bits = sum(bin((rows[a][f"f{i}"] ^ rows[b][f"f{i}"])).count("1") for i in range(3))
            u, v = rows[a].norm.split(), rows[b].norm.split()
            if a < b and bits < 6 and distance(u, v) <= 0.2 * max(len(u), len(v)) + 1e-9:
                assert got[a] == got[b]
    assert len(set(got.values())) < len(got)


def test_line_dedup_finds_every_similar_pair(spark):
    rng = random.Random(21)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            prev, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
        return row[-1]

    lines = ["na na na na na na na na", "na na na na na na na", "ba na ba na ba na ba", "na ba na ba na ba na"]
    for n in [5, 6, 7, 8, 9, 10, 11, 14, 15, 19, 20, 24, 30, 49, 60, 100] * 3:
        base = [rng.choice(WORDS[:4]) if rng.random() < 0.3 else rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n)]
        lines.append(" ".join(base))
        for d in {n // 5, n // 4, n // 5 + 1, 1}:
            w = list(base)
            for _ in range(d):
                k, how = rng.randrange(len(w)), rng.randrange(4)
                w[k:k + 1] = [["new"], [w[k], "new"], [], [w[k], w[k]]][how]
            lines.append(" ".join(w))
        lines.append(", ".join(base) + ".")
    lines = sorted(set(lines))
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    table, roots = line_dedup.line_groups(df)
    doc = {r.key: r["at"].doc_id for r in table.collect()}
    got = {doc[r.key]: r.root for r in roots.collect()}
    words = [re.findall("[a-z0-9]+", x) for x in lines]
    root = list(range(len(lines)))
    for a in range(len(lines)):
        for b in range(a):
            u, v = words[a], words[b]
            if min(len(u), len(v)) >= 5 and distance(u, v) <= 0.2 * max(len(u), len(v)) + 1e-9:
                ra, rb = root[a], root[b]
                root = [rb if x == ra else x for x in root]
    pairs = [(a, b) for a in range(len(lines)) for b in range(a)]
    wrong = [(lines[a], lines[b]) for a, b in pairs if (got.get(a, a) == got.get(b, b)) != (root[a] == root[b])]
    assert not wrong
    assert 40 < sum(root[a] == root[b] for a, b in pairs)


# --- URL filter

def test_url_rules_and_propagation(spark):
    pages = [(1, "http://WWW.Example.com/en/1?q", '<a href="http://good.org/">'), (2, "http://x.example.com/en/2", ""),
             (3, "http://x.example.com/de", ""), (4, "https://spam.org/a", '<a href="http://x.bad.net/fr/1">'), (5, None, None),
             (6, "no url", ""), (7, "http://x.bad.net/fr/1#f", ""), (8, "http://good.org", "<a href=/rel>"), (9, "x://com", ""),
             (9, "x://com", "")]
    df = spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, host string")
    out = url_filter.filter_pages(df)
    got = {r.page_id: r for r in out.collect()}
    assert out.count() == len(pages)
    assert (got[1].host, got[1].path, got[1].rule, got[1].verdict) == ("www.example.com", "/en/1", "www.example.com/en/", "allow")
    assert (got[2].rule, got[2].verdict) == ("example.com/en/", "block")
    assert (got[3].rule, got[3].verdict) == ("com/", "allow")
    assert (got[7].path, got[7].rule, got[7].verdict) == ("/fr/1", "net/fr/", "block")
    assert got[4].rule is None and got[4].verdict == "block"             # links to a blocked host
    assert got[8].verdict == "allow"                                     # linked from an allowed host
    assert (got[5].host, got[5].path, got[5].verdict) == ("", "", "allow") and got[6].host == ""
    # Scores equal a dense power iteration.
    p = url_filter.LinkParams()
    links = {(r.src, r.dst): r.weight for r in url_filter.host_links(df, p.tree_weight).collect()}
    hosts = sorted({h for e in links for h in e} | {r.host for r in got.values() if r.host})
    w = np.zeros((len(hosts), len(hosts)))
    for (a, b), x in links.items():
        w[hosts.index(a), hosts.index(b)] = x
    seed = np.zeros((2, len(hosts)))
    for h in hosts:
        ruled = [r.ruled for r in url_filter.judged_pages(df).collect() if r.host == h]
        for k, v in enumerate(("allow", "block")):
            seed[k, hosts.index(h)] = sum(x == v for x in ruled) / max(len(ruled), 1)
    out_w, in_w = w.sum(axis=1), w.sum(axis=0)
    t, d = 0.15 * seed[0], 0.15 * seed[1]
    for _ in range(p.steps):
        t, d = (0.15 * seed[0] + 0.85 * (t / np.maximum(out_w, 1e-12)) @ w, 0.15 * seed[1] + 0.85 * w @ (d / np.maximum(in_w, 1e-12)))
    for r in got.values():
        if r.host:
            assert abs(r.trust - t[hosts.index(r.host)]) < 1e-6 and abs(r.distrust - d[hosts.index(r.host)]) < 1e-6


# --- mixing, toxicity, language model, chat

def test_mix_meets_targets(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    targets = {"source": None, "lang": spark.createDataFrame([("en", 0.4), ("de", 0.2), ("fr", 0.2), ("es", 0.2)], "value string, target double")}
    cells = mixing.mix(docs)[1]
    targets["source"] = mixing.power_targets(cells, "source", 0.5)
    raked = mixing.rake(cells.select(*mixing.DIMENSIONS, "tokens"), targets, 30)
    got = {r.lang: r.w for r in raked.groupBy("lang").agg({"weight": "sum"}).withColumnRenamed("sum(weight)", "w").collect()}
    assert got == pytest.approx({"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}, abs=0.02)
    out, cells = mixing.mix(docs)
    total, expected = out.agg({"tokens": "sum"}).first()[0], sum(r.tokens * r.probability for r in cells.collect())
    assert abs(expected / total - mixing.MixParams().keep) < 0.02
    assert {r.doc_id for r in mixing.sample_mix(docs).collect()} == {r.doc_id for r in out.where("sampled").collect()}


def test_toxicity_held_out():
    rng = random.Random(6)
    bad = ["vileword", "nastyword", "gruesome"]
    data = []
    for _ in range(600):
        g = rng.choice([0, 0, 0, 1, 2])
        words = sentence(rng, rng.randrange(30, 300)).split() + [rng.choice(bad[:2] if g == 1 else bad) for _ in range(3 * g)]
        if g == 2:
            words += ["gruesome"]
        rng.shuffle(words)
        data.append((" ".join(words), g))
    model = toxicity.fit([t for t, _ in data[:400]], [g for _, g in data[:400]])
    assert model.thetas == sorted(model.thetas)
    limit = toxicity.ToxicityParams().reject_at
    assert np.mean([(model.severity(t) >= limit) == (g > 0) for t, g in data[400:]]) > 0.97
    by = [np.mean([model.severity(t) for t, g in data[400:] if g == k]) for k in range(3)]
    assert by[0] < by[1] < by[2]
    assert toxicity.fit([], []).severity("x") < limit and toxicity.fit(["a"], [0]).severity("a") < limit


def test_lm_brute_force(spark):
    p = lm_score.LmParams(words=6, classes=4, steps=60)
    texts = ["the cat saw the dog", "the dog saw the cat", "a cat", "", None, "The CAT saw"] * 5
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    vocab = lm_score.vocabulary(df, p)
    assert vocab[0] == b"the"
    n = lm_score.counts(df, vocab, p)
    assert n.sum() == sum(len((t or "").split()) for t in texts)
    net = lm_score.WindowNetwork(p)
    loss = net.fit(n, p)
    assert loss[-1] < 0.7 * loss[0]
    table = net.log_table(p.smooth)
    enc = lm_score.Encoder(vocab, p)
    for r in lm_score.score(df, vocab, table, p).collect():
        x = enc.tokens(texts[r.doc_id])
        want = sum(float(table[x[i - 1], x[i + 1], x[i]]) for i in range(1, len(x) - 1))
        assert r.n_tokens == len(x) - 2 and abs(r.pll - want) < 1e-3
        assert (r.mean_pll is None) == (len(x) == 2)
    known, odd = "the cat saw the dog", "dog the the saw saw"
    score = {r.doc_id: r.mean_pll for r in lm_score.score(
        spark.createDataFrame([(0, known), (1, odd)], "doc_id long, text string"), vocab, table, p).collect()}
    assert score[0] > score[1]


def test_chat_rotation(spark):
    rows = [(1, 0, "system", "be nice"), (1, 1, "ann", "hi <|im_end|>"), (1, 2, "bob", "hello é"), (1, 2, "bob", "hello é"), (1, None, None, None),
            (2, 0, "system", "alone"), (None, 0, "ann", "x"), (3, 700, "ann", "late"), (3, 1, "bob", "early")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.perspective, r.part): r for r in chat_format.rotate(df).collect()}
    r = got[(1, "bob", "0.0")]
    assert r.rendered == ("<|im_start|>system\nbe nice<|im_end|>\n<|im_start|>user name=ann\nhi < |im_end|><|im_end|>\n"
                          + "<|im_start|>assistant\nhello é<|im_end|>\n" * 2)
    spans = [tuple(map(int, s.split(":"))) for s in r.mask.split(",")]
    assert [r.rendered[a - r.begin:b - r.begin] for a, b in spans] == ["hello é<|im_end|>"] * 2
    assert r.begin == len(got[(1, "bob", "-1.0")].rendered) > 0
    assert {k[1] for k in got if k[0] == 1} == {"ann", "bob", "unknown"}
    assert got[(1, "unknown", "-1.0")].mask and not [k for k in got if k[0] == 2]
    assert got[(None, "ann", "0.0")].n_turns == 1
    assert {k[2] for k in got if k[0] == 3} == {"0.0", "1.0"}


# --- awkward tables, pipeline

def test_awkward_tables(spark):
    df = awkward(spark)
    labels = spark.createDataFrame([(7, 1, 1), (4, 1, 0), (None, 1, 1), (8, None, None), (4, 0, 0)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    model = toxicity.train(df, labels)
    for t in (df, df.limit(0)):
        n = t.count()
        near = near_dedup.near_duplicates(t)
        assert near.count() == n
        assert toxicity.score(t, model).count() == n
        assert decontam.contamination(t, bench).count() == n
        assert secrets.scan(t).count() == n
        assert quality_rules.judged(t).count() == n
        assert mixing.mix(t)[0].count() == n
        deduped = line_dedup.dedup_lines(t)
        assert deduped.count() == n and deduped.columns == [*t.columns, "n_removed_lines"]
        vocab, table = lm_score.train(t, lm_score.LmParams(words=5, classes=3, steps=3))
        assert lm_score.score(t, vocab, table, lm_score.LmParams(words=5, classes=3)).count() == n
    near = near_dedup.near_duplicates(df).collect()
    assert {r.component_id for r in near if r.n_shingles > 1000} == {4}
    assert [r.kept for r in near if r.doc_id is None and r.n_shingles] == [False]
    assert sorted(r.doc_id for r in near_dedup.drop_near_duplicates(df).where("doc_id is not null").collect()) == [1, 2, 3, 4, 6, 7, 8]
    assert [r.base for r in secrets.scan(df).where("doc_id = 8").collect()] == ["assign:2:17"]
    empty_labels = toxicity.train(df, labels.limit(0))
    assert toxicity.score(df, empty_labels).where("toxic").count() == 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = spark.createDataFrame(stage(spark, before, SMALL).collect(), None) if name != "mix" else stage(spark, before, SMALL)
        ids = {r.doc_id for r in before.collect()}
        assert {r.doc_id for r in after.collect()} <= ids
        if name != "mix":
            assert after.columns == docs.columns
            after = after.select(*[after[c].cast(docs.schema[c].dataType) for c in docs.columns])
        if name == "decontaminate":
            bad = {r.doc_id for r in decontam.contamination(before, spark.read.parquet(f"{SMALL}/benchmark.parquet")).where("contaminated").collect()}
            assert {r.doc_id for r in after.collect()} == ids - bad
        before = after
    assert "sampling_probability" in before.columns
    assert corpus_pipeline.run(spark, SMALL).count() == before.count()
