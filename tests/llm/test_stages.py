"""Every pipeline stage against a plain-Python version, and on awkward and empty tables."""

import hashlib
import math
import random
import re
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline as P
from giftlens.llm import decontam, mixing, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(300)) for _ in range(n))


def table(spark, texts):
    rows = [(i, t, "en" if i % 3 else None, "web" if i % 2 else "book", len(t or "")) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


def awkward(spark):
    rng = random.Random(3)
    long = "\n".join(sentence(rng, 40) for _ in range(100))
    return table(spark, [(1, None), (2, ""), (3, " \n\t "), (4, long), (5, long), (5, long), (6, "one two")]).unionByName(
        spark.createDataFrame([(None, long, None, None, None), (None, None, "en", "web", 1)], SCHEMA))


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def merge(n, linked):
    root = list(range(n))
    for a in range(n):
        for b in range(a):
            if root[a] != root[b] and linked(a, b):
                old, new = root[a], root[b]
                root = [new if x == old else x for x in root]
    return root


def plain_line_dedup(docs):
    """{doc_id: text} of the documents that keep something."""
    lines = [(i, k, x) for i, t in docs for k, x in enumerate((t or "").split("\n")) if re.search(r"[^\W_]", x)]
    forms = sorted({x.lower().strip() for _, _, x in lines})
    words = [re.findall(r"[^\W_]+", x) for x in forms]

    def linked(a, b):
        n = max(len(words[a]), len(words[b]))
        return min(len(words[a]), len(words[b])) >= 5 and distance(words[a], words[b]) <= 0.2 * n + 1e-9

    group = dict(zip(forms, merge(len(forms), linked)))
    first = {}
    for i, k, x in lines:
        g = group[x.lower().strip()]
        first[g] = min(first.get(g, (i, k)), (i, k))
    gone = defaultdict(set)
    for i, k, x in lines:
        if first[group[x.lower().strip()]] != (i, k):
            gone[i].add(k)
    out = {}
    for i, t in docs:
        left = "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i]) if gone[i] else t
        if not gone[i] or re.search(r"[^\W_]", left):
            out[i] = left
    return out


def test_line_stage(spark):
    rng = random.Random(4)
    pool = [sentence(rng, n) for n in (3, 4, 5, 9, 15, 16, 30, 41) for _ in range(3)]
    docs = []
    for i in range(60):
        lines = []
        for _ in range(rng.randint(0, 5)):
            w = rng.choice(pool).split()
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                w[rng.randrange(len(w))] = rng.choice(WORDS)
            lines.append(rng.choice(["", "  "]) + rng.choice([str.upper, str])(rng.choice([" ", ", "]).join(w)))
        docs.append((i, "\n".join(lines + rng.choice([[], [""], ["---"]]))))
    docs.append((60, None))
    got = {r.doc_id: r for r in P.stage_line_dedup(spark, table(spark, docs), "").collect()}
    assert {i: r.text for i, r in got.items()} == plain_line_dedup(docs)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got.values())
    assert len(got) < len(docs) and any(r.text != dict(docs)[i] for i, r in got.items())


def test_near_dedup_stage(spark):
    rng = random.Random(5)
    docs = []
    for i in range(90):
        if i % 3 == 0 or rng.random() < 0.2:
            w = sentence(rng, rng.choice([3, 60, 120, 250])).split()
        else:
            w = docs[rng.randrange(len(docs))][1].split()
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                w[rng.randrange(len(w))] = "new" + str(rng.randrange(50))
        docs.append((i, " ".join(w)))
    docs += [(90, None), (91, ""), (92, "")]

    def shingles(t):
        w = (t or "").lower().split()
        return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())

    sets = [shingles(t) for _, t in docs]
    root = merge(len(docs), lambda a, b: sets[a] and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]))
    got = sorted(r.doc_id for r in P.stage_near_dedup(spark, table(spark, docs), "").collect())
    groups = defaultdict(list)
    for (i, _), r in zip(docs, root):
        groups[r].append(i)
    assert len(got) == len(groups) and all(len(set(g) & set(got)) == 1 for g in groups.values()) and len(groups) < 80


def test_decontamination_stage(spark):
    rng = random.Random(6)
    items = [(k, sentence(rng, n)) for k, n in enumerate([40, 13, 5, 20])]
    docs = []
    for i in range(60):
        w = sentence(rng, rng.choice([10, 100, 300])).split()
        item = items[i % 4][1].split()
        a = rng.randrange(len(item))
        w[5:5] = [item, item[a:a + 12], [], item[2:]][rng.randrange(4)]
        docs.append((i, rng.choice([" ", ", "]).join(w).upper()))
    keep = []
    for i, t in docs:
        w, hit = re.findall("[a-z0-9]+", t.lower()), set()
        for _, x in items:
            x = x.split()
            n = min(13, len(x))
            windows = {tuple(x[k:k + n]) for k in range(len(x) - n + 1)}
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit |= set(range(k, k + n))
        if not (hit and 20 * len(hit) >= len(w)):
            keep.append(i)
    bench = spark.createDataFrame(items, "item_id long, text string")
    left = decontam.drop_contaminated(table(spark, docs), bench)
    assert sorted(r.doc_id for r in left.collect()) == keep and 10 < len(keep) < 55


def test_mix_stage(spark):
    """Raking and the budget, once more in plain numbers."""
    rng = random.Random(7)
    docs = [(i, sentence(rng, rng.choice([5, 60, 150, 400])) + rng.choice(["", " # $ % & | < >" * 40])) for i in range(200)] + [(200, None), (201, " ")]
    p = mixing.MixParams()
    rows = {r.doc_id: r for r in table(spark, docs).collect()}

    def cell(r):
        t = r.text or ""
        n, symbols = len(t.split()), sum(c in "#*$%&|<>" for c in t)
        topic = "markup" if 20 * symbols > len(t) else "note" if n < 100 else "article" if n < 1000 else "book"
        return (r.source, r.lang or "(none)", topic), n

    tokens = defaultdict(int)
    for r in rows.values():
        c, n = cell(r)
        tokens[c] += n
    total = sum(tokens.values())
    weight = {c: n / total for c, n in tokens.items()}
    target = []
    for dim, power in enumerate(p.powers):
        by = defaultdict(float)
        for c, n in tokens.items():
            by[c[dim]] += n
        by = {v: n**power for v, n in by.items() if n > 0}
        target.append({v: x / sum(by.values()) for v, x in by.items()})
    for _ in range(p.passes):
        for dim in range(3):
            have = defaultdict(float)
            for c, w in weight.items():
                have[c[dim]] += w
            weight = {c: w * target[dim].get(c[dim], 0) / have[c[dim]] if have[c[dim]] else 0.0 for c, w in weight.items()}
    out = {r.doc_id: r for r in P.stage_mix(spark, table(spark, docs), "").collect()}
    prob = {}
    for r in out.values():
        c = cell(rows[r.doc_id])[0]
        prob.setdefault(c, r.sampling_probability)
        assert prob[c] == r.sampling_probability
    # All cells of a probability below one have the same ratio of weight to tokens times probability.
    open_ = [prob[c] * tokens[c] / weight[c] for c in prob if prob[c] < 1 and weight[c] > 0]
    assert max(open_) == pytest.approx(min(open_), rel=1e-6)
    for i, r in rows.items():
        c, n = cell(r)
        u = int(hashlib.md5(f"{p.seed}:{i}".encode()).hexdigest()[:13], 16) / 16**13
        if c in prob:
            assert (i in out) == (n > 0 and u < prob[c])


def test_toxicity_fit_is_a_minimum(spark):
    """The fitted thresholds and weights are no worse than any neighbours in the penalised
    likelihood, which is written out here term by term."""
    rng = random.Random(8)
    texts, grades = [], []
    for _ in range(240):
        g = rng.choice([0, 0, 1, 2])
        texts.append(" ".join(rng.choices(WORDS, k=12) + ["bad"] * (g > 0 and rng.random() < 0.8) + ["worst"] * (g > 1 and rng.random() < 0.7)))
        grades.append(g)
    p = toxicity.ToxicityParams(min_docs=2, min_z=2.0, steps=4000)
    model = toxicity.fit(texts, grades, p, levels=3)
    assert model.thetas == sorted(model.thetas)

    def loss(thetas, scale):
        out = 0.0
        for t, g in zip(texts, grades):
            x = model.margin(t) * scale
            up = [1.0, *(1 / (1 + math.exp(-(x - th))) for th in thetas), 0.0]
            out -= math.log(up[g] - up[g + 1])
        return out + 0.05 * math.log(thetas[1] - thetas[0]) ** 2

    best = loss(model.thetas, 1.0)
    for a in (-0.2, 0.0, 0.2):
        for b in (-0.2, 0.0, 0.2):
            assert loss([model.thetas[0] + a, model.thetas[1] + b], 1.0) >= best - 1e-3
    means = [np.mean([model.severity(t) for t, g in zip(texts, grades) if g == k]) for k in range(3)]
    assert means == sorted(means) and means[2] - means[0] > 0.5


def test_toxicity_stage_keeps_what_its_model_calls_mild(spark, tmp_path):
    rng = random.Random(9)
    docs = [(i, sentence(rng, 15) + (" idiot scum trash" if i % 4 == 0 else "")) for i in range(200)]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(0, 200, 2)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    got = sorted(r.doc_id for r in P.stage_toxicity(spark, table(spark, docs), str(tmp_path)).collect())
    model = toxicity.train(table(spark, docs), labels)
    assert got == [i for i, t in docs if model.severity(t) < toxicity.ToxicityParams().reject_at]
    assert got == [i for i, _ in docs if i % 4]


def test_stages_on_awkward_and_empty_tables(spark, tmp_path):
    spark.createDataFrame([(4, 1, 1), (None, 1, 1), (6, None, None), (6, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "one two"), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    df = awkward(spark)
    for docs, n in ((df, df.count()), (df.limit(0), 0)):
        for name, stage in P.STAGES:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns[:5] == docs.columns, name
            assert out.count() <= n, name
    assert not [r for r in P.stage_decontaminate(spark, df, str(tmp_path)).collect() if r.doc_id == 6]
    assert P.stage_decontaminate(spark, df, str(tmp_path)).count() == df.count() - 1
    # Null ids, nulls and repeated rows are kept by the filters that have nothing against them.
    assert sorted(map(str, toxicity.drop_toxic(df, toxicity.OrdinalModel({}, [30.0, 31.0])).collect())) == sorted(map(str, df.collect()))
    mixed = P.stage_mix(spark, df, str(tmp_path))
    assert all(r.text and r.text.strip() for r in mixed.collect())
