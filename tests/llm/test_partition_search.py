"""Search by learned partitions against brute force."""

import numpy as np
import pytest

from conftest import MEDIUM
from giftlens.llm import partition_search as S
from giftlens.llm import queries

SCHEMA = "vec_id long, embedding array<float>, label int, part int, query string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows], SCHEMA)


def brute(rows, top=5):
    """{query_id: [(vec_id, score)]} over usable rows of the usual length."""
    size = max({len(v) for _, v in rows if v}, key=lambda d: (sum(len(v or []) == d for _, v in rows), d))
    rows = [(i, np.float32(v).astype(float)) for i, v in rows
            if v is not None and len(v) == size and all(c is not None and np.isfinite(np.float32(c)) for c in v) and any(v)]
    out = {}
    for q, y in rows:
        if q is None or q % 50:
            continue
        near = [(-float((x * y).sum() / (np.sqrt((x * x).sum()) * np.sqrt((y * y).sum()))), i is None, i or 0) for i, x in rows if i != q]
        out[q] = [(None if n else i, -s) for s, n, i in sorted(near)[:top]]
    return out


def got(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def same(a, b):
    assert a.keys() == b.keys()
    for q in a:
        assert [i for i, _ in a[q]] == [i for i, _ in b[q]]
        assert np.allclose([s for _, s in a[q]], [s for _, s in b[q]], atol=1e-14)


def test_awkward_rows_small_table(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((120, 6))
    x[3:90:3] = x[0]                                             # a hot vector, many ties
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(None, x[50].tolist()), (50, x[50].tolist()), (100, x[7].tolist()),
            (1000, None), (1050, []), (1100, [0.0] * 6), (1150, [None, 1.0, 1.0, 1.0, 1.0, 1.0]), (1200, [float("nan")] * 6),
            (1250, [float("inf")] + [1.0] * 5), (1300, [1.0, 2.0])]
    out = S.search(table(spark, rows))
    assert out.columns == ["query_id", "rank", "vec_id", "score"]
    rows.remove((100, x[7].tolist()))                             # a second vector of id 100: its rows come besides
    both = out.where("query_id != 100")
    want = brute(rows + [(100, x[7].tolist())])
    same(got(both), {q: v for q, v in want.items() if q != 100})
    assert out.where("query_id = 100").count() == 10


@pytest.mark.parametrize("rows", [[], [(50, [1.0])], [(50, None)], [(50, [0.0, 0.0])], [(1, [1.0]), (2, [2.0])]])
def test_nothing_to_find(spark, rows):
    assert S.search(table(spark, rows)).collect() == []


def test_fewer_candidates_than_asked(spark):
    out = S.search(table(spark, [(50, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 3.0])])).collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in sorted(out)] == [(50, 1, 1, 1.0), (50, 2, 2, 0.0)]


def test_recall_and_scores_on_many_parts(spark):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((40, 16)) * 2
    x = centres[rng.integers(0, 40, 3000)] + rng.standard_normal((3000, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    p = S.SearchParams(sample=1500, spread=4, block=100)
    found, want = got(S.search(table(spark, rows), p=p)), brute(rows)
    assert found.keys() == want.keys()
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    exact = {(q, i): s for q, v in brute(rows, 3000).items() for i, s in v}
    assert all(abs(exact[q, i] - s) < 1e-14 for q, v in found.items() for i, s in v)


def test_query_reaches_the_recall(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{MEDIUM}/embeddings.parquet").collect()]
    found, want = got(queries.queries()["op13_partition_search"](spark, MEDIUM)), brute(rows)
    assert sum(len({i for i, _ in found[q]} & {i for i, _ in want[q]}) for q in want) >= 0.9 * 5 * len(want)


def test_parts_are_balanced_and_keep_edges():
    rng = np.random.default_rng(2)
    x = S.unit(np.repeat(rng.standard_normal((8, 12)) * 3, 50, axis=0) + rng.standard_normal((400, 12)))
    near = S.neighbours(x, 10)
    part = S.balanced_parts(near, 8, 1.1)
    assert np.bincount(part, minlength=8).max() <= 55 and len(set(part)) == 8
    assert (part[near] == part[:, None]).mean() > 0.7


def test_router_learns_its_target():
    rng = np.random.default_rng(3)
    x = S.unit(rng.standard_normal((600, 8)))
    target = np.eye(4)[(x[:, 0] > 0) * 2 + (x[:, 1] > 0)]
    router = S.Router(8, 4, S.SearchParams())
    router.fit(x, target, S.SearchParams())
    assert (router.probabilities(x).argmax(axis=1) == target.argmax(axis=1)).mean() > 0.95
