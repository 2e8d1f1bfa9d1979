"""The conversation trie against a plain dictionary of prefixes."""

import random
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest

from conftest import SMALL  # noqa: F401
from giftlens.llm import conversation_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string, h1 long, layer int, c string"


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, x in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        lender = c - (c % 5 if c >= 0 else -(-c % 5))
        path = tuple(own.get(lender, [])[:h] + x[h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    kids = defaultdict(int)
    for n in members:
        if n:
            kids[n[:-1]] += 1
    out = {}
    leaves, saved = defaultdict(int), defaultdict(int)
    for n in members:
        own_saved = (len(members[n]) - 1) * len(n[-1][1].encode()) if n else 0
        for d in range(len(n) + 1):
            leaves[n[:d]] += not kids[n]
            saved[n[:d]] += own_saved
    for n, m in members.items():
        out[n] = (min(m), len(n), min(members[n[:-1]]) if n else None, len(m), kids[n], leaves[n], saved[n],
                  sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest())
    return sorted(out.values(), key=str)


def run(spark, rows, p):
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA)
    out = trie.prefix_trie(df, p)
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def talk(rng, words, turns):
    return [(rng.choice([None, "user", "assistant"]), rng.choice(words)) for _ in range(turns)]


@pytest.mark.parametrize("p", [trie.TrieParams(), trie.TrieParams(span=3, shard=2)])
def test_trie_equals_prefix_dictionary(spark, p):
    rng = random.Random(8)
    rows = []
    for c in [*range(-7, 60), 1000, 1001, 1002]:
        x = talk(rng, ["a", "bé", "", None], rng.choice([0, 1, 2, 3, 6, 11]))
        rows += [(c, rng.choice([None, i]), *t) for i, t in enumerate(x)]
    rows += [(None, 0, "user", "lost"), (7, 3, "user", "tie"), (7, 3, "user", "tie"), (7, 3, "assistant", "tie")]
    assert run(spark, rows, p) == brute(rows)


def test_long_shared_paths_cross_layers(spark):
    rng = random.Random(2)
    stem = talk(rng, [str(i) for i in range(50)], 40)
    rows = []
    for c, x in {0: stem, 5: stem, 10: stem[:33] + talk(rng, ["q"], 9), 15: stem[:7], 20: stem[:16], 25: stem + [("user", "end")],
                 30: stem[:30] + talk(rng, ["z", "y"], 10), 35: talk(rng, ["r", "s"], 30), 40: stem[:33] + talk(rng, ["q"], 9)}.items():
        rows += [(c, i, *t) for i, t in enumerate(x)]
    for p in (trie.TrieParams(span=4, shard=1), trie.TrieParams(span=8, shard=3)):
        assert run(spark, rows, p) == brute(rows)


def test_no_conversation_no_node(spark):
    assert run(spark, [], trie.TrieParams()) == []
    assert run(spark, [(None, 1, "user", "x")], trie.TrieParams()) == []


def test_borrowed_turns_only(spark):
    """A conversation whose turns are all replaced by those of a missing lender is
    turnless and ends at the root."""
    c = next(c for c in range(1, 99) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 2)
    rows = [(c, 0, "user", "x"), (c, 1, "user", "y")]
    assert run(spark, rows, trie.TrieParams()) == brute(rows)
    assert len(brute(rows)) == 1


def test_double_array_holds_its_paths_only():
    rng = random.Random(4)
    paths = [[rng.randint(1, 9) for _ in range(rng.randint(0, 6))] for _ in range(200)]
    t = trie.DoubleArray(paths)
    known = {tuple(p[:d]) for p in paths for d in range(len(p) + 1)}
    states = {}
    for n in sorted(known, key=len):
        states[n] = trie_state = 0
        for x in n:
            trie_state = t.child(trie_state, x)
            assert trie_state > 0
        states[n] = trie_state
        assert all((t.child(trie_state, x) > 0) == ((*n, x) in known) for x in range(1, 12))
    assert len(set(states.values())) == len(known)
