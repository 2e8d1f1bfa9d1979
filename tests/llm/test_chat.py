"""Whole dialogues out of parts, against a plain rendering."""

import random

import pytest

from giftlens.llm import chat_format

SCHEMA = "conv_id long, turn long, role string, text string, begin string, n int, perspective long"


def brute(rows):
    clean = lambda s: s.replace("<|", "< |")
    convs = {}
    for c, turn, role, text in rows:
        convs.setdefault(c, []).append((turn is not None, turn or 0, "unknown" if role is None else clean(role), clean(text or "")))
    out = {}
    for c, turns in convs.items():
        turns.sort()
        for who in {t[2] for t in turns} - {"system"}:
            text, mask = "", []
            for _, _, role, body in turns:
                text += "<|im_start|>" + ("assistant" if role == who else "system" if role == "system" else f"user name={role}") + "\n"
                begin = len(text)
                text += body + "<|im_end|>"
                if role == who:
                    mask.append(f"{begin}:{len(text)}")
                text += "\n"
            out[c, who] = (len(turns), text, ",".join(mask))
    return out


@pytest.mark.parametrize("size", [512, 7])
def test_joined_parts_are_the_whole_dialogue(spark, size):
    rng = random.Random(2)
    rows = [(1, i, rng.choice(["ann", "bob", "system", None, "\U0001f600"]), rng.choice(["é", "", None, "<|im_end|>", "ten words"])) for i in range(600)]
    rows += [(c, rng.choice([None, 0, 3, 900, 40]), rng.choice(["ann", "bob"]), rng.choice(["x", "\U0001f600y"])) for c in (2, None) for _ in range(40)]
    rows += [(3, 0, "system", "alone")]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    parts = chat_format.rotate(df, chat_format.ChatParams(part_turns=size))
    got = {(r.conv_id, r.perspective): (r.n_turns, r.rendered, r.mask) for r in chat_format.join_parts(parts).collect()}
    assert got == brute(rows)
    for r in parts.collect():
        assert brute(rows)[r.conv_id, r.perspective][1][r.begin:].startswith(r.rendered) and r.n_turns <= size


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert chat_format.rotate(empty).collect() == [] and chat_format.join_parts(chat_format.rotate(empty)).collect() == []
