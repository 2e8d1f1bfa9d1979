"""Secret scan, in DataFrame and SQL functions only.

Three fixed patterns give the base spans.  Besides, candidate strings (long runs
of key characters) are scanned with a sliding window whose Shannon entropy is
kept up to date by the counts of the characters that enter and leave; a window
over its character class's threshold marks a span, unless it touches a string of
the allow-list.  All work stays within a row and about linear in its text.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from giftlens.llm.common import read

# Fixed patterns of the contract, in the order of their kinds.
ASSIGN = (r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
KINDS = (("assign", ASSIGN), ("access", r"AKIA[A-Z0-9]{12,}"), ("hex", r"[0-9a-f]{32,}"))

# Placeholders and well-known digests that are no secrets.
ALLOWED = (r"(?i)example|sample|placeholder|changeme|xxxx|0123456789|abcdefgh|"
           r"da39a3ee5e6b4b0d3255bfef95601890afd80709|d41d8cd98f00b204e9800998ecf8427e|"
           r"e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855")


@dataclass(frozen=True)
class EntropyParams:
    """Candidates are runs of ``[A-Za-z0-9+/_=-]`` of ``shortest`` characters or
    more.  Windows of ``window`` characters; thresholds in bits a character for
    hexadecimal strings, alphanumeric strings and others.  Strings without a
    digit, or of one letter case and no digit, are words and not looked at."""

    shortest: int = 20
    window: int = 20
    hex_bits: float = 3.0
    alnum_bits: float = 3.6
    other_bits: float = 3.8


#: Stands before and after every match; never matched by a pattern.  Texts that
#: hold it have it read as another character no pattern matches.
_MARK, _PLAIN = "\ue000", "\ue001"

# Characters of candidates, in the order of their counters.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value evaluated once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _pieces(text: Column, pattern: str) -> Column:
    """``text`` cut around a pattern's leftmost non-overlapping matches: every second
    piece, from the second on, is a match."""
    return F.split(F.regexp_replace(text, F.lit(f"(?:{pattern})"), F.lit(f"{_MARK}$0{_MARK}")), _MARK)


def _placed(pieces: Column, odd: int) -> Column:
    """Array of (start, end, string) of the pieces with an index of that remainder, in code
    points, end exclusive.  Places are summed up in about sqrt(n) blocks of sqrt(n)
    pieces, as adding to an array copies it: n pieces cost n^1.5 copies."""
    empty = F.array().cast("array<struct<start:bigint,end:bigint,string:string>>")
    zero = F.lit(0).cast("long")

    def step(acc, x):
        end = acc["at"] + F.length(x)
        span = F.struct(acc["at"].alias("start"), end.alias("end"), x.alias("string"))
        return F.struct(end.alias("at"), (acc["k"] + 1).alias("k"),
                        F.when(acc["k"] % 2 == odd, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    def blocks(p):
        long = F.greatest(F.lit(64), F.ceil(F.sqrt(F.size(p).cast("double"))).cast("int"))
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(p) - 1) / long).cast("int")), lambda b: F.aggregate(
            F.slice(p, b * long + 1, long), F.struct(zero.alias("at"), (b * long).cast("long").alias("k"), empty.alias("out")), step))

    def join(parts):
        nothing = F.struct(zero.alias("at"), F.array().cast("array<bigint>").alias("out"))
        begins = F.aggregate(parts, nothing, lambda acc, x: F.struct(
            (acc["at"] + x["at"]).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])
        return F.flatten(F.zip_with(parts, begins, lambda x, at: F.transform(x["out"], lambda s: F.struct(
            (s["start"] + at).alias("start"), (s["end"] + at).alias("end"), s["string"].alias("string")))))

    return _bind(_bind(pieces, blocks), join)


def _spans(text: Column, pattern: str, kind: str, rank: int, keep=None) -> Column:
    """Array of (start, rank, end, kind, string) of a pattern's leftmost
    non-overlapping matches that ``keep`` holds for."""
    def spans(pieces):
        found = _placed(pieces, 1)
        if keep:
            found = F.filter(found, lambda x: keep(x["string"]))
        return F.transform(found, lambda x: F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end"),
                                                     F.lit(kind).alias("kind"), x["string"].alias("string")))

    empty = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string,string:string>>")
    return _bind(_pieces(text, pattern), lambda p: F.when(F.size(p) > 1, spans(p)).otherwise(empty))


def base_spans(text: Column) -> list[Column]:
    """The three kinds' spans; an assignment counts from 8 characters of value."""
    return [_spans(text, pattern, kind, i,
                   (lambda x: F.length(F.regexp_extract(x, ASSIGN, 2)) >= 8) if kind == "assign" else None)
            for i, (kind, pattern) in enumerate(KINDS)]


def entropy_range(s: Column, window: int, bits: Column) -> Column:
    """(first, last): starts of the first and last window of ``s`` whose entropy
    is at least ``bits``; nulls if there is none.

    H = log2(w) - sum(c log2 c)/w.  The counts of the 66 characters stand side by side
    in a few longs; a step adds one to the entering character's, takes one from the
    leaving one's, and changes the sum by what the two counts change, so the whole is
    linear in the string, whatever the window."""
    if not 0 < window <= 127:
        raise ValueError("windows have 1 to 127 characters")
    wide = window.bit_length()
    per = 62 // wide                                               # counts to a long
    lanes = -(-len(ALPHABET) // per)
    place = [0] * 128
    for i, c in enumerate(ALPHABET):
        place[ord(c)] = i
    one = F.lit(1).cast("long")
    # What c + 1 occurrences have over c, of n log2 n.
    more = F.array(*[F.lit((k + 1) * math.log2(k + 1) - (k * math.log2(k) if k else 0.0)) for k in range(window + 1)])
    codes = F.transform(F.split(s, ""), lambda ch: F.get(F.array(*[F.lit(i) for i in place]), F.ascii(ch)))
    codes = F.transform(codes, lambda c: F.struct(
        F.floor(c / per).cast("int").alias("lane"), ((c % per) * wide).alias("shift"),
        F.call_function("shiftleft", one, ((c % per) * wide).cast("int")).alias("unit"), c.alias("code")))
    nobody = F.struct(F.lit(-1).alias("lane"), F.lit(0).alias("shift"), F.lit(0).cast("long").alias("unit"), F.lit(-1).alias("code"))

    def moves(x):
        gone = F.concat(F.array_repeat(nobody, F.least(F.lit(window), F.size(x))), F.slice(x, F.lit(1), F.greatest(F.size(x) - window, F.lit(0))))
        return F.zip_with(x, gone, lambda a, b: F.struct(a.alias("into"), b.alias("out")))

    def count(n, c):
        return F.call_function("shiftright", F.get(n, c["lane"]), c["shift"].cast("int")).bitwiseAND(F.lit((1 << wide) - 1)).cast("int")

    def step(acc, m):
        into, out = m["into"], m["out"]
        gone = count(acc["n"], out) + F.when(into["code"] == out["code"], 1).otherwise(0)
        total = (acc["sum"] + F.get(more, count(acc["n"], into))
                 - F.when(out["lane"] >= 0, F.get(more, gone - 1)).otherwise(F.lit(0.0)))
        n = F.transform(acc["n"], lambda c, k: c + F.when(k == into["lane"], into["unit"]).otherwise(F.lit(0).cast("long"))
                        - F.when(k == out["lane"], out["unit"]).otherwise(F.lit(0).cast("long")))
        return F.struct((acc["i"] + 1).alias("i"), n.alias("n"), total.alias("sum"), acc["first"].alias("first"), acc["last"].alias("last"))

    def judge(acc):
        over = (acc["i"] >= window) & (F.lit(math.log2(window)) - acc["sum"] / window >= bits - 1e-9)
        at = acc["i"] - window
        return F.struct(acc["i"].alias("i"), acc["n"].alias("n"), acc["sum"].alias("sum"),
                        F.when(over & acc["first"].isNull(), at).otherwise(acc["first"]).alias("first"),
                        F.when(over, at).otherwise(acc["last"]).alias("last"))

    none = F.lit(None).cast("int")
    start = F.struct(F.lit(0).alias("i"), F.array_repeat(F.lit(0).cast("long"), lanes).alias("n"), F.lit(0.0).alias("sum"),
                     none.alias("first"), none.alias("last"))
    return F.aggregate(_bind(codes, moves), start, lambda acc, m: _bind(step(acc, m), judge),
                       lambda acc: F.struct(acc["first"].alias("first"), acc["last"].alias("last")))


def entropy_spans(text: Column, p: EntropyParams = EntropyParams()) -> Column:
    """Spans of kind ``entropy``: from the first to the last window over the threshold of
    a candidate's parts.  The allow-list cuts a candidate into the parts between its
    listed strings, so a window that touches one is suppressed and no other."""
    word = f"[A-Za-z0-9+/_=-]{{{p.shortest},}}"
    mixed = lambda x: x.rlike("[0-9]") & x.rlike("[A-Za-z]")
    found = _spans(text, word, "entropy", len(KINDS), mixed)

    def parts(x):
        whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.length(x["string"]).cast("long").alias("end"), x["string"].alias("string")))
        free = F.when(x["string"].rlike(ALLOWED), _placed(_pieces(x["string"], ALLOWED), 0)).otherwise(whole)
        free = F.filter(free, lambda y: (F.length(y["string"]) >= p.window) & mixed(y["string"]))
        return F.transform(free, lambda y: F.struct((x["start"] + y["start"]).alias("start"), y["string"].alias("string")))

    def judge(x):
        s = x["string"]
        bits = (F.when(s.rlike("^([0-9a-f]+|[0-9A-F]+)$"), p.hex_bits)
                .when(s.rlike("^[A-Za-z0-9]+$"), p.alnum_bits).otherwise(p.other_bits))
        found = _bind(bits, lambda b: entropy_range(s, p.window, b))
        return _bind(found, lambda r: F.struct(
            (x["start"] + r["first"]).alias("start"), F.lit(len(KINDS)).alias("rank"), (x["start"] + r["last"] + p.window).alias("end"),
            F.lit("entropy").alias("kind"), F.lit("").alias("string")))

    return F.filter(F.transform(F.flatten(F.transform(found, parts)), judge), lambda x: x["start"].isNotNull())


def _listed(spans: Column) -> Column:
    """kind:start:end, by start, then kind as listed, comma-joined."""
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def scan(docs: DataFrame, p: EntropyParams = EntropyParams()) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base, spans)``, a row per row of
    ``docs``: the base spans' numbers and list, and the list of all spans.

    A null text is empty and has no span.  Rows are scanned one by one, whole;
    repeated rows and null ids need no rule.  Only ``doc_id`` and ``text`` are
    read."""
    text = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), _MARK, _PLAIN)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("body"))
    assign, access, hexes = base_spans(F.col("body"))
    d = d.select("doc_id", assign.alias("a"), access.alias("b"), hexes.alias("c"),
                 entropy_spans(F.col("body"), p).alias("e"))
    return d.select("doc_id", *[F.size(c).cast("long").alias(n) for c, n in (
        ("a", "n_assign"), ("b", "n_access"), ("c", "n_hex"))],
        _listed(F.concat("a", "b", "c")).alias("base"), _listed(F.concat("a", "b", "c", "e")).alias("spans"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans")
