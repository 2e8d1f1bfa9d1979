"""Line-first quality rules, in DataFrame and SQL functions only.

Every line is judged by punctuation, navigation and boilerplate rules; failing
lines go; a document that loses too much of its text, or fails the base counts,
is rejected.  All work stays within a row: nothing is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from giftlens.llm.common import read

# Fixed values of the contract.
BLANK = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

# Phrases of lines that frame a page instead of belonging to its text.
BOILERPLATE = ("all rights reserved", "privacy policy", "terms of use", "terms of service", "cookie policy",
               "accept cookies", "enable javascript", "javascript is disabled", "lorem ipsum", "click here",
               "sign up for our newsletter", "subscribe to our newsletter", "powered by", "read more",
               "share on", "back to top", "skip to content")


@dataclass(frozen=True)
class QualityParams:
    """A line fails if symbols make up more than 1 in ``symbol_share`` of its
    characters (punctuation), if it has ``nav_separators`` or more of ``| > »``
    between at most ``nav_words`` words (navigation), or if it has at most
    ``boiler_words`` words and a boilerplate phrase.  A document is rejected if
    more than ``lost_percent`` percent of its word characters go."""

    symbol_share: int = 10
    nav_separators: int = 2
    nav_words: int = 12
    boiler_words: int = 20
    lost_percent: int = 50


def _n(c: Column) -> Column:
    return c.cast("long")


def _stripped(c: Column) -> Column:
    """Without ASCII white space."""
    return F.translate(c, BLANKS, "")


def _count_of(c: Column, chars: str) -> Column:
    return F.length(c) - F.length(F.translate(c, chars, ""))


def line_fails(line: Column, p: QualityParams = QualityParams()) -> Column:
    """Whether a line breaks a rule; a line without words never does."""
    symbols = p.symbol_share * _count_of(line, SYMBOLS) > F.length(_stripped(line))
    nav = (_count_of(line, "|>»") >= p.nav_separators) & (F.regexp_count(line, F.lit(WORD)) <= p.nav_words)
    phrase = (F.lower(line).rlike("|".join(BOILERPLATE))
              & (F.regexp_count(line, F.lit(WORD)) <= p.boiler_words))
    return symbols | nav | phrase


def _repeat_words(words: Column) -> tuple[Column, Column]:
    """(hashes of the 8-word windows, words covered by repeated windows)."""
    grams = F.when(F.size(words) >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW),
        lambda i: F.xxhash64(*[F.get("word_hashes", i + k) for k in range(WINDOW)])))
    # Sorted by hash, a window is repeated if a neighbour has its hash.
    ordered = F.array_sort(F.transform("grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    same = F.filter(F.transform("ordered", lambda x, k: F.struct(
        x["i"].alias("i"),
        (x["g"].eqNullSafe(F.get("ordered", k - 1)["g"]) | x["g"].eqNullSafe(F.get("ordered", k + 1)["g"])).alias("r"))),
        lambda x: x["r"])
    starts = F.array_sort(F.transform(same, lambda x: x["i"]))
    return grams, ordered, starts


def judged(docs: DataFrame, p: QualityParams = QualityParams()) -> DataFrame:
    """``docs`` with ``clean_text`` (the text without failing lines), ``n_words``,
    ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``,
    ``base_failed``, ``lost_chars`` and ``kept``; columns of these names in
    ``docs`` are replaced.

    Null texts count as having no words (and keep a null ``clean_text``); texts
    of fewer than 20 words fail the base rules.  Rows are judged one by one, so
    repeated rows, ties and null ids need no rule.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    names = ["clean_text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
             "base_failed", "lost_chars", "kept"]
    own = [c for c in docs.columns if c not in names]
    d = docs.select(F.struct(*own).alias("_row"), text.alias("body"))
    d = d.select("_row", "body", F.filter(F.split("body", BLANK), lambda w: w != "").alias("words"),
                 F.split("body", "\n").alias("lines"))
    d = d.select("_row", "body", "lines", _n(F.size("words")).alias("n_words"),
                 F.transform("words", lambda w: F.xxhash64(w)).alias("word_hashes"),
                 F.filter("lines", lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("full"))
    grams, ordered, starts = _repeat_words(F.col("word_hashes"))
    d = d.withColumn("grams", grams).drop("word_hashes")
    repeats = F.size(F.array_distinct("grams")) < F.size("grams")
    d = d.withColumn("ordered", F.when(repeats, ordered)).drop("grams")
    d = d.withColumn("starts", F.when(F.col("ordered").isNotNull(), starts)).drop("ordered")
    covered = F.aggregate(
        F.sequence(F.lit(1), F.size("starts") - 1), F.lit(WINDOW).cast("long"),
        lambda acc, k: acc + F.least(F.lit(WINDOW), F.get("starts", k) - F.get("starts", k - 1)).cast("long"))
    d = d.withColumn("n_repeat_words", F.coalesce(F.when(F.size("starts") > 1, covered), F.lit(0)).cast("long"))
    good = F.filter("lines", lambda x: ~line_fails(x, p))
    d = d.withColumn("good", good)
    d = d.select(
        "_row", "n_words", "n_repeat_words",
        F.array_join("good", "\n").alias("clean_text"),
        _n(F.length(_stripped(F.col("body")))).alias("word_chars"),
        _n(_count_of(F.col("body"), SYMBOLS)).alias("n_symbols"),
        _n(F.size("full") - F.size(F.array_distinct("full"))).alias("n_dup_lines"))
    lost = F.col("word_chars") - F.length(_stripped(F.col("clean_text")))
    d = (d.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))
         .withColumn("lost_chars", _n(lost)))
    d = d.withColumn("kept", ~F.col("base_failed") & (100 * F.col("lost_chars") <= p.lost_percent * F.col("word_chars")))
    clean = F.when(F.col("_row.text").isNotNull(), F.col("clean_text")).alias("clean_text")
    return d.select("_row.*", clean, *names[1:])


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return judged(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                               "base_failed", "kept", "lost_chars")


def _oracle(p: QualityParams = QualityParams()) -> str:
    word_chars = "length(regexp_replace({0}, '[\\x20\\x09-\\x0D]+', '', 'g'))"
    words = "len(regexp_extract_all({0}, '[^\\x20\\x09-\\x0D]+'))"
    fails = f"""({p.symbol_share} * (length(l) - length(translate(l, '{SYMBOLS}', ''))) > {word_chars.format('l')}
      OR (length(l) - length(translate(l, '|>»', '')) >= {p.nav_separators} AND {words.format('l')} <= {p.nav_words})
      OR (regexp_matches(lower(l), '{"|".join(BOILERPLATE)}') AND {words.format('l')} <= {p.boiler_words}))"""
    return rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS body, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
    string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), g AS (
  SELECT doc_id, unnest(range(1, len(ws) - 6)) AS i,
    unnest(list_transform(range(1, len(ws) - 6), lambda k: array_to_string(ws[k:k + 7], ' '))) AS gram
  FROM d WHERE len(ws) >= 8
), rep AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM g) WHERE c > 1
), r AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM rep) GROUP BY doc_id
), l AS (
  SELECT doc_id, l, row_number() OVER () AS rn FROM (SELECT doc_id, unnest(ls) AS l FROM d)
), f AS (
  SELECT doc_id, count(*) FILTER (regexp_matches(l, '[^\x20\x09-\x0D]'))
      - count(DISTINCT l) FILTER (regexp_matches(l, '[^\x20\x09-\x0D]')) AS dup,
    coalesce(sum({word_chars.format('l')}) FILTER (WHERE {fails}), 0) AS lost
  FROM l GROUP BY doc_id
), o AS (
  SELECT d.doc_id, len(ws)::BIGINT AS n_words, {word_chars.format('body')}::BIGINT AS word_chars,
    (length(body) - length(translate(body, '{SYMBOLS}', '')))::BIGINT AS n_symbols,
    f.dup::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words, f.lost::BIGINT AS lost_chars
  FROM d JOIN f USING (doc_id) LEFT JOIN r USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lost_chars,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
    AND 100 * lost_chars <= {p.lost_percent} * word_chars AS kept
FROM o"""


ORACLE = _oracle()
