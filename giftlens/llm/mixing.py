"""Mixing sources to target weights by iterative proportional fitting.

Token counts of the cells (source, language, topic) are raked until their
shares along each of the three dimensions equal given targets; a document is
then kept with its cell's calibrated probability.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from giftlens.llm.common import cut, read

DIMENSIONS = ("source", "lang", "topic")
NONE = "(none)"


@dataclass(frozen=True)
class MixParams:
    """``powers``: the target share of a value goes with its share of the tokens
    to this power (1 keeps the corpus as it is, 0 makes the values equal).
    ``passes``: rounds over the three dimensions.  ``keep``: share of the
    corpus' tokens to sample; a cell whose calibrated probability would exceed
    1 is kept whole.  ``seed``: of the documents' hash draws."""

    powers: tuple[float, float, float] = (0.7, 0.7, 0.7)
    passes: int = 8
    keep: float = 0.8
    seed: int = 17


def token_count(text: Column) -> Column:
    """Words between ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def topic_of(text: Column, tokens: Column) -> Column:
    """A coarse topic from a text's form: ``markup`` (more than one symbol of
    ``#*$%&|<>`` to 20 characters), else by length ``note``, ``article``, ``book``."""
    symbols = F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))
    return (F.when(20 * symbols > F.length(text), "markup")
            .when(tokens < 100, "note").when(tokens < 1000, "article").otherwise("book"))


def _prepared(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                    *[F.coalesce(F.col(c).cast("string"), F.lit(NONE)).alias(c) for c in ("source", "lang")])
    d = d.select("doc_id", "source", "lang", "text", token_count(F.col("text")).alias("tokens"))
    topic = topic_of(F.coalesce("text", F.lit("")), F.col("tokens"))
    return d.select("doc_id", *DIMENSIONS[:2], topic.alias("topic"), "tokens")


def power_targets(cells: DataFrame, dim: str, power: float) -> DataFrame:
    """(value, target): shares of the tokens to a power, normalised."""
    by = cells.groupBy(dim).agg(F.sum("tokens").cast("double").alias("t")).where("t > 0")
    by = by.select(F.col(dim).alias("value"), F.pow("t", F.lit(power)).alias("p"))
    total = by.agg(F.sum("p").alias("all"))
    return by.join(F.broadcast(total)).select("value", (F.col("p") / F.col("all")).alias("target"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], passes: int) -> DataFrame:
    """``cells`` (the dimensions and ``tokens``) with ``weight``: shares that
    start at the cells' shares of the tokens and meet each dimension's targets.

    Values without a target get weight 0; targets without a cell are left out
    and the others scaled up.  Cells without tokens have weight 0.  The table is
    one row per cell, however many documents; each step is an aggregation over
    cells, and lineage is cut after every pass."""
    total = cells.agg(F.sum("tokens").cast("double").alias("all"))
    w = cells.join(F.broadcast(total)).withColumn(
        "weight", F.coalesce(F.try_divide(F.col("tokens").cast("double"), F.col("all")), F.lit(0.0))).drop("all")
    for i, (dim, target) in enumerate(targets.items()):
        t = target.select(F.col("value").alias(dim), F.col("target").cast("double").alias(f"_t{i}"))
        w = w.join(t, dim, "left").withColumn(f"_t{i}", F.coalesce(f"_t{i}", F.lit(0.0)))
    w = cut(w)
    for _ in range(passes):
        for i, dim in enumerate(targets):
            now = w.groupBy(dim).agg(F.sum("weight").alias("_now"))
            w = w.join(now, dim).withColumn("weight", F.coalesce(
                F.try_divide(F.col("weight") * F.col(f"_t{i}"), F.col("_now")), F.lit(0.0))).drop("_now")
        w = cut(w)
    return w.drop(*[f"_t{i}" for i in range(len(targets))])


def probabilities(cells: DataFrame, keep: float, rounds: int = 6) -> DataFrame:
    """Adds ``probability`` to raked cells: proportional to weight per token and
    at most 1, scaled so that ``keep`` of the tokens are expected.  Cells at 1
    leave their surplus to the others, ``rounds`` times over."""
    total = F.sum(F.when(F.col("weight") > 0, F.col("tokens")).otherwise(0)).cast("double")
    c = cells.withColumn("rate", F.coalesce(F.try_divide("weight", F.col("tokens").cast("double")), F.lit(0.0)))
    c = c.withColumn("probability", F.lit(0.0))
    for _ in range(rounds):
        open_, full = F.col("probability") < 1, F.col("probability") >= 1
        s = c.agg((F.lit(keep) * total
                   - F.sum(F.when(full, F.col("tokens")).otherwise(0))).alias("_left"),
                  F.sum(F.when(open_, F.col("weight")).otherwise(0.0)).alias("_open"))
        c = c.join(F.broadcast(s)).withColumn("probability", F.when(full, F.lit(1.0)).otherwise(
            F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce(
                F.try_divide("_left", "_open"), F.lit(0.0))) * F.col("rate")))).drop("_left", "_open")
    return c.drop("rate")


def draw(doc_id: Column, seed: int) -> Column:
    """A number in [0, 1) fixed by the id: 52 bits of an MD5 hash."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


def mix(docs: DataFrame, params: MixParams = MixParams(),
        targets: dict[str, DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """``(documents, cells)``: (doc_id, source, lang, topic, tokens, probability,
    sampled) a row per row of ``docs``, and the raked cells.

    ``targets``: for each dimension a table (value, target); by default powers
    of the token shares.  A null source or language is the value ``(none)``.  A
    document without words has no tokens to mix and is never sampled.  The draw
    depends on the id alone: repeated rows are drawn alike, rows with a null id
    too.  An empty table gives an empty result.
    """
    d = _prepared(docs)
    cells = cut(d.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens"),
                                           F.count(F.lit(1)).alias("documents")))
    targets = targets or {c: power_targets(cells, c, p) for c, p in zip(DIMENSIONS, params.powers, strict=True)}
    raked = cut(probabilities(rake(cells, targets, params.passes), params.keep))
    rates = raked.select(*DIMENSIONS, F.round("probability", 9).alias("probability"))
    out = d.join(rates, list(DIMENSIONS)).withColumn(
        "sampled", (F.col("tokens") > 0) & (draw(F.col("doc_id"), params.seed) < F.col("probability")))
    return out.select("doc_id", *DIMENSIONS, "tokens", "probability", "sampled"), raked


def sample_mix(docs: DataFrame, params: MixParams = MixParams(),
               targets: dict[str, DataFrame] | None = None) -> DataFrame:
    """The sampled rows of ``docs``, all columns, plus ``sampling_probability``.
    The probabilities are joined by cell, so whole texts are never shuffled
    when the cell table is small enough for Spark to broadcast."""
    _, raked = mix(docs, params, targets)
    rates = raked.select(*[F.col(c).alias(f"_{c}") for c in DIMENSIONS],
                         F.round("probability", 9).alias("sampling_probability"))
    own = [c for c in docs.columns if c != "sampling_probability"]
    text = F.col("row.text").cast("string")
    src = docs.select(F.struct(*own).alias("row")).withColumn("_n", token_count(text))
    src = src.select("row", "_n", topic_of(F.coalesce(text, F.lit("")), F.col("_n")).alias("_topic"),
                     *[F.coalesce(F.col(f"row.{c}").cast("string"), F.lit(NONE)).alias(f"_{c}") for c in ("source", "lang")])
    both = src.join(rates, [f"_{c}" for c in DIMENSIONS])
    return (both.where((F.col("_n") > 0) & (draw(F.col("row.doc_id").cast("long"), params.seed)
                                            < F.col("sampling_probability")))
            .select("row.*", "sampling_probability"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, _ = mix(read(spark, sf_dir, "documents"))
    return out


def _oracle(p: MixParams = MixParams()) -> str:
    """The same steps, unrolled, in DuckDB SQL."""
    parts = [r"""
WITH d0 AS (
  SELECT doc_id, coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang,
    coalesce(text, '') AS text, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS tokens
  FROM documents
), d AS (
  SELECT doc_id, source, lang, tokens, CASE
    WHEN 20 * (length(text) - length(translate(text, '#*$%&|<>', ''))) > length(text) THEN 'markup'
    WHEN tokens < 100 THEN 'note' WHEN tokens < 1000 THEN 'article' ELSE 'book' END AS topic FROM d0
), c0 AS (SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens FROM d GROUP BY ALL)"""]
    for dim, power in zip(DIMENSIONS, p.powers, strict=True):
        parts.append(f"p_{dim} AS (SELECT {dim}, pow(sum(tokens), {power}) AS p FROM c0 GROUP BY {dim} "
                     f"HAVING sum(tokens) > 0), t_{dim} AS (SELECT {dim}, p / sum(p) OVER () AS target FROM p_{dim})")
    parts.append("w0 AS (SELECT *, tokens / sum(tokens) OVER () AS weight FROM c0)")
    n = 0
    for _ in range(p.passes):
        for dim in DIMENSIONS:
            parts.append(
                f"w{n + 1} AS MATERIALIZED (SELECT w.* EXCLUDE (weight), coalesce(weight * coalesce(target, 0) / nullif("
                f"sum(weight) OVER (PARTITION BY {dim}), 0), 0) AS weight FROM w{n} w LEFT JOIN t_{dim} USING ({dim}))")
            n += 1
    parts.append(f"q0 AS (SELECT *, coalesce(weight / nullif(tokens, 0), 0) AS rate, 0.0::DOUBLE AS probability FROM w{n})")
    for i in range(6):
        parts.append(f"""q{i + 1} AS MATERIALIZED (SELECT * EXCLUDE (probability), CASE WHEN probability >= 1 THEN 1.0
    ELSE least(1.0, greatest(0.0, coalesce(({p.keep} * sum(CASE WHEN weight > 0 THEN tokens ELSE 0 END) OVER ()
      - sum(CASE WHEN probability >= 1 THEN tokens ELSE 0 END) OVER ())
      / nullif(sum(CASE WHEN probability < 1 THEN weight ELSE 0 END) OVER (), 0), 0)) * rate) END AS probability FROM q{i})""")
    return ",\n".join(parts) + f"""
SELECT d.doc_id, d.source, d.lang, d.topic, d.tokens, round(q.probability, 9) AS probability,
  d.tokens > 0 AND ('0x' || md5('{p.seed}:' || coalesce(d.doc_id::VARCHAR, ''))[1:13])::BIGINT / {float(16**13)}
    < round(q.probability, 9) AS sampled
FROM d JOIN q6 q ON q.source = d.source AND q.lang = d.lang AND q.topic = d.topic"""


ORACLE = _oracle()
