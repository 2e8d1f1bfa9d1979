"""URL filter: rules first, then trust and distrust propagated over host links.

Hosts are linked by the hyperlinks of their pages and by their domain tree (a
host and its parent domain vouch for each other).  Personalised PageRank spreads
trust along the links from hosts with allowed pages; distrust spreads against
the links from hosts with blocked pages (who links to a bad host is suspect).
A host is blocked where distrust outweighs trust.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from giftlens.llm.common import ascii_lower, cut, read

# Fixed rules of the contract: (verdict, host, path).
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))


@dataclass(frozen=True)
class LinkParams:
    """``damping``: share of a score passed on; ``steps``: iterations (0.85^20
    leaves 4 % of the mass unspread); ``tree_weight``: weight of a tie to the
    parent domain against one hyperlink; ``threshold``: share of trust in
    trust + distrust under which a host is blocked; ``min_score``: scores below
    it are no evidence."""

    damping: float = 0.85
    steps: int = 20
    tree_weight: float = 1.0
    threshold: float = 0.5
    min_score: float = 1e-9


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): the host after the first ``://`` up to ``/``, ``?``, ``#``
    or the end, A-Z lower-cased; the path then up to ``?``, ``#`` or the end;
    both empty without ``://``."""
    u = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, nulls without one."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):   # the longest last
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule = F.when(fits, h + p).otherwise(rule)
        verdict = F.when(fits, v).otherwise(verdict)
    return rule, verdict


def judged_pages(pages: DataFrame, rules=RULES) -> DataFrame:
    host, path = split_url(F.col("url"))
    d = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return d.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("ruled"))


def host_links(pages: DataFrame, tree_weight: float) -> DataFrame:
    """(src, dst, weight): hyperlinks between different hosts, counted, and ties
    between a host and its parent domain.  Links without a host of their own
    (relative ones) stay on their host and carry nothing."""
    host, _ = split_url(F.col("url"))
    hrefs = F.regexp_extract_all(F.coalesce(F.col("html").cast("string"), F.lit("")),
                                 F.lit(r"""(?i)href\s*=\s*["']?((?:[a-z][a-z0-9+.-]*:)?//[^\s"'>]+)"""), F.lit(1))
    href = F.col("href")
    to, _ = split_url(F.when(F.startswith(href, F.lit("//")), F.concat(F.lit("x:"), href)).otherwise(href))
    links = (pages.select(host.alias("src"), F.explode(hrefs).alias("href")).select("src", to.alias("dst"))
             .where("src != '' and dst != '' and src != dst").groupBy("src", "dst")
             .agg(F.count(F.lit(1)).cast("double").alias("weight")))
    hosts = pages.select(host.alias("src")).where("src != ''").distinct()
    # www.a.com -> a.com, but not a.com -> com
    parent = F.regexp_extract("src", r"^[^.]+\.([^.]+\..+)$", 1)
    up = hosts.select("src", parent.alias("dst")).where("dst != ''").withColumn("weight", F.lit(float(tree_weight)))
    down = up.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    return links.union(up).union(down).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def propagate(links: DataFrame, seeds: DataFrame, p: LinkParams = LinkParams()) -> DataFrame:
    """(host, trust, distrust) from ``seeds`` (host, trust, distrust in [0, 1]).

    trust(h) = (1-d) seed(h) + d * sum of trust(g) w(g,h)/out(g) over links g->h;
    distrust likewise over the reversed links.  Each step is one join and one
    aggregation of the host table against pre-aggregated links; the lineage is
    cut every five steps.  A host without links keeps what reaches it."""
    w = links.select("src", "dst", "weight")
    out = w.groupBy("src").agg(F.sum("weight").alias("all"))
    into = w.groupBy("dst").agg(F.sum("weight").alias("all"))
    none = F.lit(0.0)
    fwd = w.join(out, "src").select(F.col("src").alias("host"), F.col("dst").alias("to"),
                                    (F.col("weight") / F.col("all")).alias("wt"), none.alias("wd"))
    rev = w.join(into, "dst").select(F.col("dst").alias("host"), F.col("src").alias("to"),
                                     none.alias("wt"), (F.col("weight") / F.col("all")).alias("wd"))
    arcs = cut(fwd.union(rev).groupBy("host", "to").agg(F.sum("wt").alias("wt"), F.sum("wd").alias("wd")))
    base = cut(seeds.select("host", ((1 - p.damping) * F.col("trust")).alias("trust"),
                            ((1 - p.damping) * F.col("distrust")).alias("distrust")))
    score = base
    for step in range(1, p.steps + 1):
        moved = score.join(arcs, "host").select(
            F.col("to").alias("host"), (p.damping * F.col("trust") * F.col("wt")).alias("trust"),
            (p.damping * F.col("distrust") * F.col("wd")).alias("distrust"))
        score = base.union(moved).groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust"))
        if step % 5 == 0 or step == p.steps:
            score = cut(score)
    return score


def filter_pages(pages: DataFrame, rules=RULES, p: LinkParams = LinkParams()) -> DataFrame:
    """``(page_id, host, path, rule, verdict, trust, distrust)``, a row per page.

    The rule's verdict, else the host's: ``block`` if trust / (trust + distrust)
    is under the threshold, ``allow`` otherwise, also where no evidence reaches
    the host or there is none (null urls).  A seed's strength is the share of
    its host's pages that rules allow or block.  Repeated pages count each; a
    null ``html`` has no links.  An empty table gives an empty result."""
    judged = judged_pages(pages, rules)
    seeds = (judged.where("host != ''").groupBy("host").agg(
        F.avg(F.when(F.col("ruled") == "allow", 1.0).otherwise(0.0)).alias("trust"),
        F.avg(F.when(F.col("ruled") == "block", 1.0).otherwise(0.0)).alias("distrust")))
    score = propagate(host_links(pages, p.tree_weight), seeds, p)
    score = score.select("host", F.round("trust", 9).alias("trust"), F.round("distrust", 9).alias("distrust"))
    both = judged.join(score, "host", "left").withColumn("trust", F.coalesce("trust", F.lit(0.0))).withColumn(
        "distrust", F.coalesce("distrust", F.lit(0.0)))
    all_ = F.col("trust") + F.col("distrust")
    bad = (all_ >= p.min_score) & (F.col("trust") < p.threshold * all_)
    return both.select("page_id", "host", "path", "rule",
                       F.coalesce("ruled", F.when(bad, "block").otherwise("allow")).alias("verdict"),
                       "trust", "distrust")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_pages(read(spark, sf_dir, "pages"))
