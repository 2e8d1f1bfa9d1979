"""Benchmark: time the headline queries at one scale factor.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs once to warm up, then once timed, executed in full with
the ``noop`` sink (no driver collection).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from giftlens.plans import catalog  # noqa: E402
from giftlens.session import build_session  # noqa: E402

HEADLINE = (
    "trend_year", "trend_month", "dist_gender", "appeal_performance", "relationship_summary",
    "flag_anomalies", "preprocess_stats", "rfm_table", "donor_summary", "upgrade_candidates",
    "panel_redonate", "panel_major", "panel_time", "panel_preference", "amount_dataset",
    "split_time", "classification_metrics", "top3_preference", "priority_score", "propensity_lr",
)


def naive_panel(spark, sf_dir):
    """The reference's algorithm shape, for comparison only, with all columns of
    ``panel_redonate``: every gift range-joined to every later cutoff and regrouped
    per cutoff, labels by a second range join, demographics by donor."""
    from giftlens.functions.agg import last_by, money_sum
    from giftlens.functions.expr import add_days, elapsed_days
    from giftlens.operators import panel
    g = catalog.receipt_gifts(spark, sf_dir)
    cuts = F.broadcast(panel.panel_cutoffs(catalog.core_gifts(spark, sf_dir), "redonate", catalog.C,
                                           catalog.FIXTURE_PARAMS).select("CutoffDate"))
    past = g.join(cuts, g.Date <= cuts.CutoffDate).groupBy("ID", "CutoffDate").agg(
        F.count(F.lit(1)).alias("Frequency"), money_sum(F.col("Amount")).alias("Monetary"),
        F.max("Date").alias("last"), last_by(F.col("Amount"), F.col("Date"), F.col("ReceiptSeq")).alias("LastAmount"))
    ahead = g.join(cuts, (g.Date > cuts.CutoffDate) & (g.Date <= add_days(cuts.CutoffDate, 365)))
    ahead = ahead.select("ID", "CutoffDate", F.lit(1).alias("ReDonate")).distinct()
    out = past.withColumns({"Recency": elapsed_days(F.col("last"), F.col("CutoffDate")),
                            "AvgAmount": F.col("Monetary") / F.col("Frequency")}).drop("last")
    out = out.join(ahead, ["ID", "CutoffDate"], "left").fillna(0, subset=["ReDonate"])
    demo = panel.donor_demographics(g.select("ID", "Date", "ReceiptSeq", "Education"), catalog.C)
    return out.join(demo, "ID", "left").join(catalog.donor_table(spark, sf_dir), "ID", "left")


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    qs = catalog.queries()
    todo = [(k, qs[k]) for k in HEADLINE if k in qs] + [("panel_redonate_naive", naive_panel)]
    times = {}
    for name, fn in todo:
        run(fn(spark, sf_dir))               # warm-up
        t0 = time.perf_counter()
        run(fn(spark, sf_dir))
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    total = round(sum(v for k, v in times.items() if k != "panel_redonate_naive"), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
