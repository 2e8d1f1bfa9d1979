"""The whole batch job: load -> validate -> clean -> reports -> RFM and
lists -> models -> playbook -> outputs.

Mirrors the reference's six stages.  The cleaned slice is written once
(partitioned by Year) and read back, which both cuts lineage in the
shared folder and lets every report prune to the slice; reports are lazy
DataFrames written one by one, before any training; models train on
checkpointed panels.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from giftlens.config import InsufficientData, Settings
from giftlens.operators import cleaning, donors, models, panel, playbook, quality, reports, rfm
from giftlens.plans import outputs
from giftlens.session import stable
from giftlens.sources.readers import read_gifts_csv


@dataclass
class RunResult:
    reports: dict[str, DataFrame] = field(default_factory=dict)
    metrics: dict[str, DataFrame] = field(default_factory=dict)
    skipped: dict[str, str] = field(default_factory=dict)
    quality: DataFrame | None = None
    counts: dict[str, int] = field(default_factory=dict)


def build_reports(df: DataFrame, s: Settings) -> dict[str, DataFrame]:
    """Stage 3 and the lists of stage 5 as lazy DataFrames."""
    c, a = s.columns, s.analysis
    out: dict[str, DataFrame] = {"trend_year": reports.trend_year(df, c),
                                 "trend_month": reports.trend_month(df, c)}
    if df.filter(F.col(c.amount) >= a.major_gift_threshold).limit(1).count():
        out["trend_year_major"] = reports.trend_year_major(df, a.major_gift_threshold, c)
    named = ((c.gender, "dist_gender"), ("AgeGroup", "dist_agegroup"), (c.occupation_desc, "dist_occupation"),
             (c.religion, "dist_religion"), (c.suburb, "dist_suburb"), (c.appeal, "appeal_performance"), (c.fund, "fund_performance"))
    named = [(col, name) for col, name in named if col and col in df.columns]
    if named:
        # All category reports come from one scan.
        limits = {col: a.top_n_categories for col, _ in named if col not in (c.appeal, c.fund)}
        every = stable(reports.category_reports(df, [col for col, _ in named], limits, c))
        for col, name in named:
            one = every.filter(F.col("report") == col).drop("report").withColumnRenamed("category", col)
            out[name] = one.orderBy(F.col("total_amount").desc(), F.col("donation_count").desc(), F.col(col).asc())
    r = rfm.rfm_table(df, c, a)
    out["rfm_table"] = r
    out["lapsed_targets"] = rfm.lapsed_targets(r, a.lapsed_recency_days, a.lapsed_min_monetary, c)
    if any(f in df.columns for f in c.relationship):
        out["relationship_summary"] = reports.relationship_summary(df, c, a.exact_quantiles)
        out["relationship_trend"] = reports.relationship_trend(df, c)
        if "AgeGroupAtDonation" in df.columns:
            out["relationship_agegroup"] = reports.relationship_by_group(df, "AgeGroupAtDonation", c)
    summ = donors.donor_summary(df, c)
    out["lapsed_12m"] = donors.lapsed_12m(summ, a.lapsed12_recency_days, a.lapsed12_min_monetary, c)
    out["high_potential_sleeper"] = donors.high_potential_sleeper(
        summ, a.sleeper_recency_days, a.sleeper_min_monetary, c)
    out["upgrade_candidates"] = donors.upgrade_candidates(summ, a, c)
    out["new_donors_90d"] = donors.new_donors(summ, a.new_donor_days, c)
    return out


def train(df: DataFrame, out_dir: str, settings: Settings, res: RunResult) -> dict[str, DataFrame]:
    """Fit, save and evaluate the five model families and assemble the playbook.

    A family whose guard fails (too few rows, classes or days of gifts) is
    noted in ``res.skipped`` and the others go on.  Returns the reports."""
    c, a, mp = settings.columns, settings.analysis, settings.models
    out: dict[str, DataFrame] = {}
    trained = {}

    def panel_of(kind, **kw):
        panel.require_range(df, kind, c, a)
        return stable(panel.build_panel(df, kind, c, a, **kw))

    def preference():
        col = panel.preference_target(df, c)
        return models.train_preference(panel_of("preference", target_col=col),
                                       "fund" if col == c.fund else "appeal", c, a, mp)

    for kind, label, name in (("redonate", "ReDonate", "propensity"), ("major", "MajorGift", "major_gift")):
        try:
            t = models.train_propensity(panel_of(kind), label, c, a, mp)
        except InsufficientData as e:
            res.skipped[name] = str(e)
            continue
        out[f"{name}_model_comparison"] = t.comparison
        for algo, imp in t.importance.items():
            out[f"field_importance_{name}_{algo}"] = imp
        for algo, m in t.models.items():
            outputs.save_model(m, f"{out_dir}/models/{name}_{algo}")
            res.metrics[f"{name}_{algo}"] = t.metrics[algo]
    for name, fit in (("amount", lambda: models.train_amount(stable(panel.amount_dataset(df, c, a)), c, a, mp)),
                      ("time", lambda: models.train_time(panel_of("time"), c, a, mp)),
                      ("preference", preference)):
        try:
            trained[name] = fit()
        except InsufficientData as e:
            res.skipped[name] = str(e)
            continue
        if trained[name].metrics is not None:
            res.metrics[name] = trained[name].metrics
        outputs.save_model(trained[name].model, f"{out_dir}/models/{name}")
    out["prospecting_playbook"] = playbook.assemble_playbook(
        df, trained.get("amount"), trained.get("time"), trained.get("preference"), c)
    return out


def run(spark: SparkSession, raw: DataFrame, out_dir: str, settings: Settings = Settings(),
        train_models: bool = True, run_date: _dt.date | None = None) -> RunResult:
    """Run every stage on ``raw`` (typed gifts: see ``cleaning.type_conversions``).

    ``counts`` (C12) need no scan of their own: rows before come with the quality
    report, rows after from the footers of the written files."""
    started = _dt.datetime.now()
    c, a = settings.columns, settings.analysis
    res = RunResult()
    res.quality = quality.validate(raw, c)                       # stage 1b
    outputs.write_anomalies(cleaning.flag_anomalies(raw, c), f"{out_dir}/relationship_flag_anomalies")
    cleaned_path = f"{out_dir}/cleaned"
    outputs.write_cleaned(cleaning.preprocess(raw, c), cleaned_path)   # stage 2 (S5)
    res.counts = {"rows_before": int(res.quality.filter("check = 'rows'").first()["value"]),
                  "rows_after": spark.read.parquet(cleaned_path).count()}
    # Reading back cuts lineage and lets the Year filter prune partitions.
    df = spark.read.parquet(cleaned_path).filter(F.col("Year") >= a.year_cutoff)
    res.reports = build_reports(df, settings)                    # stage 3 + lists
    # Reports are written before any training, so a model that can't be trained costs none of them.
    written = outputs.write_reports(res.reports, f"{out_dir}/reports", run_date)

    if train_models:                                             # stages 4 and 5
        late = train(df, out_dir, settings, res)
        written |= outputs.write_reports(late, f"{out_dir}/reports", run_date)
        res.reports |= late
        if res.metrics:
            outputs.write_metrics(res.metrics, f"{out_dir}/metrics")
    done = {name: spark.read.parquet(path) for name, path in written.items()}
    outputs.report_manifest(done).write.mode("overwrite").parquet(f"{out_dir}/manifest")   # stage 6
    outputs.run_record(spark, started, _dt.datetime.now(), res.counts["rows_after"],
                       {"year_cutoff": a.year_cutoff, "major_gift_threshold": a.major_gift_threshold,
                        "window_days": a.redonate_window_days}) \
        .write.mode("append").parquet(f"{out_dir}/runs")
    return res


def run_files(spark: SparkSession, receipts: str, out_dir: str, settings: Settings = Settings(),
              train_models: bool = True, run_date: _dt.date | None = None,
              extra_formats: tuple[str, ...] = ()) -> RunResult:
    """From raw CSV receipts to all outputs: land them as they are (S4), type them
    (C1-C4), run every stage.  ``counts`` then also tells how many dates were lost."""
    c = settings.columns
    landing = f"{out_dir}/landing"
    outputs.write_landing(read_gifts_csv(spark, receipts), landing)
    landed = spark.read.parquet(landing)
    quality.require_columns(landed, c)
    res = run(spark, cleaning.type_conversions(landed, c, extra_formats=extra_formats), out_dir, settings, train_models, run_date)
    lost = cleaning.date_parse_loss(cleaning.null_tokens(landed), c, extra_formats).collect()   # a row for each date column
    res.counts |= {f"lost_{r['column']}": r["lost"] for r in lost}
    return res
