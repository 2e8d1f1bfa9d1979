"""The registered queries: one per operator of the inventory.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole tables of ``sf_dir`` (through the gift-shaped fixture views).
Parameters that differ from the reference defaults are the ones the
fixture data needs (its amounts are far above the reference's dollar
thresholds) and are stated once, here.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from giftlens.config import AnalysisParams, ColumnMap, ModelParams
from giftlens.functions.expr import ntz_lit
from giftlens.session import stable as _stable
from pyspark.sql import functions as F

from giftlens.operators import (cleaning, donors, metrics, models, panel, playbook, quality,
                                 reports, rfm, splits)
from giftlens.sources import fixtures

C = ColumnMap()
# Fixture parameters (FIXTURES.md): amounts are in the hundreds of
# thousands, dates span 1995-2001.
MAJOR = 450_000.0
YEAR_CUTOFF = 1996
FIXTURE_PARAMS = AnalysisParams(
    major_gift_threshold=MAJOR, year_cutoff=YEAR_CUTOFF,
    min_panel_start=_dt.datetime(1996, 1, 1))

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        _REGISTRY[name] = fn
        return fn
    return deco


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


GIFT_CORE = ("ReceiptSeq", "ID", "Date", "Amount")


def clean_gifts(spark: SparkSession, sf_dir: str, columns=None) -> DataFrame:
    """Gifts after stage-2 preprocessing (all years), optionally only the
    named input columns (reads and joins nothing else)."""
    return cleaning.preprocess(fixtures.gifts(spark, sf_dir, columns), C)


def core_gifts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_gifts(spark, sf_dir, GIFT_CORE)


def typed_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.type_conversions(fixtures.dirty_gifts(spark, sf_dir), C)


# -- reports -----------------------------------------------------------------

@register("trend_year")
def q_trend_year(spark, sf_dir):
    return reports.trend_year(core_gifts(spark, sf_dir), C)


@register("trend_year_major")
def q_trend_year_major(spark, sf_dir):
    return reports.trend_year_major(core_gifts(spark, sf_dir), MAJOR, C)


@register("trend_month")
def q_trend_month(spark, sf_dir):
    return reports.trend_month(core_gifts(spark, sf_dir), C)


def _dist(col):
    def q(spark, sf_dir):
        # Donor attributes live in their own table: aggregate gifts per donor
        # first, then join one row per donor (same result as grouping the
        # wide extract).
        attrs = cleaning.normalize_categoricals(fixtures.donor_attributes(spark, sf_dir), C)
        return reports.attribute_distribution(core_gifts(spark, sf_dir), attrs, col, 50, C)
    return q


for _key, _col in (("dist_gender", C.gender), ("dist_occupation", C.occupation_desc),
                   ("dist_religion", C.religion), ("dist_suburb", C.suburb)):
    register(_key)(_dist(_col))


def _aged(gifts):
    """Fixture ages from the donor's key: 20 to 69 in the first year of the
    data, none for every ninth donor."""
    k = F.col("ID").cast("long")

    def decade(age):
        low = (age - age % 10).cast("long")
        return F.when(k % 9 > 0, F.concat(low.cast("string"), F.lit("-"), (low + 9).cast("string")))

    return gifts.withColumns({"AgeGroup": decade(k % 50 + 20),
                              "AgeGroupAtDonation": decade(k % 50 + 20 + F.col("Year") - 1995)})


@register("dist_agegroup")
def q_dist_agegroup(spark, sf_dir):
    return reports.distribution(_aged(core_gifts(spark, sf_dir)), "AgeGroup", 50, C)


@register("relationship_agegroup")
def q_relationship_agegroup(spark, sf_dir):
    gifts = clean_gifts(spark, sf_dir, GIFT_CORE + tuple(C.relationship))
    return reports.relationship_by_group(_aged(gifts), "AgeGroupAtDonation", C)


@register("appeal_performance")
def q_appeal_performance(spark, sf_dir):
    return reports.appeal_performance(clean_gifts(spark, sf_dir, GIFT_CORE + ("Appeal",)), C)


@register("fund_performance")
def q_fund_performance(spark, sf_dir):
    return reports.fund_performance(clean_gifts(spark, sf_dir, GIFT_CORE + ("Fund",)), C)


CATEGORY_COLUMNS = ("Gender", "OccupDesc", "ReligionCode", "Suburb", "Appeal", "Fund")


@register("category_reports")
def q_category_reports(spark, sf_dir):
    """All category reports from one scan of the gifts."""
    gifts = clean_gifts(spark, sf_dir, GIFT_CORE + CATEGORY_COLUMNS)
    return reports.category_reports(gifts, list(CATEGORY_COLUMNS), {c: 3 for c in CATEGORY_COLUMNS[:4]}, C)


@register("flag_key")
def q_flag_key(spark, sf_dir):
    return reports.with_flag_key(cleaning.map_flags(fixtures.donor_attributes(spark, sf_dir), C), C).select("ID", "RelationshipKey")


@register("relationship_summary")
def q_relationship_summary(spark, sf_dir):
    attrs = cleaning.map_flags(fixtures.donor_attributes(spark, sf_dir), C)
    return reports.attribute_relationship_summary(core_gifts(spark, sf_dir), attrs, C)


@register("relationship_trend")
def q_relationship_trend(spark, sf_dir):
    attrs = cleaning.map_flags(fixtures.donor_attributes(spark, sf_dir), C)
    return reports.attribute_relationship_trend(core_gifts(spark, sf_dir), attrs, C)


# -- cleaning and quality ----------------------------------------------------

@register("clean_null_tokens")
def q_clean_null_tokens(spark, sf_dir):
    return cleaning.null_tokens(fixtures.dirty_gifts(spark, sf_dir))


@register("clean_amount_cast")
def q_clean_amount_cast(spark, sf_dir):
    d = cleaning.coerce_amount(cleaning.null_tokens(fixtures.dirty_gifts(spark, sf_dir)), C)
    return d.select("ReceiptSeq", "Amount")


@register("clean_id")
def q_clean_id(spark, sf_dir):
    d = cleaning.normalize_id(cleaning.null_tokens(fixtures.dirty_gifts(spark, sf_dir)), C)
    return d.select("ReceiptSeq", "ID")


@register("clean_dates")
def q_clean_dates(spark, sf_dir):
    d = cleaning.parse_dates(cleaning.null_tokens(fixtures.dirty_gifts(spark, sf_dir)), C)
    return d.select("ReceiptSeq", "Date")


@register("date_parse_loss")
def q_date_parse_loss(spark, sf_dir):
    return cleaning.date_parse_loss(cleaning.null_tokens(fixtures.dirty_gifts(spark, sf_dir)), C)


@register("temporal_features")
def q_temporal_features(spark, sf_dir):
    return cleaning.add_temporal(fixtures.gifts(spark, sf_dir), C).select(
        "ReceiptSeq", "Year", "MonthPeriod", "Month")


@register("normalize_categoricals")
def q_normalize_categoricals(spark, sf_dir):
    g = cleaning.normalize_categoricals(fixtures.gifts(spark, sf_dir), C)
    return g.select("ReceiptSeq", *[c for c in C.categoricals if c in g.columns])


@register("flag_mapping")
def q_flag_mapping(spark, sf_dir):
    return cleaning.map_flags(typed_dirty(spark, sf_dir), C).select("ReceiptSeq", "CurrentParent")


@register("positive_amounts")
def q_positive_amounts(spark, sf_dir):
    return cleaning.positive_amounts(typed_dirty(spark, sf_dir), C).select("ReceiptSeq", "ID", "Amount")


@register("flag_anomalies")
def q_flag_anomalies(spark, sf_dir):
    return cleaning.flag_anomalies(typed_dirty(spark, sf_dir), C)


@register("year_slice")
def q_year_slice(spark, sf_dir):
    return cleaning.year_slice(core_gifts(spark, sf_dir), YEAR_CUTOFF).select(
        "ReceiptSeq", "ID", "Year", "Amount")


@register("preprocess_stats")
def q_preprocess_stats(spark, sf_dir):
    return cleaning.preprocess_stats(typed_dirty(spark, sf_dir), C)


@register("dedup_exact")
def q_dedup_exact(spark, sf_dir):
    return cleaning.dedup_exact(typed_dirty(spark, sf_dir).drop("ReceiptSeq"))


@register("quality_amount")
def q_quality_amount(spark, sf_dir):
    return quality.quality_amount(typed_dirty(spark, sf_dir), C)


@register("quality_dates")
def q_quality_dates(spark, sf_dir):
    return quality.quality_dates(typed_dirty(spark, sf_dir), C)


@register("quality_flags")
def q_quality_flags(spark, sf_dir):
    return quality.quality_flags(cleaning.null_tokens(fixtures.dirty_gifts(spark, sf_dir)), C)


# -- RFM and donor lists -----------------------------------------------------

def _rfm(spark, sf_dir):
    return rfm.rfm_table(core_gifts(spark, sf_dir), C, FIXTURE_PARAMS)


@register("rfm_table")
def q_rfm_table(spark, sf_dir):
    return _rfm(spark, sf_dir)


@register("rfm_by_donor_buckets")
def q_rfm_by_donor_buckets(spark, sf_dir):
    """The RFM table from a cleaned table that is bucketed by donor."""
    import uuid

    from giftlens.plans.outputs import write_cleaned_by_donor
    from giftlens.session import scratch_path
    gifts = write_cleaned_by_donor(core_gifts(spark, sf_dir), f"cleaned_{uuid.uuid4().hex}", scratch_path(spark, "by-donor"), 8, C)
    return rfm.rfm_table(gifts, C, FIXTURE_PARAMS)


@register("rfm_scores")
def q_rfm_scores(spark, sf_dir):
    return _rfm(spark, sf_dir).select("ID", "R_score", "F_score", "M_score", "RFM_Score")


@register("rfm_segment_distribution")
def q_rfm_segment_distribution(spark, sf_dir):
    return rfm.segment_distribution(_rfm(spark, sf_dir))


@register("rfm_timed")
def q_rfm_timed(spark, sf_dir):
    params = FIXTURE_PARAMS.with_(rfm_reference=_dt.datetime(2024, 2, 1, 6, 0, 0))
    return rfm.rfm_table(fixtures.timed_gifts(spark, sf_dir), C, params)


@register("lapsed_targets")
def q_lapsed_targets(spark, sf_dir):
    return rfm.lapsed_targets(_rfm(spark, sf_dir), 730, 1_000_000.0, C)


def _summary(spark, sf_dir):
    return donors.donor_summary(core_gifts(spark, sf_dir), C)


@register("donor_summary")
def q_donor_summary(spark, sf_dir):
    return _summary(spark, sf_dir)


@register("lapsed_12m")
def q_lapsed_12m(spark, sf_dir):
    return donors.lapsed_12m(_summary(spark, sf_dir), 365, 1_000_000.0, C)


@register("high_potential_sleeper")
def q_high_potential_sleeper(spark, sf_dir):
    return donors.high_potential_sleeper(_summary(spark, sf_dir), 365, 2_000_000.0, C)


@register("upgrade_candidates")
def q_upgrade_candidates(spark, sf_dir):
    return donors.upgrade_candidates(_summary(spark, sf_dir), FIXTURE_PARAMS, C)


@register("new_donors_90d")
def q_new_donors_90d(spark, sf_dir):
    return donors.new_donors(_summary(spark, sf_dir), FIXTURE_PARAMS.new_donor_days, C)


@register("donor_spine")
def q_donor_spine(spark, sf_dir):
    return donors.donor_spine(core_gifts(spark, sf_dir), C)


# -- panels --------------------------------------------------------------------

PANEL_INPUT = GIFT_CORE + tuple(C.demographics)


def panel_gifts(spark, sf_dir, extra=()):
    """The wide gift rows with every demographic (reference shape)."""
    return clean_gifts(spark, sf_dir, PANEL_INPUT + tuple(extra))


def receipt_gifts(spark, sf_dir, extra=()):
    """Receipt-level columns only (no joins); Education varies per gift."""
    return clean_gifts(spark, sf_dir, GIFT_CORE + ("Education",) + tuple(extra))


def donor_table(spark, sf_dir):
    """Cleaned donor attributes, one row per donor."""
    a = fixtures.donor_attributes(spark, sf_dir)
    return cleaning.normalize_categoricals(cleaning.map_flags(a, C), C).drop("Suburb", "FutureParent")


@register("panel_cutoffs")
def q_panel_cutoffs(spark, sf_dir):
    return panel.panel_cutoffs(core_gifts(spark, sf_dir), "redonate", C, FIXTURE_PARAMS)


@register("donor_demographics")
def q_donor_demographics(spark, sf_dir):
    return panel.donor_demographics(panel_gifts(spark, sf_dir), C)


@register("donor_features_asof")
def q_donor_features_asof(spark, sf_dir):
    g = receipt_gifts(spark, sf_dir)
    return panel.donor_features_asof(g, ntz_lit(_dt.datetime(1999, 6, 30)), C,
                                     attributes=donor_table(spark, sf_dir))


@register("panel_redonate")
def q_panel_redonate(spark, sf_dir):
    return panel.build_panel(receipt_gifts(spark, sf_dir), "redonate", C, FIXTURE_PARAMS,
                             attributes=donor_table(spark, sf_dir))


@register("asof_features")
def q_asof_features(spark, sf_dir):
    return q_panel_redonate(spark, sf_dir).drop("ReDonate")


GIVEN_CUTOFFS = [_dt.datetime(1999, 3, 7, 12), _dt.datetime(1996, 12, 31), _dt.datetime(1998, 1, 1), _dt.datetime(1996, 12, 31),
                 _dt.datetime(2000, 6, 30), _dt.datetime(1994, 1, 1), _dt.datetime(2001, 8, 1)]


@register("panel_given_cutoffs")
def q_panel_given_cutoffs(spark, sf_dir):
    return panel.build_panel(receipt_gifts(spark, sf_dir), "redonate", C, FIXTURE_PARAMS,
                             attributes=donor_table(spark, sf_dir), cutoffs=GIVEN_CUTOFFS)


@register("panel_major")
def q_panel_major(spark, sf_dir):
    return panel.build_panel(receipt_gifts(spark, sf_dir), "major", C, FIXTURE_PARAMS,
                             attributes=donor_table(spark, sf_dir))


@register("panel_time")
def q_panel_time(spark, sf_dir):
    return panel.build_panel(receipt_gifts(spark, sf_dir), "time", C, FIXTURE_PARAMS,
                             attributes=donor_table(spark, sf_dir))


@register("panel_preference")
def q_panel_preference(spark, sf_dir):
    return panel.build_panel(receipt_gifts(spark, sf_dir, ("Fund",)), "preference", C, FIXTURE_PARAMS,
                             attributes=donor_table(spark, sf_dir))


@register("amount_dataset")
def q_amount_dataset(spark, sf_dir):
    return panel.amount_dataset(receipt_gifts(spark, sf_dir), C, FIXTURE_PARAMS,
                                attributes=donor_table(spark, sf_dir))


@register("panel_summary")
def q_panel_summary(spark, sf_dir):
    parts = [panel.panel_summary(q_panel_redonate(spark, sf_dir), "ReDonate", "redonate"),
             panel.panel_summary(q_panel_major(spark, sf_dir), "MajorGift", "major"),
             panel.panel_summary(q_panel_time(spark, sf_dir), "DaysToNext", "time"),
             panel.panel_summary(q_panel_preference(spark, sf_dir), "TargetCategory", "preference")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# -- splits, weights, metrics on given tables --------------------------------------

@register("split_time")
def q_split_time(spark, sf_dir):
    # The split point is a quantile over the panel: checkpoint the panel so
    # the quantile subquery and the output read it instead of rebuilding it.
    p = _stable(q_panel_time(spark, sf_dir))
    return splits.time_split(p).select("ID", "CutoffDate", "split")


@register("split_random")
def q_split_random(spark, sf_dir):
    a = _stable(q_amount_dataset(spark, sf_dir).select("ID"))
    return splits.random_split(a, 0.25, 42, key_cols=["ID"])


@register("split_random_stratified")
def q_split_random_stratified(spark, sf_dir):
    a = _stable(q_amount_dataset(spark, sf_dir).select("ID", "Gender"))
    return splits.random_split(a, 0.25, 42, key_cols=["ID"], stratify_col="Gender")


@register("class_weights")
def q_class_weights(spark, sf_dir):
    return splits.class_weights(q_panel_preference(spark, sf_dir), "TargetCategory")


@register("classification_metrics")
def q_classification_metrics(spark, sf_dir):
    return metrics.classification_metrics(fixtures.predictions(spark, sf_dir), model="given")


@register("multiclass_metrics")
def q_multiclass_metrics(spark, sf_dir):
    return metrics.multiclass_metrics(fixtures.class_pairs(spark, sf_dir), model="given", target="flag")


@register("regression_metrics")
def q_regression_metrics(spark, sf_dir):
    return metrics.regression_metrics(fixtures.regression_pairs(spark, sf_dir))


@register("residual_quantiles")
def q_residual_quantiles(spark, sf_dir):
    return metrics.residual_quantiles(fixtures.day_residual_pairs(spark, sf_dir))


# -- scoring on given per-donor scores ------------------------------------------------

def given_scores(spark, sf_dir):
    """Per-donor scores derived from the gifts (stand-ins for model
    outputs): amount, days to next gift (null for one-gift donors), top-1
    probability."""
    from giftlens.functions.agg import money_avg
    from giftlens.functions.expr import elapsed_days
    g = core_gifts(spark, sf_dir)
    t = g.groupBy("ID").agg(money_avg(F.col("Amount")).alias("avg_amt"), F.count(F.lit(1)).alias("n"),
                            F.min("Date").alias("mn"), F.max("Date").alias("mx"))
    return t.select(
        "ID", (F.col("avg_amt") / 250.0).alias("pred_amount"),
        F.when(F.col("n") > 1, elapsed_days(F.col("mn"), F.col("mx")).cast("double")
               / (F.col("n") - 1).cast("double")).alias("pred_days_to_next"),
        ((F.col("ID").cast("long") * 37) % 101).cast("double").__truediv__(F.lit(100.0)).alias("top1_prob"))


@register("priority_score")
def q_priority_score(spark, sf_dir):
    return playbook.priority_score(given_scores(spark, sf_dir)).select("ID", "priority_score")


@register("action_bucket")
def q_action_bucket(spark, sf_dir):
    return playbook.priority_score(given_scores(spark, sf_dir)).select("ID", "action_bucket")


FUND_CLASSES = [f"F{i}" for i in range(6)]


@register("top3_preference")
def q_top3_preference(spark, sf_dir):
    g = clean_gifts(spark, sf_dir, GIFT_CORE + ("Fund",))
    counts = g.groupBy("ID").pivot("Fund", FUND_CLASSES).agg(F.count(F.lit(1)))
    tot = sum(F.coalesce(F.col(c), F.lit(0)) for c in FUND_CLASSES)
    probs = counts.select("ID", F.array(*[F.coalesce(F.col(c), F.lit(0)).cast("double") / tot
                                          for c in FUND_CLASSES]).alias("prob"))
    return playbook.top_k_classes(probs, "prob", FUND_CLASSES, "fund", 3).drop("prob")


@register("next_date_bands")
def q_next_date_bands(spark, sf_dir):
    g = core_gifts(spark, sf_dir)
    res = metrics.residual_quantiles(fixtures.day_residual_pairs(spark, sf_dir))
    cut = g.agg(F.max("Date")).scalar()
    s = given_scores(spark, sf_dir).select("ID", "pred_days_to_next")
    return playbook.next_date_bands(s, cut, res)


# -- fitted models (rows-only checks) -------------------------------------------------

# The registered model queries fit the ensembles a user gets by default.
MODELS = ModelParams()


@register("feature_matrix")
def q_feature_matrix(spark, sf_dir):
    return models.feature_matrix(q_panel_redonate(spark, sf_dir), C)


def _panel(p: DataFrame) -> DataFrame:
    """A panel kept for fitting.  Its rows come from few donors' rows each, expanded
    after the shuffle, so partitions are evened out before they are written."""
    return _stable(p.hint("rebalance"))


def _propensity(spark, sf_dir, label, algorithms):
    p = q_panel_redonate(spark, sf_dir) if label == "ReDonate" else q_panel_major(spark, sf_dir)
    return models.train_propensity(_panel(p), label, C, FIXTURE_PARAMS, MODELS, algorithms)


@register("propensity_lr")
def q_propensity_lr(spark, sf_dir):
    return _propensity(spark, sf_dir, "ReDonate", ("LogisticRegression",)).comparison


@register("propensity_rf")
def q_propensity_rf(spark, sf_dir):
    return _propensity(spark, sf_dir, "ReDonate", ("RandomForest",)).comparison


@register("propensity_gbt")
def q_propensity_gbt(spark, sf_dir):
    return _propensity(spark, sf_dir, "ReDonate", ("GBT",)).comparison


@register("propensity_model_comparison")
def q_propensity_model_comparison(spark, sf_dir):
    return _propensity(spark, sf_dir, "ReDonate", ("LogisticRegression", "RandomForest", "GBT")).comparison


@register("major_gift_model_comparison")
def q_major_gift_model_comparison(spark, sf_dir):
    return _propensity(spark, sf_dir, "MajorGift", ("LogisticRegression", "RandomForest", "GBT")).comparison


@register("field_importance")
def q_field_importance(spark, sf_dir):
    return _propensity(spark, sf_dir, "ReDonate", ("RandomForest",)).importance["RandomForest"]


def _amount(spark, sf_dir):
    return models.train_amount(_stable(q_amount_dataset(spark, sf_dir)), C, FIXTURE_PARAMS, MODELS)


def _time(spark, sf_dir):
    return models.train_time(_panel(q_panel_time(spark, sf_dir)), C, FIXTURE_PARAMS, MODELS)


def _preference(spark, sf_dir):
    return models.train_preference(_panel(q_panel_preference(spark, sf_dir)), "fund", C,
                                   FIXTURE_PARAMS, MODELS)


@register("amount_model")
def q_amount_model(spark, sf_dir):
    return _amount(spark, sf_dir).metrics


@register("time_model")
def q_time_model(spark, sf_dir):
    return _time(spark, sf_dir).metrics


@register("preference_model")
def q_preference_model(spark, sf_dir):
    return _preference(spark, sf_dir).metrics


@register("playbook")
def q_playbook(spark, sf_dir):
    return playbook.assemble_playbook(panel_gifts(spark, sf_dir, ("Fund",)), _amount(spark, sf_dir),
                                      _time(spark, sf_dir), _preference(spark, sf_dir), C)


# -- sources and sinks ---------------------------------------------------------------

@register("ingest_csv")
def q_ingest_csv(spark, sf_dir):
    """Land the raw receipts as CSV in the shared folder and scan them
    back as strings."""
    from giftlens.session import scratch_path
    from giftlens.sources.readers import read_gifts_csv, write_gifts_csv
    path = scratch_path(spark, "ingest-csv")
    write_gifts_csv(fixtures.dirty_gifts(spark, sf_dir), path)
    return read_gifts_csv(spark, path)


@register("extract_wide")
def q_extract_wide(spark, sf_dir):
    return fixtures.wide_extract(spark, sf_dir).drop("AppealKey", "FundKey")


@register("metrics_flatten")
def q_metrics_flatten(spark, sf_dir):
    from giftlens.plans.outputs import flatten_metrics, write_metrics
    from giftlens.session import scratch_path
    base = scratch_path(spark, "metrics")
    write_metrics({"classification": q_classification_metrics(spark, sf_dir),
                   "multiclass": q_multiclass_metrics(spark, sf_dir),
                   "regression": q_regression_metrics(spark, sf_dir)}, base)
    return flatten_metrics(spark, base)


MANIFEST_REPORTS = ("trend_year", "trend_year_major", "trend_month", "dist_gender", "dist_suburb",
                    "appeal_performance", "fund_performance", "relationship_summary", "rfm_table",
                    "lapsed_targets", "lapsed_12m", "upgrade_candidates", "new_donors_90d")


@register("report_manifest")
def q_report_manifest(spark, sf_dir):
    from giftlens.plans.outputs import report_manifest
    qs = queries()
    return report_manifest({k: qs[k](spark, sf_dir) for k in MANIFEST_REPORTS})


@register("stream_trend_month")
def q_stream_trend_month(spark, sf_dir):
    """The monthly trend of gifts landed in eight files, three to a batch; donors are
    a sketch, held against the exact count."""
    from giftlens.session import scratch_path
    from giftlens.streaming import trends
    base = scratch_path(spark, "stream-trend")
    gifts = core_gifts(spark, sf_dir)
    gifts.repartition(8, "ReceiptSeq").write.parquet(f"{base}/landing")
    stream = spark.readStream.schema(gifts.schema).option("maxFilesPerTrigger", 3).parquet(f"{base}/landing")
    trends.run_month_trend(stream, f"{base}/months", f"{base}/checkpoint", "4000 days", C)
    exact = reports.trend_month(gifts, C).select("Month", "donors")
    t = trends.read_month_trend(spark, f"{base}/months").join(exact, "Month")
    near = F.abs(F.col("donors_estimate") - F.col("donors")) <= 4 * trends.standard_error() * F.col("donors")
    return t.select("Month", "total_amount", "donation_count", "avg_amount_per_donation", near.alias("donors_within_four_errors"))


@register("stream_ingest")
def q_stream_ingest(spark, sf_dir):
    """Streaming ingest of landed raw receipts into the cleaned table."""
    from giftlens.session import scratch_path
    from giftlens.sources.readers import write_gifts_csv
    from giftlens.streaming.ingest import run_ingest
    base = scratch_path(spark, "stream-ingest")
    raw = fixtures.dirty_gifts(spark, sf_dir)
    write_gifts_csv(raw, f"{base}/landing")
    run_ingest(spark, f"{base}/landing", f"{base}/cleaned", f"{base}/_checkpoint", raw.columns, C)
    return spark.read.parquet(f"{base}/cleaned").select(
        "ReceiptSeq", "ID", "Date", "Amount", "CurrentParent", "Gender", "Year", "Month")


@register("quality_report")
def q_quality_report(spark, sf_dir):
    return quality.quality_report(typed_dirty(spark, sf_dir), C)
