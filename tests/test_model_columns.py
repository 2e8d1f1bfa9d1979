"""What follows from fitted models by rule: feature slots, and every column of the playbook given its scores."""

import datetime as dt
from collections import Counter
from statistics import median

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from giftlens.config import ColumnMap, ModelParams
from giftlens.operators import metrics, models, panel, playbook
from giftlens.plans import catalog

C = ColumnMap()
FEW = ModelParams(time_rf_n_estimators=4, amount_rf_n_estimators=4, preference_n_estimators=4, rf_max_depth=4)


def test_feature_matrix_slots(spark):
    """Numbers with medians for nulls, then one slot for each label by falling count."""
    rows = [("a", 1.0, 5.0, "F", "X"), ("b", None, 7.0, "F", None), ("c", 3.0, 9.0, "M", "Y"), ("d", 9.0, None, None, "Y"), ("e", 4.0, 1.0, "F", "Y")]
    df = spark.createDataFrame(rows, "ID string, Recency double, Frequency double, Gender string, State string")
    got = {r.ID: list(r.features) for r in models.feature_matrix(df, C).collect()}
    fill = [median(r[i] for r in rows if r[i] is not None) for i in (1, 2)]
    labels = []
    for i in (3, 4):
        n = Counter(r[i] or "Missing" for r in rows)
        labels.append(sorted(n, key=lambda x: (-n[x], x)))
    for r in rows:
        want = [fill[i - 1] if r[i] is None else r[i] for i in (1, 2)]
        # The imputer's median is a value of the column (no mean of the middle two).
        assert [abs(a - b) <= 1.0 if r[i + 1] is None else a == b for i, (a, b) in enumerate(zip(got[r[0]], want))] == [True, True]
        for i, names in zip((3, 4), labels):
            want += [float((r[i] or "Missing") == x) for x in names]
        assert got[r[0]][2:] == want[2:]


def test_matrix_is_the_same_for_training_and_scoring(spark):
    df = spark.createDataFrame([("a", "12", 1, None)], "ID string, Recency string, CurrentParent int, Gender string")
    row = models.model_matrix(df, ["CurrentParent", "Gender"]).first()
    assert (row.Recency, row.CurrentParent, row.Gender) == (12.0, "1", "Missing")


def test_playbook_columns_follow_from_its_scores(spark):
    gifts = catalog.panel_gifts(spark, SMALL, ("Fund",))
    p = catalog.FIXTURE_PARAMS
    amount = models.train_amount(panel.amount_dataset(gifts, C, p), C, p, FEW)
    time = models.train_time(panel.build_panel(gifts, "time", C, p), C, p, FEW)
    pref = models.train_preference(panel.build_panel(gifts, "preference", C, p, target_col="Fund"), "fund", C, p, FEW)
    ordered = playbook.assemble_playbook(gifts, amount, time, pref, C).collect()
    donors = {r.ID for r in gifts.select("ID").distinct().collect()}
    assert len(ordered) == len(donors) == len({r.ID for r in ordered})
    assert [(-r.priority_score, r.ID) for r in ordered] == sorted((-r.priority_score, r.ID) for r in ordered)
    res = metrics.residual_quantiles(time.residuals).first()
    cut = gifts.agg(F.max("Date")).first()[0]
    amounts = [r.pred_amount or 0.0 for r in ordered]
    days = [r.pred_days_to_next for r in ordered if r.pred_days_to_next is not None]

    def scaled(x, lo, hi):
        return 0.5 if lo == hi else (x - lo) / (hi - lo)

    for r in ordered:
        d = r.pred_days_to_next
        want = (0.4 * scaled(r.pred_amount or 0.0, min(amounts), max(amounts))
                + 0.4 * (1 - scaled(max(days) if d is None else d, min(days), max(days))) + 0.2 * (r.top1_prob or 0.0))
        assert r.priority_score == pytest.approx(want, abs=1e-9)
        rule = (playbook.VIP if r.pred_amount >= 1000 and d <= 60 and r.top1_prob >= 0.7 else
                playbook.UPGRADE if r.pred_amount >= 500 and d <= 120 else playbook.REACTIVATE if d > 180 else playbook.NURTURE)
        assert r.action_bucket == rule
        for col, off in (("point", 0.0), ("p20", res.residual_p20), ("p50", res.residual_median), ("p80", res.residual_p80)):
            assert r[f"pred_date_{col}"] == (cut + dt.timedelta(microseconds=int((d + off) * 86_400_000_000))).date()
        probs = [r.top1_prob, r.top2_prob, r.top3_prob]
        assert probs == sorted(probs, reverse=True) and {r.top1_fund, r.top2_fund, r.top3_fund} <= set(pref.classes)
    # The scores are the models' own on the donors' features as of the last gift.
    feats = models.model_matrix(panel.donor_features_asof(gifts, F.lit(cut).cast("timestamp_ntz"), C), models.categorical_features(gifts, C), fill="")
    own = {r.ID: r.amt_prediction for r in amount.model.transform(feats).collect()}
    assert {r.ID: r.pred_amount for r in ordered} == pytest.approx(own)
