"""Row order of the reports (the oracle comparison ignores it)."""

import pytest

from giftlens.plans import catalog

from conftest import SMALL


def rows(spark, key):
    return [r.asDict() for r in catalog.queries()[key](spark, SMALL).collect()]


@pytest.mark.parametrize("key, order", [
    ("trend_year", lambda r: -r["Year"]),
    ("trend_year_major", lambda r: -r["Year"]),
    ("dist_gender", lambda r: (-r["total_amount"], -r["donation_count"], r["Gender"])),
    ("fund_performance", lambda r: (-r["total_amount"], -r["donation_count"], r["Fund"])),
    ("lapsed_targets", lambda r: (-r["Monetary"], r["ID"])),
    ("rfm_segment_distribution", lambda r: (-r["count"], r["RFM_Segment"])),
    ("relationship_summary", lambda r: -(8 * r["CurrentParent"] + 4 * r["PastParent"]
                                         + 2 * r["PastStudent"] + r["FutureParent"])),
])
def test_report_order(spark, key, order):
    got = rows(spark, key)
    assert got and got == sorted(got, key=order)


def test_months_newest_first(spark):
    months = [r["Month"] for r in rows(spark, "trend_month")]
    assert len(months) > 1 and months == sorted(months, reverse=True)
