"""Queries against DuckDB on the smallest supplied scale.

By default a sample that covers each area; ``ORACLE_ALL=1`` runs every query.
"""

import os

import pytest

import check
from brightledger.plans import load

SF = "/root/testdata/sf0.001"
SAMPLE = ["landing_page", "classify_channel", "popup_exposure", "minipage_events", "event_impact_hourly", "click_to_order", "click_to_order_same_day",
          "hourly_activity", "delivery_date_from_name", "email_status_asof", "subscriber_creation", "reset_cohort", "cart_segments", "budget_periods",
          "partner_sales", "spend_union", "ads_final_reload", "search_page_report", "alert_repeat_orders", "product_feed", "order_revenue"]

duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


def names():
    return sorted(load()[0]) if os.environ.get("ORACLE_ALL") else SAMPLE


@pytest.fixture(scope="module")
def con():
    return check.duck(SF)


@pytest.mark.parametrize("name", names())
def test_matches_duckdb(spark, con, name):
    queries, sqls = load()
    assert check.compare(spark, con, SF, name, queries[name], sqls[name]) is None


def test_every_query_has_an_oracle():
    queries, sqls = load()
    assert set(queries) == set(sqls)
