from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from test_state import CHURN_ROW, LOOP, TICKET

from accountwatch import lanes as all_lanes
from accountwatch.catalog import canonical as data
from accountwatch.operators import figures
from accountwatch.plans.overview import current_overview, refresh_overview, start_overview, stored_overview

SF_DIR = "/root/testdata/sf0.001"

T0 = datetime(2024, 1, 1)


@pytest.fixture
def lanes(spark):
    tickets = spark.createDataFrame(
        [
            ("e1", "x", "c", 100.0, 1, "text", False),
            ("e2", "y", "c", 50.0, 1, None, True),
            ("e3", "y", "d", 60.0, 2, "", True),
        ],
        TICKET,
    )
    loops = spark.createDataFrame(
        [("x", "c", 200.0, 3, T0, None, False), ("z", "c", 20.0, 3, T0, "text", True)], LOOP
    )
    churn = spark.createDataFrame(
        [("x", 300.0, 5, T0, None, False), ("w", 7.0, 5, T0, None, False), ("y", 55.0, 5, T0, None, False)], CHURN_ROW
    )
    return tickets, loops, churn


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_kpis(lanes):
    kpis = figures.lane_kpis(*lanes).first().asDict()
    assert kpis == {
        "total_risk_events": 8,
        "success_rate": pytest.approx(200 / 3),
        "revenue_actioned": 60.0,  # y once: the drafted ticket leads
        "revenue_at_risk": 100.0 + 55.0 + 7.0,  # x by its ticket, y by its churn row, w
    }


def test_kpis_of_nothing(spark, lanes):
    empty = [lane.limit(0) for lane in lanes]
    assert tuple(figures.lane_kpis(*empty).first()) == (0, 0.0, 0.0, 0.0)
    assert [r["number"] for r in figures.revenue_funnel(*empty).collect()] == [0.0, 0.0, 0.0]
    assert figures.risk_by_alert_type(*empty).count() == 0
    assert tuple(figures.draft_backlog(empty[0]).first()) == (0, 0, 0.0, 0.0)
    assert tuple(figures.lane_success(empty[0]).first()) == (0.0, 0.0)


def test_risk_by_type_counts_an_account_in_every_lane(lanes):
    got = dict(rows(figures.risk_by_alert_type(*lanes)))
    assert got == {"Ticket Recovery": 100.0, "Systemic Failure": 200.0, "Silent Churn Risk": 362.0}


def test_risk_by_type_shows_a_settled_lane_as_zero(lanes):
    tickets, loops, churn = lanes
    got = dict(rows(figures.risk_by_alert_type(tickets.filter("is_approved"), loops.limit(0), churn)))
    assert got == {"Ticket Recovery": 0.0, "Silent Churn Risk": 362.0}


def test_funnel(lanes):
    got = dict(figures.revenue_funnel(*lanes).collect())
    assert got == {
        "Total Revenue Risk Detected": 100.0 + 60.0 + 20.0 + 7.0,
        "AI Draft Generated": 100.0 + 20.0,
        "Revenue Actioned": 60.0 + 20.0,
    }


def test_unions(lanes):
    assert figures.all_lanes(*lanes).count() == 8
    assert rows(figures.pending_all_lanes(*lanes)) == [("w", 7.0), ("x", 100.0), ("x", 200.0), ("x", 300.0), ("y", 55.0)]
    assert [r["account_id"] for r in figures.top_exposed_accounts(*lanes, n=2).collect()] == ["x", "y"]
    assert rows(figures.actioned_accounts(*lanes).select("account_id", "mrr")) == [("y", 60.0), ("z", 20.0)]


def test_properties(lanes):
    funnel = [r["number"] for r in figures.revenue_funnel(*lanes).collect()]
    assert max(funnel) == funnel[0]
    by_type = sum(r["mrr"] for r in figures.risk_by_alert_type(*lanes).collect())
    assert figures.lane_kpis(*lanes).first()["revenue_at_risk"] <= by_type
    one = figures.one_row_per_account(*lanes)
    assert one.count() == one.select("account_id").distinct().count()


def test_single_lane_figures(lanes):
    tickets = lanes[0]
    assert rows(figures.alert_counts(tickets)) == [("x", False, 1), ("y", True, 2)]
    assert rows(figures.exposure_by(tickets, ["account_id", "is_approved"])) == [("x", False, 100.0), ("y", True, 110.0)]
    assert tuple(figures.draft_backlog(tickets).first()) == (3, 1, 100.0, 50.0)
    assert tuple(figures.lane_success(tickets).first()) == (pytest.approx(200 / 3), 60.0)


def test_categories_show_once_one_is_known(spark):
    some = spark.createDataFrame([(None, 1.0), ("a", 2.0), ("a", 3.0)], "category string, mrr double")
    assert {tuple(r) for r in figures.exposure_by_category(some).collect()} == {(None, 1.0), ("a", 5.0)}
    assert figures.exposure_by_category(some.filter("category is null")).count() == 0


def test_status_figures(spark):
    alerts = spark.createDataFrame(
        [(f"e{i}", "a", 10.0 * i, i, s, "d") for i, s in enumerate(["pending", "completed", "sent", "completed", "pending"])],
        "event_id string, account_id string, mrr double, timestamp long, status string, recovery_draft string",
    )
    assert tuple(figures.status_kpis(alerts).first()) == (5, 40.0, 2)
    assert [r["mrr"] for r in figures.recent_drafts(alerts, 1).collect()] == [30.0]


def test_mean_time_to_draft(spark):
    rows = [(T0, T0 + timedelta(seconds=30)), (T0, T0 + timedelta(seconds=90)), (T0, None)]
    df = spark.createDataFrame(rows, "event_timestamp timestamp, drafted_at timestamp")
    assert figures.mean_time_to_draft(df).first()[0] == 1.0
    assert figures.mean_time_to_draft(df.filter("drafted_at is null")).first()[0] == 0.0


def test_a_refresh_takes_an_account_out_and_leaves_other_buckets_alone(spark, tmp_path):
    """An account whose only alert is taken back no longer counts; files of untouched buckets stay."""
    path = str(tmp_path / "accounts")
    lanes = [data.state(spark, SF_DIR, lane) for lane in all_lanes.LANES]
    start_overview(*lanes, path, buckets=8)
    assert rows(current_overview(spark, path)) == rows(stored_overview(*lanes, str(tmp_path / "whole")))
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "accounts").glob("bucket=*/*.parquet")}
    gone = lanes[2].select("account_id").limit(1).first()[0]
    left = [lane.where(F.col("account_id") != gone) for lane in lanes]
    refresh_overview(*left, spark.createDataFrame([(gone,)], "account_id string"), path, buckets=8)
    assert rows(current_overview(spark, path)) == rows(stored_overview(*left, str(tmp_path / "again")))
    same = [p for p, at in before.items() if p.exists() and p.stat().st_mtime_ns == at]
    assert len({p.parent for p in same}) == len({p.parent for p in before}) - 1
