from datetime import datetime, timedelta

import pytest
from helpers import T0, events, logins_at, raw, tickets_at
from pyspark.sql import functions as F

from accountwatch import RiskConfig
from accountwatch.config import DEFAULT, LOW_CSAT, Band
from accountwatch.operators import detect

MINUTE = timedelta(minutes=1)
START = datetime(2024, 1, 1)


def starts(df):
    return sorted(r["window_start"] for r in df.select("window_start").collect())


def test_loop_inside_minute(spark):
    e = events(spark, tickets_at(5, 6, 7, 8))
    assert [r["priority_score"] for r in detect.ticket_alerts(e).collect()] == [100000.0] * 4
    loops = detect.friction_loops(e)
    assert starts(loops) == [START - MINUTE, START]
    assert {r["incident_count"] for r in loops.collect()} == {4}
    assert loops.columns == [
        "account_id", "category", "mrr", "incident_count", "event_summary", "window_start", "window_end"
    ]


def test_loop_across_minute(spark):
    loops = detect.friction_loops(events(spark, tickets_at(58, 59, 60, 61)))
    assert [(r["window_start"], r["incident_count"]) for r in loops.collect()] == [(START, 4)]


@pytest.mark.parametrize(
    "rows, alerts",
    [
        (tickets_at(5, 6, 7, 8, mrr=5000.0), 0),
        (tickets_at(5, 6), 2),
        (tickets_at(5, 6) + tickets_at(7, 8, category="UI Bug"), 4),
    ],
)
def test_no_loop(spark, rows, alerts):
    e = events(spark, rows)
    assert detect.ticket_alerts(e).count() == alerts
    assert detect.friction_loops(e).count() == 0


def test_summary_is_the_earliest_or_latest_text(spark):
    rows = [{"timestamp": T0 + s, "event_body": f"at {s}"} for s in (9, 7, 8)]
    e = events(spark, rows)
    assert {r["event_summary"] for r in detect.friction_loops(e).collect()} == {"at 7"}
    assert {r["event_summary"] for r in detect.friction_loops(e, summary="last").collect()} == {"at 9"}


def test_ties_in_time_fall_to_the_lower_id(spark):
    e = events(spark, [{"event_body": b} for b in ("first", "second", "third")])
    assert {r["event_summary"] for r in detect.friction_loops(e).collect()} == {"first"}


def test_dead_end_login(spark):
    e = events(spark, logins_at(5, 6, 7, 8, 9, 10))
    assert detect.ticket_alerts(e).count() == 0
    churn = detect.silent_churners(e).collect()
    assert [(r["login_count"], r["feature_count"]) for r in churn] == [(6, 0)] * 2


@pytest.mark.parametrize(
    "more, windows",
    [
        (tickets_at(30, event_type="feature_access"), 0),
        (tickets_at(30, 31, 32, event_type="dashboard_view"), 2),
        (tickets_at(30, event_type=None), 2),
    ],
)
def test_what_counts_as_feature_use(spark, more, windows):
    e = events(spark, logins_at(5, 6, 7, 8, 9) + more)
    assert detect.silent_churners(e).count() == windows


def test_groups_without_a_login_survive_a_zero_bound(spark):
    e = events(spark, tickets_at(5, event_type="dashboard_view"))
    assert detect.silent_churners(e, RiskConfig(min_logins=0)).count() == 2


def test_a_change_of_revenue_splits_the_window(spark):
    e = events(spark, logins_at(5, 6, 7, mrr=10000.0) + logins_at(8, 9, 10, mrr=25000.0))
    assert detect.silent_churners(e).count() == 0


@pytest.mark.parametrize(
    "fields, alerted",
    [
        (dict(mrr=10000.0, csat_score=3), True),
        (dict(mrr=9999.99, csat_score=3), False),
        (dict(mrr=10000.0, csat_score=4), False),
        (dict(mrr=None), False),
        (dict(csat_score=None), False),
        (dict(event_type=None), False),
        (dict(event_type="login"), False),
        (dict(timestamp=None), True),
    ],
)
def test_ticket_boundaries(spark, fields, alerted):
    assert (detect.ticket_alerts(events(spark, [fields])).count() == 1) is alerted


def test_score_of_every_event(spark):
    rows = [dict(csat_score=6), dict(csat_score=None), dict(mrr=None), dict(mrr=100.0, csat_score=5)]
    scores = detect.priority_score(raw(spark, rows)).orderBy("event_id").collect()
    assert [r["priority_score"] for r in scores] == [-25000.0, None, None, 0.0]


def test_loose_screen_takes_any_event_type(spark):
    rows = [dict(mrr=1000.0, event_type="login", csat_score=3), dict(mrr=999.0), dict(csat_score=4)]
    assert [r["event_id"] for r in detect.low_csat_risk(raw(spark, rows), LOW_CSAT).collect()] == ["e-000"]


def test_event_time_keeps_the_repeated_hour(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        e = events(spark, [dict(timestamp=1730613600)])
        assert e.select(F.unix_seconds("event_timestamp")).first()[0] == 1730613600
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_tumbling_windows_partition_the_events(spark):
    cfg = RiskConfig(min_incidents=1, min_mrr=0.0).tumbling()
    e = events(spark, tickets_at(*range(0, 600, 7)))
    assert detect.friction_loops(e, cfg).agg(F.sum("incident_count")).first()[0] == e.count()


def test_ranking(spark):
    rows = [dict(csat_score=c) for c in (3, 1, 2, 1)]
    ranked = detect.priority_ranking(detect.ticket_alerts(raw(spark, rows)))
    assert [r["event_id"] for r in ranked.collect()] == ["e-001", "e-003", "e-002", "e-000"]
    assert detect.priority_ranking(detect.ticket_alerts(raw(spark, rows)), 1).count() == 1


def test_empty_input(spark):
    e = events(spark, [])
    for found in (detect.ticket_alerts(e), detect.friction_loops(e), detect.silent_churners(e)):
        assert found.count() == 0


def test_summary_of_ties_and_missing_values(spark):
    """Equal times go by event id; a missing category or text is a value like any other."""
    rows = tickets_at(5, 5, 6, 7, category=None)
    rows = [{**row, "event_id": f"e-{9 - i}", "event_body": None if i == 1 else f"text {i}"} for i, row in enumerate(rows)]
    frame = events(spark, rows)
    for summary, body in (("first", None), ("last", "text 3")):
        fetched = detect.friction_loops(frame, DEFAULT, summary)
        carried = detect.enough_incidents(detect.ticket_counts(frame, DEFAULT, summary), DEFAULT)
        assert sorted(map(repr, fetched.collect())) == sorted(map(repr, carried.select(*fetched.columns).collect()))
        assert {r.event_summary for r in fetched.collect()} == {body} and fetched.count() == 2


def test_windows_by_band(spark):
    """Each band by itself and all together give the same loops; a revenue on a bound is in the upper band."""
    rows = [row for mrr in (10000.0, 14999.0, 15000.0, 30000.0, 9000.0) for row in tickets_at(0, 50, 70, 110, 170, mrr=mrr)]
    frame = events(spark, rows)
    bands = (Band(15000.0, "1 minute", "30 seconds"), Band(10000.0, "3 minutes"))
    got = detect.friction_loops_by_band(frame, bands).collect()
    alone = [
        detect.friction_loops(frame.filter("mrr >= 15000"), RiskConfig(window_width="1 minute", window_slide="30 seconds")),
        detect.friction_loops(frame.filter("mrr < 15000"), RiskConfig(window_width="3 minutes", window_slide=None)),
    ]
    assert sorted(map(repr, got)) == sorted(map(repr, alone[0].union(alone[1]).collect())) and len({r.mrr for r in got}) >= 2
