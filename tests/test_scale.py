"""Plans that must hold on far larger data: push-down, map-side reduction, hot accounts."""

import re

import pytest
from pyspark.sql import functions as F

from accountwatch import LOOPS, TICKETS
from accountwatch.catalog import canonical as data
from accountwatch.catalog.queries import QUERIES
from accountwatch.operators import detect, figures, keep

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(detect.ticket_alerts(data.account_events(spark, SF_DIR), data.CFG).select("event_id"))
    assert "EqualTo(event_type,error)" in text
    assert "GreaterThanOrEqual(c_acctbal,5000.0)" in text
    assert "value:double" not in text and "c_name" not in text


@pytest.mark.parametrize("name", ["latest_tickets", "draft_queue_tickets", "one_row_per_account", "apply_drafts"])
def test_keep_first_reduces_before_the_shuffle(spark, no_broadcast, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    partial = [i for i, line in enumerate(text.splitlines()) if "WindowGroupLimit" in line and "Partial" in line]
    final = [i for i, line in enumerate(text.splitlines()) if "WindowGroupLimit" in line and "Final" in line]
    assert len(partial) == len(final) > 0


@pytest.mark.parametrize("name", ["friction_loops", "silent_churners", "lane_kpis", "exposure_by_account"])
def test_aggregates_combine_before_the_shuffle(spark, no_broadcast, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "partial_" in text


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairwise_products(spark, no_broadcast, name):
    if re.search("_stream$|_slices$|_late_|^routed_", name):
        return
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    assert "BatchEvalPython" not in text


def test_a_hot_account_is_split(spark, tmp_path, no_broadcast):
    """A third of all events on one account: adaptive execution splits its join partition."""
    n = 60_000
    rows = spark.range(n, numPartitions=12).select(
        F.col("id").alias("event_id"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id")).cast("timestamp_ntz").alias("ts"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 500).cast("long").alias("user_id"),
        F.lit("error").alias("event_type"),
        F.lit(1.0).alias("value"),
        F.format_string('{"k": %d}', F.col("id") % 100).alias("props"),
    )
    rows.write.parquet(f"{tmp_path}/events.parquet")
    spark.range(500).select(
        F.col("id").alias("c_custkey"),
        F.lit("n").alias("c_name"),
        F.lit(1).alias("c_nationkey"),
        F.lit(9000.0).alias("c_acctbal"),
        F.lit("s").alias("c_mktsegment"),
    ).write.parquet(f"{tmp_path}/customer.parquet")
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.files.maxPartitionBytes": "50KB",
    }
    before = {k: spark.conf.get(k) for k in small}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        for frame in (
            keep.latest(data.tickets(spark, str(tmp_path)), TICKETS),
            detect.friction_loops(data.account_events(spark, str(tmp_path)), data.CFG),
        ):
            frame.collect()
            text = plan(frame)
            assert re.search(r"SortMergeJoin\(skew=true\)", text), text
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_hot_account_results_are_whole(spark):
    """Every row of a hot key counts, none is sampled away."""
    n = 30_000
    rows = spark.range(n, numPartitions=8).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("a"), (F.col("id") % 1000).cast("string"))).alias("account_id"),
        F.lit("c").alias("category"),
        F.lit(20000.0).alias("mrr"),
        F.col("id").alias("timestamp"),
        F.lit(None).cast("string").alias("ai_draft"),
        F.lit(False).alias("is_approved"),
        F.lit("support_ticket").alias("event_type"),
        F.lit(1).alias("csat_score"),
        F.lit("t").alias("event_body"),
    )
    newest = keep.latest(rows, TICKETS).filter("account_id = 'hot'").first()
    assert newest["event_id"] == n - n % 3 - 3
    assert figures.alert_counts(rows).filter("account_id = 'hot'").first()["alerts"] == n // 3
    loops = detect.ticket_counts(detect.with_event_time(rows))
    assert loops.agg(F.sum("incident_count")).first()[0] == 2 * n
    assert LOOPS.count in loops.columns


@pytest.mark.parametrize("name", ["friction_loops", "friction_loops_last_report", "friction_loops_tumbling"])
def test_texts_are_fetched_after_the_count(spark, no_broadcast, name):
    """Raw rows are counted by hash without their texts; only what is left of them is sorted."""
    frame = QUERIES[name](spark, SF_DIR)
    lines = plan(frame).splitlines()
    aggregates = [line for line in lines if "Aggregate" in line]
    texts = [line for line in aggregates if "event_body" in line]
    assert sum("HashAggregate" in line and "count(1)" in line for line in aggregates) == 2
    assert texts and not any("count(1)" in line for line in texts)
    counted = next(i for i, line in enumerate(lines) if "HashAggregate" in line and "partial_count" in line)
    scan = next(line for line in lines[counted:] if "FileScan" in line and "event_type" in line)
    assert all("SortAggregate" not in line or i < counted for i, line in enumerate(lines)) and scan


def test_the_overview_reads_each_lane_once(spark):
    """As many scans as the three lanes have, and none of them for the figures themselves."""
    lanes = data.views(spark, SF_DIR)

    def scans(df):
        return plan(df).count("FileScan")

    accounts = figures.account_overview(*lanes)
    assert scans(accounts) == sum(map(scans, lanes))


def test_categories_do_not_meet_in_one_task(spark):
    text = plan(figures.exposure_by_category(data.tickets(spark, SF_DIR)))
    assert "Window" not in text and "NestedLoopJoin" not in text


def test_a_lane_and_its_log_meet_as_they_lie(spark, no_broadcast):
    text = plan(QUERIES["lane_state_by_key"](spark, SF_DIR))
    assert "SortMergeJoin" in text and "Exchange" not in text
    assert text.count("Bucketed: true") == 2
