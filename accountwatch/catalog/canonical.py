"""The given tables seen as account events, lanes, changes, vectors and policies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accountwatch.config import Band, RiskConfig
from accountwatch.functions.text import contact_address
from accountwatch.lanes import CHURN, LOOPS, TICKETS, Lane
from accountwatch.operators import detect
from accountwatch.operators.keep import keep_first, latest

# Balances end near 10,000 and events are sparse, so bounds are lower and windows wider.
# The event names are the ones the given table uses; its other types count as neither.
CFG = RiskConfig(
    min_mrr=5000.0,
    min_incidents=3,
    min_logins=2,
    ticket_type="error",
    login_type="view",
    feature_type="purchase",
    window_width="4 days",
    window_slide="2 days",
)

# Shorter windows for accounts of more revenue.
BANDS = (Band(5000.0, "8 days", "4 days"), Band(7000.0, "4 days", "2 days"), Band(9000.0, "2 days"))

# Declared, so that building a query starts no job to infer them.
_SCHEMAS = {
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _as_account_events(events: DataFrame, customers: DataFrame) -> DataFrame:
    # k in a step of its own is parsed once per row. Account ids are text, as on the
    # event topic; so later steps do not reuse the partitions of this join, and adaptive
    # execution is free to split the partition of an account with very many events.
    events = events.selectExpr("*", "cast(get_json_object(props, '$.k') as int) as k")
    return events.join(customers.withColumnRenamed("c_custkey", "user_id"), "user_id").selectExpr(
        "event_id",
        "cast(user_id as string) as account_id",
        "c_name as account_name",
        "c_acctbal as mrr",
        "event_type",
        "k % 2 as category",
        "props as event_body",
        "k % 5 + 1 as csat_score",
        "unix_seconds(cast(ts as timestamp)) as timestamp",
        "ts as event_timestamp",
    )


def account_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_account_events(table(spark, sf_dir, "events"), table(spark, sf_dir, "customer"))


def account_events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events file as a stream. Event time is an instant here, as watermarks require."""
    # A file source wants a folder or a pattern; this one fits a single file and a folder of parts.
    return streamed_events(spark, sf_dir, f"{sf_dir}/events.parque[t]")


def streamed_events(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    events = spark.readStream.schema(_SCHEMAS["events"]).parquet(path)
    return _as_account_events(events, table(spark, sf_dir, "customer")).withColumn(
        "event_timestamp", F.col("event_timestamp").cast("timestamp")
    )


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as messages on a topic; every eleventh is not JSON."""
    events = account_events(spark, sf_dir).withColumn("email", contact_address("account_name"))
    return events.selectExpr(
        """cast(if(event_id % 11 = 0, concat('{broken ', event_id), to_json(struct(
             cast(event_id as string) as event_id, account_id as user_id, account_name as account_id, email, mrr,
             event_type, cast(category as string) as category, event_body, csat_score, timestamp,
             'NONE' as alert_trigger))) as binary) as value"""
    )


def topic_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as messages of a topic of three partitions, every eleventh not JSON, with offsets and event time."""
    events = account_events(spark, sf_dir).withColumn("email", contact_address("account_name"))
    return events.selectExpr(
        """cast(if(event_id % 11 = 0, concat('{broken ', event_id), to_json(struct(
             cast(event_id as string) as event_id, account_id as user_id, account_id, email, mrr, event_type,
             cast(category as string) as category, event_body, csat_score, timestamp))) as binary) as value""",
        "'events' as topic",
        "cast(event_id % 3 as int) as partition",
        "event_id div 3 as offset",
    )


#: The columns of a topic that the routed stream reads.
TOPIC = "value binary, topic string, partition int, offset long"


def ticket_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect.ticket_alerts(account_events(spark, sf_dir), CFG).select(
        "event_id", "account_id", "mrr", "category", "event_body", "csat_score", "timestamp", "event_timestamp", "priority_score"
    )


def tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticket_rows(spark, sf_dir).selectExpr(
        "* except (event_timestamp)",
        "case when event_id % 3 = 0 then null when event_id % 7 = 0 then '' else 'draft' end as ai_draft",
        "event_id % 5 = 0 as is_approved",
    )


def loops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect.friction_loops(account_events(spark, sf_dir), CFG).selectExpr(
        "*", "if(cast(account_id as long) % 3 = 0, null, 'draft') as ai_draft", "cast(account_id as long) % 5 = 0 as is_approved"
    )


def churn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect.silent_churners(account_events(spark, sf_dir), CFG).selectExpr(
        "*", "if(cast(account_id as long) % 4 = 0, null, 'draft') as ai_draft", "cast(account_id as long) % 7 = 0 as is_approved"
    )


def state(spark: SparkSession, sf_dir: str, lane: Lane) -> DataFrame:
    return {TICKETS.name: tickets, LOOPS.name: loops, CHURN.name: churn}[lane.name](spark, sf_dir)


def views(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(latest(state(spark, sf_dir, lane), lane) for lane in (TICKETS, LOOPS, CHURN))


def status_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older alert shape: a three-step status and recovery_draft."""
    return tickets(spark, sf_dir).selectExpr(
        "event_id",
        "account_id",
        "mrr",
        "timestamp",
        "event_body",
        "ai_draft as recovery_draft",
        "case when is_approved then 'sent' when ai_draft is not null then 'completed' else 'pending' end as status",
    )


def ticket_drafts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One draft for two thirds of the events and a second one for half of those."""
    events = table(spark, sf_dir, "events").filter("event_id % 3 <> 0")
    turns = events.selectExpr("event_id", "ts", "explode(if(event_id % 2 = 0, array(1, 2), array(1))) as n")
    return turns.selectExpr(
        "event_id",
        "if(event_id % 7 = 0, '', concat('draft ', n)) as draft",
        "cast(ts + make_dt_interval(0, n) as timestamp) as drafted_at",
    )


def ticket_approvals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").filter("event_id % 5 = 0").selectExpr(
        "event_id",
        "if(event_id % 10 <> 0, 'edited', null) as final_draft",
        "cast(ts + interval 1 day as timestamp) as approved_at",
    )


def loop_changes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Drafts (some empty, which this lane does not store) and approvals by window."""
    rows = detect.friction_loops(account_events(spark, sf_dir), CFG).select(*LOOPS.change_key)
    drafts = rows.filter("cast(account_id as long) % 3 <> 0").selectExpr(
        *LOOPS.change_key,
        "if(cast(account_id as long) % 7 = 0, '', 'draft') as draft",
        "cast(window_start as timestamp) as drafted_at",
    )
    approvals = rows.filter("cast(account_id as long) % 5 = 0").selectExpr(
        *LOOPS.change_key, "'edited' as final_draft", "cast(window_start as timestamp) as approved_at"
    )
    return drafts, approvals


def timed_loop_changes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A draft for every window, up to two hours after its start, and approvals one hour after it."""
    rows = detect.friction_loops(account_events(spark, sf_dir), CFG).select(*LOOPS.change_key)
    drafts = rows.selectExpr(
        *LOOPS.change_key,
        "'draft' as draft",
        "cast(window_start as timestamp) + make_dt_interval(0, cast(cast(account_id as long) % 3 as int)) as drafted_at",
    )
    approvals = rows.filter("cast(account_id as long) % 2 = 0").selectExpr(
        *LOOPS.change_key, "'edited' as final_draft", "cast(window_start as timestamp) + interval 1 hour as approved_at"
    )
    return drafts, approvals


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings")


def knowledge_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first vector of each label stands for the policy of that label."""
    first = keep_first(embeddings(spark, sf_dir), ["label"], [F.asc("vec_id")])
    return first.selectExpr(
        "vec_id as sop_id", "concat('label ', label) as category", "concat('Policy for label ', label) as content", "embedding"
    )


def ticket_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A complaint's vector is the one numbered like its account."""
    keys = ticket_rows(spark, sf_dir).select("event_id", "account_id")
    vectors = embeddings(spark, sf_dir).select("vec_id", "embedding")
    return keys.join(vectors, keys.account_id.cast("long") == vectors.vec_id).select("event_id", "embedding")
