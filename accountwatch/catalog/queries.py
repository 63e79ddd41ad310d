"""One runnable query per operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accountwatch.catalog import canonical as data
from accountwatch.catalog.canonical import CFG
from accountwatch.config import LOW_CSAT
from accountwatch.functions.text import contact_address, strip_preamble
from accountwatch.functions.tiers import OFFER_TIERS, response_tier
from accountwatch.functions.vector import cosine_distance
from accountwatch.lanes import CHURN, LANES, LOOPS, TICKETS, Lane
from accountwatch.operators import briefs, detect, figures, keep, state
from accountwatch.operators.nearest import nearest_policy
from accountwatch.plans.drafting import draft_lane, draft_tickets, offer_briefs, ticket_briefs
from accountwatch.plans.drafting import screened_drafts as screen_and_draft
from accountwatch.plans.overview import current_overview, refresh_overview, start_overview, stored_overview
from accountwatch.session import shared_folder
from accountwatch.sources import events as event_source
from accountwatch.sources import lanes as lane_store
from accountwatch.sources import tables
from accountwatch.streaming import lanes as streaming
from accountwatch.streaming import late, router

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def _plain_times(df: DataFrame) -> DataFrame:
    """Instants as UTC timestamps without a zone, which every engine prints alike."""
    times = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times}) if times else df


# Sources and detection


@query
def parse_events(spark, sf_dir):
    return event_source.parse_events(data.raw_messages(spark, sf_dir))


@query
def rejected_events(spark, sf_dir):
    return event_source.rejected_events(data.raw_messages(spark, sf_dir))


@query
def contact_addresses(spark, sf_dir):
    return data.table(spark, sf_dir, "customer").select("c_custkey", contact_address("c_name").alias("email"))


@query
def event_times(spark, sf_dir):
    seconds = F.unix_seconds(F.col("ts").cast("timestamp")).alias("timestamp")
    events = data.table(spark, sf_dir, "events").select("event_id", seconds)
    return _plain_times(detect.with_event_time(events))


@query
def priority_score(spark, sf_dir):
    return detect.priority_score(data.account_events(spark, sf_dir), CFG).select("event_id", "account_id", "priority_score")


@query
def ticket_alerts(spark, sf_dir):
    return data.ticket_rows(spark, sf_dir)


@query
def low_csat_risk(spark, sf_dir):
    return detect.low_csat_risk(data.account_events(spark, sf_dir), LOW_CSAT).select(
        "event_id", "account_id", "mrr", "event_body", "csat_score"
    )


@query
def friction_loops(spark, sf_dir):
    return detect.friction_loops(data.account_events(spark, sf_dir), CFG)


@query
def friction_loops_last_report(spark, sf_dir):
    return detect.friction_loops(data.account_events(spark, sf_dir), CFG, summary="last")


@query
def friction_loops_tumbling(spark, sf_dir):
    return detect.friction_loops(data.account_events(spark, sf_dir), CFG.tumbling())


@query
def silent_churners(spark, sf_dir):
    return detect.silent_churners(data.account_events(spark, sf_dir), CFG)


@query
def priority_ranking(spark, sf_dir):
    return detect.priority_ranking(data.ticket_rows(spark, sf_dir), 100).select("event_id", "account_id", "priority_score")


# Queues and current views


@query
def draft_queue_tickets(spark, sf_dir):
    return keep.draft_queue(data.tickets(spark, sf_dir), TICKETS)


@query
def draft_queue_next(spark, sf_dir):
    return keep.draft_queue(data.tickets(spark, sf_dir), TICKETS, limit=1)


@query
def draft_queue_loops(spark, sf_dir):
    return keep.draft_queue(data.loops(spark, sf_dir), LOOPS)


@query
def draft_queue_churn(spark, sf_dir):
    return keep.draft_queue(data.churn(spark, sf_dir), CHURN)


@query
def latest_tickets(spark, sf_dir):
    return keep.latest(data.tickets(spark, sf_dir), TICKETS)


@query
def latest_loops(spark, sf_dir):
    return keep.latest(data.loops(spark, sf_dir), LOOPS)


@query
def latest_churn(spark, sf_dir):
    return keep.latest(data.churn(spark, sf_dir), CHURN)


@query
def approved_accounts(spark, sf_dir):
    return figures.report_columns(keep.approved_accounts(data.tickets(spark, sf_dir), TICKETS))


@query
def needs_draft(spark, sf_dir):
    return keep.needs_draft(data.tickets(spark, sf_dir), TICKETS).select("event_id", "account_id", "ai_draft")


@query
def ready_for_review(spark, sf_dir):
    return keep.ready_for_review(data.tickets(spark, sf_dir)).select("event_id", "account_id", "ai_draft")


@query
def ready_for_review_any_draft(spark, sf_dir):
    return keep.ready_for_review(data.tickets(spark, sf_dir), allow_empty=True).select("event_id", "account_id", "ai_draft")


@query
def pending_review(spark, sf_dir):
    return keep.pending(keep.latest(data.loops(spark, sf_dir), LOOPS))


@query
def pending_review_churn(spark, sf_dir):
    return keep.pending(keep.latest(data.churn(spark, sf_dir), CHURN))


# State


@query
def apply_drafts(spark, sf_dir):
    rows = data.ticket_rows(spark, sf_dir).select("event_id", "account_id", "mrr")
    return _plain_times(state.apply_drafts(rows, data.ticket_drafts(spark, sf_dir), TICKETS))


@query
def apply_approvals(spark, sf_dir):
    rows = data.tickets(spark, sf_dir).select("event_id", "account_id", "mrr", "ai_draft", "is_approved")
    return state.apply_approvals(rows, data.ticket_approvals(spark, sf_dir), TICKETS).drop("drafted_at")


@query
def lane_state(spark, sf_dir):
    rows = detect.friction_loops(data.account_events(spark, sf_dir), CFG)
    drafts, approvals = data.loop_changes(spark, sf_dir)
    return _plain_times(state.lane_state(rows, drafts, approvals, LOOPS))


@query
def lane_state_by_time(spark, sf_dir):
    """Drafts before, with and after the approval: the last text wins."""
    rows = detect.friction_loops(data.account_events(spark, sf_dir), CFG)
    drafts, approvals = data.timed_loop_changes(spark, sf_dir)
    return _plain_times(state.lane_state(rows, drafts, approvals, LOOPS))


def _by_key(spark: SparkSession, rows: DataFrame, log: DataFrame, buckets: int = 8) -> tuple[DataFrame, DataFrame]:
    root = shared_folder(spark, "by-key")
    name = root.rsplit("-", 1)[-1]
    return (
        tables.store_by_key(rows, LOOPS, f"loops_{name}", f"{root}/loops", buckets),
        tables.store_by_key(log, LOOPS, f"loops_log_{name}", f"{root}/log", buckets),
    )


@query
def lane_state_by_key(spark, sf_dir):
    """The lane and its log stored in matching buckets and joined as they lie."""
    rows = detect.friction_loops(data.account_events(spark, sf_dir), CFG)
    log = state.change_log(*data.timed_loop_changes(spark, sf_dir), LOOPS)
    return _plain_times(state.state_from_log(*_by_key(spark, rows, log), LOOPS))


@query
def alert_status(spark, sf_dir):
    return data.tickets(spark, sf_dir).select("event_id", state.alert_status().alias("status"))


@query
def drafted_rows(spark, sf_dir):
    return state.drafted_rows(data.status_alerts(spark, sf_dir))


@query
def mark_sent(spark, sf_dir):
    sent = state.mark_sent(data.status_alerts(spark, sf_dir), data.ticket_approvals(spark, sf_dir))
    return sent.select("event_id", "account_id", "status", "recovery_draft")


# Policies, tiers, briefs and drafts


def _rounded(ranked: DataFrame) -> DataFrame:
    return ranked.select("vec_id", "sop_id", F.round("distance", 5).alias("distance"), "rank", "policy")


@query
def nearest_policies(spark, sf_dir):
    asked = data.embeddings(spark, sf_dir).select("vec_id", "embedding")
    return _rounded(nearest_policy(asked, data.knowledge_base(spark, sf_dir)))


@query
def nearest_policies_topk(spark, sf_dir):
    asked = data.embeddings(spark, sf_dir).select("vec_id", "embedding")
    return _rounded(nearest_policy(asked, data.knowledge_base(spark, sf_dir), k=3))


@query
def nearest_policies_blocked(spark, sf_dir):
    """The form for a knowledge base beyond the size bound, forced by a bound of nothing."""
    asked = data.embeddings(spark, sf_dir).select("vec_id", "embedding")
    kb = data.knowledge_base(spark, sf_dir)
    return _rounded(nearest_policy(asked, kb, k=2, shipped_bytes=0, block_bytes=1 << 20))


@query
def nearest_policies_doubled(spark, sf_dir):
    """Every policy stored twice, complaints found beyond the size bound: still one row per complaint."""
    asked = data.embeddings(spark, sf_dir).select("vec_id", "embedding")
    kb = data.knowledge_base(spark, sf_dir)
    return _rounded(nearest_policy(asked, kb.union(kb), shipped_bytes=0, block_bytes=1 << 20))


@query
def nearest_policies_one_length(spark, sf_dir):
    """Policies with cut vectors stand beside the others and are set aside by a stated length."""
    asked = data.embeddings(spark, sf_dir).select("vec_id", "embedding")
    kb = data.knowledge_base(spark, sf_dir)
    dim = kb.select(F.size("embedding")).first()[0]
    cut = kb.withColumn("sop_id", -F.col("sop_id") - 1).withColumn("embedding", F.slice("embedding", 1, 3))
    return _rounded(nearest_policy(asked, kb.union(cut), dim=dim))


@query
def cosine_distances(spark, sf_dir):
    """Each vector against itself read backwards."""
    distance = cosine_distance("embedding", F.reverse("embedding"))
    return data.embeddings(spark, sf_dir).select("vec_id", F.round(distance, 5).alias("distance"))


@query
def response_tiers(spark, sf_dir):
    """Balances doubled, so that all three tiers occur; every third policy is missing."""
    alerts = data.account_events(spark, sf_dir).select(
        "event_id",
        (F.col("mrr") * 2).alias("mrr"),
        F.when(F.col("event_id") % 3 != 0, F.concat(F.lit("policy "), F.col("category").cast("string"))).alias("policy"),
    )
    return response_tier(alerts).select("event_id", "recovery_strategy")


@query
def response_tiers_variant(spark, sf_dir):
    alerts = data.account_events(spark, sf_dir).select("event_id", "mrr")
    return response_tier(alerts, OFFER_TIERS, policy=None).select("event_id", "recovery_strategy")


@query
def strip_preambles(spark, sf_dir):
    """Whole documents as drafts, every other one behind an introduction."""
    intro = F.concat(F.lit("Here is the email:\n\n \tHi Team "), F.col("doc_id").cast("string"), F.lit(",\n"))
    raw = F.when(F.col("doc_id") % 2 == 0, F.col("text")).otherwise(F.concat(intro, F.col("text")))
    return data.table(spark, sf_dir, "documents").select("doc_id", strip_preamble(raw).alias("draft"))


_SENDER = briefs.Sender("Ada", "Example Ltd")


@query
def ticket_brief(spark, sf_dir):
    rows = ticket_briefs(
        data.tickets(spark, sf_dir), data.ticket_vectors(spark, sf_dir), data.knowledge_base(spark, sf_dir), _SENDER
    )
    return rows.select("event_id", "brief")


@query
def loop_brief(spark, sf_dir):
    queue = keep.draft_queue(data.loops(spark, sf_dir), LOOPS)
    return briefs.draft_brief(queue, LOOPS, _SENDER).select("account_id", "category", "brief")


@query
def churn_brief(spark, sf_dir):
    queue = keep.draft_queue(data.churn(spark, sf_dir), CHURN)
    return briefs.draft_brief(queue, CHURN, _SENDER).select("account_id", "brief")


@query
def offer_brief(spark, sf_dir):
    return offer_briefs(data.ticket_rows(spark, sf_dir), _SENDER).select("event_id", "brief")


def _stand_in():
    """A writer for the queries: deterministic, chatty, and broken for some accounts.

    Nested, so that it travels to the tasks whole.
    """

    def make():
        def write(row):
            if int(row["account_id"]) % 13 == 0:
                raise ValueError(f"no answer for {row['account_id']}")
            return f"Here is the email:\n\nHi {row['account_id']} Team,\nWe are on it.\n"

        return write

    return make


def _silent_stand_in():
    """The same, but it gives nothing back for some other accounts."""
    make = _stand_in()

    def make_silent():
        write = make()
        return lambda row: None if int(row["account_id"]) % 11 == 0 else write(row)

    return make_silent


@query
def draft_with(spark, sf_dir):
    briefed = briefs.draft_brief(data.loops(spark, sf_dir), LOOPS, _SENDER)
    return briefs.draft_with(briefed, _stand_in(), LOOPS.change_key)


@query
def undrafted_after_failures(spark, sf_dir):
    """Rows still without a draft where the writer failed, gave nothing back or had no complaint."""
    rows = data.ticket_rows(spark, sf_dir).withColumn("event_body", F.when(F.col("event_id") % 17 != 0, F.col("event_body")))
    drafts = briefs.clean_drafts(briefs.draft_with(rows, _silent_stand_in(), TICKETS.change_key, "event_body", reads=["account_id"]))
    after = state.lane_state(rows, drafts, data.ticket_approvals(spark, sf_dir).limit(0), TICKETS)
    return keep.needs_draft(after, TICKETS).select("event_id", "account_id", "ai_draft")


@query
def screened_drafts(spark, sf_dir):
    screened = screen_and_draft(data.account_events(spark, sf_dir), _stand_in(), LOW_CSAT)
    return screened.select("event_id", "account_id", "draft", "error")


@query
def ticket_drafts(spark, sf_dir):
    drafts = draft_tickets(
        data.tickets(spark, sf_dir), data.ticket_vectors(spark, sf_dir), data.knowledge_base(spark, sf_dir), _stand_in()
    )
    return drafts.drop("drafted_at")


@query
def churn_drafts(spark, sf_dir):
    return draft_lane(data.churn(spark, sf_dir), CHURN, _stand_in()).drop("drafted_at")


# Figures


@query
def all_lanes(spark, sf_dir):
    return figures.all_lanes(*data.views(spark, sf_dir))


@query
def pending_all_lanes(spark, sf_dir):
    return figures.pending_all_lanes(*data.views(spark, sf_dir))


@query
def one_row_per_account(spark, sf_dir):
    return figures.one_row_per_account(*data.views(spark, sf_dir))


def _rounded_sums(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 2) for c in columns})


@query
def lane_kpis(spark, sf_dir):
    kpis = figures.lane_kpis(*data.views(spark, sf_dir))
    return _rounded_sums(kpis, "success_rate", "revenue_actioned", "revenue_at_risk")


@query
def risk_by_alert_type(spark, sf_dir):
    return _rounded_sums(figures.risk_by_alert_type(*data.views(spark, sf_dir)), "mrr")


@query
def revenue_funnel(spark, sf_dir):
    return _rounded_sums(figures.revenue_funnel(*data.views(spark, sf_dir)), "number")


@query
def top_exposed_accounts(spark, sf_dir):
    return figures.top_exposed_accounts(*data.views(spark, sf_dir))


@query
def alert_counts(spark, sf_dir):
    return figures.alert_counts(keep.latest(data.tickets(spark, sf_dir), TICKETS))


@query
def alert_counts_loops(spark, sf_dir):
    return figures.alert_counts(keep.latest(data.loops(spark, sf_dir), LOOPS))


@query
def alert_counts_churn(spark, sf_dir):
    return figures.alert_counts(keep.latest(data.churn(spark, sf_dir), CHURN))


@query
def draft_backlog(spark, sf_dir):
    backlog = figures.draft_backlog(data.tickets(spark, sf_dir))
    return _rounded_sums(backlog, "revenue_pending_review", "revenue_undrafted")


@query
def lane_success(spark, sf_dir):
    return _rounded_sums(figures.lane_success(data.tickets(spark, sf_dir)), "success_rate", "revenue_actioned")


@query
def exposure_by_account(spark, sf_dir):
    rows = data.tickets(spark, sf_dir)
    return _rounded_sums(figures.exposure_by(rows, ["account_id", "is_approved"]), "mrr")


@query
def exposure_by_status(spark, sf_dir):
    rows = data.status_alerts(spark, sf_dir)
    return _rounded_sums(figures.exposure_by(rows, ["account_id", "status"]), "mrr")


@query
def exposure_by_category(spark, sf_dir):
    return _rounded_sums(figures.exposure_by_category(data.tickets(spark, sf_dir)), "mrr")


@query
def overview(spark, sf_dir):
    """All numbers of the overview from one row per account."""
    lanes = [data.state(spark, sf_dir, lane) for lane in LANES]
    return _rounded_sums(stored_overview(*lanes, f"{shared_folder(spark, 'overview')}/accounts"), "number")


@query
def overview_refreshed(spark, sf_dir):
    """Alerts of three batches, and drafts and approvals that come in two turns, each followed by a refresh of what it touches."""
    path = f"{shared_folder(spark, 'overview')}/accounts"
    lanes = {lane: data.state(spark, sf_dir, lane) for lane in LANES}
    account = F.col("account_id").cast("long")

    def at(batches: int, turns: int) -> list[DataFrame]:
        """The lanes after some batches of alerts and turns of changes; an alert of a later turn is undrafted and not approved."""
        told = account % 2 < turns
        rows = {TICKETS: F.col("event_id") % 3 < batches, LOOPS: account % 3 < batches, CHURN: account % 3 < batches}
        return [
            lanes[lane].where(rows[lane]).withColumns({"ai_draft": F.when(told, F.col("ai_draft")), "is_approved": told & F.col("is_approved")})
            for lane in LANES
        ]

    start_overview(*at(1, 0), path, buckets=8)
    for batches, turns, touched in ((2, 0, None), (2, 1, account % 2 == 0), (3, 1, None), (3, 2, account % 2 == 1)):
        state_now = at(batches, turns)
        new = [rows.where(F.col("event_id") % 3 == batches - 1 if lane is TICKETS else account % 3 == batches - 1) for lane, rows in zip(LANES, state_now, strict=True)]
        parts = [rows.select("account_id") for rows in (new if touched is None else [r.where(touched) for r in state_now])]
        refresh_overview(*state_now, parts[0].union(parts[1]).union(parts[2]), path, buckets=8)
    return _rounded_sums(current_overview(spark, path), "number")


@query
def status_kpis(spark, sf_dir):
    return _rounded_sums(figures.status_kpis(data.status_alerts(spark, sf_dir)), "revenue_pending")


@query
def recent_drafts(spark, sf_dir):
    return figures.recent_drafts(data.status_alerts(spark, sf_dir))


@query
def mean_time_to_draft(spark, sf_dir):
    rows = data.ticket_rows(spark, sf_dir).withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
    drafted = state.apply_drafts(rows, data.ticket_drafts(spark, sf_dir), TICKETS)
    return figures.mean_time_to_draft(drafted).select(F.round("minutes", 4).alias("minutes"))


# Written and read back


@query
def lane_round_trip(spark, sf_dir):
    """A batch stored, delivered again and stored again, then read as the current lane."""
    root = shared_folder(spark, "lane")
    write = lane_store.parquet_sink(root, lane_store.new_run_id())(LOOPS)
    rows = detect.friction_loops(data.account_events(spark, sf_dir), CFG)
    for _ in range(2):
        write(rows, 0)
    return lane_store.read_lane(spark, root, LOOPS)


@query
def lane_compaction(spark, sf_dir):
    root = shared_folder(spark, "lane")
    write = lane_store.parquet_sink(root, lane_store.new_run_id())(TICKETS)
    for batch in range(2):
        write(data.ticket_rows(spark, sf_dir), batch)
    lane_store.compact_lane(spark, root, TICKETS, f"{root}/current")
    return spark.read.parquet(f"{root}/current").select("event_id", "account_id", "mrr", F.col("day").cast("string").alias("day"))


@query
def folded_lane(spark, sf_dir):
    """Counts that grow over four batches, folded after the second and the third, then read."""
    root = shared_folder(spark, "lane")
    write = lane_store.parquet_sink(root, lane_store.new_run_id())(LOOPS)
    events = data.account_events(spark, sf_dir)
    account = F.col("account_id").cast("long")
    write(detect.ticket_counts(events.where("event_id % 2 = 0"), CFG), 0)
    write(detect.ticket_counts(events.where(account % 2 == 0), CFG), 1)
    lane_store.fold_batches(spark, root, LOOPS)
    write(detect.ticket_counts(events, CFG), 2)
    lane_store.fold_batches(spark, root, LOOPS)
    write(detect.ticket_counts(events.where(account % 3 == 0), CFG), 3)
    return streaming.read_early_lane(spark, root, LOOPS, CFG)


@query
def knowledge_base(spark, sf_dir):
    path = f"{shared_folder(spark, 'kb')}/kb"
    tables.load_knowledge_base(data.knowledge_base(spark, sf_dir), path)
    kb = tables.read_knowledge_base(spark, path)
    return kb.select("sop_id", "category", "content", F.size("embedding").alias("dimensions"))


@query
def ticket_library(spark, sf_dir):
    """Documents as a library of sample tickets in JSON arrays of a hundred, one a file, read back."""
    path = f"{shared_folder(spark, 'library')}/library"
    entry = F.struct(F.col("lang").alias("category"), F.col("text").alias("support_text"), F.expr("cast(doc_id % 2 + 1 as int)").alias("suggested_csat"))
    arrays = data.table(spark, sf_dir, "documents").groupBy(F.expr("doc_id div 100")).agg(F.to_json(F.collect_list(entry)).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return tables.read_ticket_library(spark, path)


@query
def export_actioned(spark, sf_dir):
    path = f"{shared_folder(spark, 'report')}/actioned"
    columns = ["account_id", "mrr", "is_approved", "ai_draft", "status"]
    tables.export_actioned(figures.actioned_accounts(*data.views(spark, sf_dir)).select(*columns), path)
    # A null value other than '' keeps an empty draft ("" in the file) apart from none.
    report = spark.read.schema("account_id string, mrr double, is_approved boolean, ai_draft string, status string")
    return report.csv(path, header=True, nullValue="\\N")


# Streams: every event once, then stop. Append leaves out windows still open.


def _run_lane(spark: SparkSession, sf_dir: str, lane: Lane, mode: str) -> str:
    root = shared_folder(spark, "stream")
    sink = lane_store.parquet_sink(f"{root}/lanes", lane_store.new_run_id())
    events = data.account_events_stream(spark, sf_dir)
    started = streaming.start_lane(
        events, lane, sink, f"{root}/checkpoints", CFG, mode, trigger={"availableNow": True}
    )
    streaming.await_lanes({lane.name: started})
    return f"{root}/lanes"


@query
def ticket_alerts_stream(spark, sf_dir):
    rows = lane_store.read_lane(spark, _run_lane(spark, sf_dir, TICKETS, "append"), TICKETS)
    return rows.select("event_id", "account_id", "mrr", "category", "event_body", "csat_score", "timestamp", "priority_score")


@query
def friction_loops_stream(spark, sf_dir):
    return _plain_times(lane_store.read_lane(spark, _run_lane(spark, sf_dir, LOOPS, "append"), LOOPS))


@query
def silent_churners_stream(spark, sf_dir):
    return _plain_times(lane_store.read_lane(spark, _run_lane(spark, sf_dir, CHURN, "append"), CHURN))


@query
def friction_loops_early_stream(spark, sf_dir):
    return _plain_times(streaming.read_early_lane(spark, _run_lane(spark, sf_dir, LOOPS, "update"), LOOPS, CFG))


@query
def silent_churners_early_stream(spark, sf_dir):
    return _plain_times(streaming.read_early_lane(spark, _run_lane(spark, sf_dir, CHURN, "update"), CHURN, CFG))


@query
def lanes_stream(spark, sf_dir):
    """The three lanes started together."""
    root = shared_folder(spark, "stream")
    sink = lane_store.parquet_sink(f"{root}/lanes", lane_store.new_run_id())
    events = data.account_events_stream(spark, sf_dir)
    streaming.await_lanes(streaming.start_lanes(events, sink, f"{root}/checkpoints", CFG, trigger={"availableNow": True}))
    stored = [
        lane_store.read_lane(spark, f"{root}/lanes", lane).select(F.lit(lane.name).alias("lane"), "account_id", "mrr")
        for lane in LANES
    ]
    return stored[0].union(stored[1]).union(stored[2])


def _run_slices(spark: SparkSession, sf_dir: str, lane: Lane, mode: str, slices: list[int], of: int, watch: bool = False) -> str:
    """The events delivered slice by slice of their time span, one start of the stream (and of the watch for late events) for each."""
    root = shared_folder(spark, "stream")
    sink = lane_store.parquet_sink(f"{root}/lanes", lane_store.new_run_id())
    events = data.table(spark, sf_dir, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    first, last = events.agg(F.min(micros), F.max(micros)).first()
    bounds = [first + (last + 1 - first) * i // of for i in range(of + 1)]
    for i in slices:
        part = events.where((micros >= bounds[i]) & (micros < bounds[i + 1]))
        part.write.mode("append").parquet(f"{root}/events")
        started = streaming.start_lane(
            data.streamed_events(spark, sf_dir, f"{root}/events"), lane, sink, f"{root}/checkpoints", CFG, mode, trigger={"availableNow": True}
        )
        streaming.await_lanes({lane.name: started})
        if watch:
            watched = data.streamed_events(spark, sf_dir, f"{root}/events")
            started = late.start_late_watch(watched, lane, f"{root}/lanes", f"{root}/checkpoints/late", CFG, trigger={"availableNow": True})
            streaming.await_lanes({lane.name: started})
    return f"{root}/lanes"


@query
def friction_loops_early_slices(spark, sf_dir):
    """Counts that grow from batch to batch and over restarts."""
    path = _run_slices(spark, sf_dir, LOOPS, "update", [0, 1, 2, 3, 4], 5)
    return _plain_times(streaming.read_early_lane(spark, path, LOOPS, CFG))


@query
def silent_churners_early_slices(spark, sf_dir):
    """Alerts of one batch that a feature use in a later one takes back."""
    path = _run_slices(spark, sf_dir, CHURN, "update", [0, 1, 2, 3, 4], 5)
    return _plain_times(streaming.read_early_lane(spark, path, CHURN, CFG))


@query
def friction_loops_late_rows(spark, sf_dir):
    """The later half of the time span comes first; the earlier one is late for every closed window."""
    return _plain_times(lane_store.read_lane(spark, _run_slices(spark, sf_dir, LOOPS, "append", [1, 0], 2), LOOPS))


# One stream for all outputs, and what survives a lost checkpoint


def _route(spark: SparkSession, folder: str, root: str, checkpoint: str) -> None:
    """One run of the routed stream over the topic as far as it has been written."""
    raw = spark.readStream.schema(data.TOPIC).parquet(folder)
    streaming.await_lanes({"router": router.start_router(raw, root, checkpoint, CFG, trigger={"availableNow": True})})


def _routed(spark: SparkSession, sf_dir: str) -> str:
    """The whole topic routed in two runs of one checkpoint, half of its offsets in each."""
    root = shared_folder(spark, "router")
    messages = data.topic_messages(spark, sf_dir)
    middle = messages.agg(F.max("offset")).first()[0] // 2
    for part in (F.col("offset") <= middle, F.col("offset") > middle):
        messages.where(part).write.mode("append").parquet(f"{root}/topic")
        _route(spark, f"{root}/topic", root, f"{root}/checkpoint")
    return root


@query
def routed_messages(spark, sf_dir):
    """Parsed and rejected messages that one pass over the topic has stored."""
    root = _routed(spark, sf_dir)
    events = router.read_log(spark, root).select("event_id", "account_id", "mrr", "event_type", "category", "csat_score", "timestamp", F.lit(None).cast("string").alias("message"))
    return events.unionByName(router.read_rejects(spark, root), allowMissingColumns=True)


@query
def routed_alerts(spark, sf_dir):
    """The three lanes of the same pass."""
    root = _routed(spark, sf_dir)
    counts = {TICKETS.name: F.lit(1).cast("long"), LOOPS.name: F.col(LOOPS.count), CHURN.name: F.col(CHURN.count)}
    alerts = [
        router.read_alerts(spark, root, lane, CFG).select(F.lit(lane.name).alias("lane"), "account_id", "mrr", counts[lane.name].alias("number"))
        for lane in LANES
    ]
    return alerts[0].union(alerts[1]).union(alerts[2])


def _after_lost_checkpoint(spark: SparkSession, sf_dir: str, again: bool) -> str:
    """A run over the first part of the topic; its checkpoint is lost. The next one starts with
    the rest, or, with ``again``, from the beginning in larger batches that overlap stored ones."""
    root = shared_folder(spark, "router")
    messages = data.topic_messages(spark, sf_dir)
    middle = messages.agg(F.max("offset")).first()[0] // 2
    messages.where(F.col("offset") <= middle).write.parquet(f"{root}/topic-1")
    _route(spark, f"{root}/topic-1", root, f"{root}/checkpoint-1")
    messages.where(F.lit(again) | (F.col("offset") > middle)).write.parquet(f"{root}/topic-2")
    _route(spark, f"{root}/topic-2", root, f"{root}/checkpoint-2")
    return root


@query
def routed_loops_after_lost_checkpoint(spark, sf_dir):
    """Counts that go on from later offsets."""
    return _plain_times(router.read_alerts(spark, _after_lost_checkpoint(spark, sf_dir, again=False), LOOPS, CFG))


@query
def routed_churn_after_lost_checkpoint(spark, sf_dir):
    """Counts that go on after a start from the beginning, in which half of the messages are stored already."""
    return _plain_times(router.read_alerts(spark, _after_lost_checkpoint(spark, sf_dir, again=True), CHURN, CFG))


# Late events, kept and corrected


@query
def friction_loops_late_events(spark, sf_dir):
    """The events that the stream of ``friction_loops_late_rows`` drops, with the windows they are late for."""
    path = _run_slices(spark, sf_dir, LOOPS, "append", [1, 0], 2, watch=True)
    return _plain_times(late.read_late(spark, path, LOOPS).where("certain").drop("certain"))


def _corrected(spark: SparkSession, sf_dir: str, lane: Lane) -> DataFrame:
    path = _run_slices(spark, sf_dir, lane, "append", [1, 0], 2, watch=True)
    events = data.account_events(spark, sf_dir).withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
    late.correct_lane(spark, path, lane, events, CFG)
    return _plain_times(streaming.read_early_lane(spark, path, lane, CFG))


@query
def friction_loops_late_corrected(spark, sf_dir):
    """The same stream, and the windows of its late events counted again."""
    return _corrected(spark, sf_dir, LOOPS)


@query
def silent_churners_late_corrected(spark, sf_dir):
    """Late logins add alerts and late feature uses take them back."""
    return _corrected(spark, sf_dir, CHURN)


# Windows by revenue band


@query
def friction_loops_by_band(spark, sf_dir):
    return detect.friction_loops_by_band(data.account_events(spark, sf_dir), data.BANDS, CFG)


@query
def friction_loops_by_band_stream(spark, sf_dir):
    """The same in append mode: one state for all bands, closed windows only."""
    root = shared_folder(spark, "stream")
    events = streaming.watermarked(data.account_events_stream(spark, sf_dir), CFG, LOOPS)
    sink = lane_store.parquet_sink(f"{root}/lanes", lane_store.new_run_id())
    loops = detect.friction_loops_by_band(events, data.BANDS, CFG).writeStream.outputMode("append")
    started = loops.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).foreachBatch(sink(LOOPS)).start()
    streaming.await_lanes({LOOPS.name: started})
    return _plain_times(lane_store.read_lane(spark, f"{root}/lanes", LOOPS))
