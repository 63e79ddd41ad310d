import json
from datetime import datetime

from pyspark.sql import functions as F
from test_state import CHURN_ROW, LOOP

from accountwatch import CHURN, LOOPS, TICKETS
from accountwatch.operators.briefs import NO_COMPLAINT, NO_DRAFT, Sender, clean_drafts, draft_with
from accountwatch.operators.keep import needs_draft
from accountwatch.operators.state import apply_drafts
from accountwatch.plans.drafting import draft_lane, draft_tickets, offer_briefs, screened_drafts
from accountwatch.plans.overview import overview
from accountwatch.schemas import KNOWLEDGE_BASE, SHORT_EVENT
from accountwatch.sources.events import parse_events, read_event_files

T0 = datetime(2024, 1, 1)
TICKET = (
    "event_id string, account_id string, category string, mrr double, event_body string, timestamp long, "
    "ai_draft string, is_approved boolean"
)


def polite():
    def make():
        def write(row):
            return f"Sure:\nHi {row['account_id']} Team,\n{row['brief']}\n"

        return write

    return make


def tickets(spark):
    return spark.createDataFrame(
        [
            ("e1", "a", "UI Bug", 12000.0, "it froze", 1, None, False),
            ("e2", "a", "UI Bug", 12000.0, "again", 2, None, False),
            ("e3", "b", None, None, None, 1, None, False),
        ],
        TICKET,
    )


def test_ticket_route_end_to_end(spark):
    kb = spark.createDataFrame([(1, "c", "reload", [1.0, 0.0]), (2, "c", "refund", [0.0, 1.0])], KNOWLEDGE_BASE)
    vectors = spark.createDataFrame([("e1", [0.1, 1.0])], "event_id string, embedding array<float>")
    drafts = draft_tickets(tickets(spark), vectors, kb, polite(), Sender("Ada", "Example Ltd"))
    got = {r["event_id"]: r["draft"] for r in drafts.collect()}
    assert set(got) == {"e1", "e3"}
    assert got["e1"].startswith("Hi a Team,\n")
    for part in ("Complaint: it froze", "Resolution policy: refund", "VIP Concierge", "Ada, Example Ltd"):
        assert part in got["e1"]
    assert "No specific policy found" in got["e3"] and "Growth Account" in got["e3"]
    state = apply_drafts(tickets(spark), drafts, TICKETS)
    assert {r["event_id"]: r["ai_draft"] is not None for r in state.collect()} == {"e1": True, "e2": False, "e3": True}


def test_proactive_routes(spark):
    loops = spark.createDataFrame([("a", "UI Bug", 1.0, 4, T0, None, False)], LOOP).selectExpr("*", "'froze' as event_summary")
    churn = spark.createDataFrame([("a", 1.0, 6, T0, "", False)], CHURN_ROW)
    [loop] = draft_lane(loops, LOOPS, polite()).collect()
    [quiet] = draft_lane(churn, CHURN, polite()).collect()
    assert "Reports in the window: 4" in loop["draft"] and "Reported as: froze" in loop["draft"]
    assert "Logins without feature use: 6" in quiet["draft"]
    assert loop["window_start"] == T0 and loop["drafted_at"] is not None


def test_offer_brief_survives_nulls(spark):
    briefs = [r["brief"] for r in offer_briefs(tickets(spark)).collect()]
    assert all(b is not None for b in briefs)
    assert "High-Priority" in briefs[0] and "Standard" in briefs[2]


def test_failures_stay_in_their_row(spark):
    def make():
        def write(row):
            if row["event_id"] == "e1":
                raise RuntimeError("busy")
            return None

        return write

    briefed = tickets(spark)
    got = {r["event_id"]: (r["draft"], r["error"]) for r in draft_with(briefed, make, ("event_id",), "event_body").collect()}
    assert got == {"e1": (None, "Agent Error: busy"), "e2": (None, NO_DRAFT), "e3": (None, NO_COMPLAINT)}
    kept = clean_drafts(draft_with(briefed, make, ("event_id",), "event_body"))
    assert kept.count() == 0
    state = apply_drafts(tickets(spark), kept, TICKETS)
    assert needs_draft(state, TICKETS).count() == 3


def test_the_writer_is_made_once_per_task(spark, tmp_path):
    log = str(tmp_path / "made")

    def make():
        with open(log, "a") as f:
            f.write("x")
        return lambda row: "Hi x"

    rows = spark.range(5000, numPartitions=2)
    assert draft_with(rows, make, ("id",)).filter("draft = 'Hi x'").count() == 5000
    assert len(open(log).read()) == 2


def test_a_writer_sees_what_it_reads(spark):
    def make():
        return lambda row: ",".join(row)

    drafted = draft_with(tickets(spark), make, ("event_id",), "event_body", reads=("account_id",))
    assert {r["draft"] for r in drafted.collect()} == {"event_id,account_id,event_body", None}


def test_briefs_spread_over_tasks(spark):
    drafted = draft_with(tickets(spark).coalesce(1), polite(), ("event_id",), tasks=3)
    assert drafted.rdd.getNumPartitions() == 3


def test_screen_with_drafts_on_a_stream(spark, tmp_path):
    body = [{"account_id": "a", "mrr": m, "event_body": "slow", "csat_score": 2} for m in (999.0, 1000.0)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.json").write_text("\n".join(map(json.dumps, body)))

    def make():
        return lambda row: f"Hi {row['account_id']}"

    events = parse_events(read_event_files(spark, str(tmp_path / "in")), SHORT_EVENT)
    writer = screened_drafts(events, make).writeStream.format("memory").queryName("screened")
    query = writer.option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert [tuple(r) for r in spark.table("screened").collect()] == [("a", 1000.0, "slow", 2, "Hi a", None)]


def test_overview_has_every_table(spark):
    lanes = (
        tickets(spark).withColumn("is_approved", F.col("event_id") == "e3"),
        spark.createDataFrame([("a", "UI Bug", 1.0, 4, T0, None, False)], LOOP),
        spark.createDataFrame([("a", 1.0, 6, T0, None, False)], CHURN_ROW),
    )
    shown = {name: df.count() for name, df in overview(*lanes).items()}
    assert shown == {
        "kpis": 1, "risk_by_alert_type": 3, "revenue_funnel": 3, "top_exposed_accounts": 1, "actioned_accounts": 1,
        "ticket_counts": 2, "loop_counts": 1, "churn_counts": 1, "ticket_reviews": 0, "loop_reviews": 1, "churn_reviews": 1,
    }
