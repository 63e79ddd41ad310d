"""From undrafted alerts to rows for the drafts table, one job per lane."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accountwatch.config import LOW_CSAT, RiskConfig
from accountwatch.functions.tiers import OFFER_TIERS, response_tier
from accountwatch.lanes import TICKETS, Lane
from accountwatch.operators.briefs import Sender, clean_drafts, draft_brief, draft_with
from accountwatch.operators.detect import low_csat_risk
from accountwatch.operators.keep import draft_queue
from accountwatch.operators.nearest import nearest_policy

Writer = Callable[[], Callable[[dict], str | None]]


def ticket_briefs(state: DataFrame, vectors: DataFrame, kb: DataFrame, sender: Sender = Sender(), limit: int | None = None) -> DataFrame:
    """Queue, nearest policy, tier and brief. ``vectors`` is (event_id, embedding)."""
    queue = draft_queue(state, TICKETS, limit).join(vectors, "event_id", "left")
    return draft_brief(response_tier(nearest_policy(queue, kb)), TICKETS, sender)


def draft_tickets(
    state: DataFrame,
    vectors: DataFrame,
    kb: DataFrame,
    writer: Writer,
    sender: Sender = Sender(),
    limit: int | None = None,
    tasks: int | None = None,
) -> DataFrame:
    briefs = ticket_briefs(state, vectors, kb, sender, limit)
    return clean_drafts(draft_with(briefs, writer, TICKETS.change_key, tasks=tasks))


def draft_lane(
    state: DataFrame, lane: Lane, writer: Writer, sender: Sender = Sender(), tasks: int | None = None
) -> DataFrame:
    """Loops and churn need no policy: the pattern itself is the story."""
    briefs = draft_brief(draft_queue(state, lane), lane, sender)
    return clean_drafts(draft_with(briefs, writer, lane.change_key, tasks=tasks))


def offer_briefs(alerts: DataFrame, sender: Sender = Sender()) -> DataFrame:
    """The older route: a revenue rule picks the offer, no policy is looked up."""
    return draft_brief(response_tier(alerts, OFFER_TIERS, policy=None), "offer", sender)


def screened_drafts(events: DataFrame, writer: Writer, cfg: RiskConfig = LOW_CSAT) -> DataFrame:
    """The first route, batch or stream: loose screen, then a draft beside every screened event.

    It only shows drafts, so where there is none the reason stands in its place.
    """
    risky = low_csat_risk(events, cfg)
    drafted = draft_with(risky, writer, risky.columns, complaint="event_body")
    return drafted.withColumn("draft", F.coalesce("draft", "error"))
