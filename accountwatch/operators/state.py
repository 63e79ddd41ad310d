"""Draft and approval state as append-only change tables joined to a lane.

Nothing is updated in place: drafts (change key, draft, drafted_at) and approvals
(change key, final_draft, approved_at) are only appended to, and the current
state of a lane is the lane joined with the newest change per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountwatch.lanes import Lane
from accountwatch.operators.keep import keep_first


def with_state_columns(rows: DataFrame) -> DataFrame:
    """Fill in the state columns detection does not write; nothing is approved by default."""
    present = set(rows.columns)
    for name, kind in (("ai_draft", "string"), ("drafted_at", "timestamp"), ("is_approved", "boolean")):
        if name not in present:
            rows = rows.withColumn(name, F.lit(None).cast(kind))
    return rows.withColumn("is_approved", F.coalesce("is_approved", F.lit(False)))


def newest_change(changes: DataFrame, lane: Lane, text: str, at: str) -> DataFrame:
    return keep_first(changes, lane.change_key, [F.desc_nulls_last(at), F.desc_nulls_last(text)]).select(
        *lane.change_key, text, at
    )


def _storable(drafts: DataFrame, lane: Lane) -> DataFrame:
    if lane.keeps_empty_drafts:
        return drafts.filter(F.col("draft").isNotNull())
    return drafts.filter(F.col("draft") != "")


def apply_drafts(rows: DataFrame, drafts: DataFrame, lane: Lane) -> DataFrame:
    """Set ``ai_draft`` on every row of a drafted key, duplicates included."""
    rows = with_state_columns(rows)
    newest = newest_change(_storable(drafts, lane), lane, "draft", "drafted_at").withColumnRenamed(
        "drafted_at", "__drafted_at"
    )
    return (
        rows.join(newest, list(lane.change_key), "left")
        .withColumn("ai_draft", F.coalesce("draft", "ai_draft"))
        .withColumn("drafted_at", F.coalesce("__drafted_at", "drafted_at"))
        .select(*rows.columns)
    )


def apply_approvals(rows: DataFrame, approvals: DataFrame, lane: Lane) -> DataFrame:
    """Mark rows approved; the text the reviewer edited replaces the draft."""
    rows = with_state_columns(rows)
    newest = newest_change(approvals, lane, "final_draft", "approved_at").withColumn("__hit", F.lit(True))
    return (
        rows.join(newest, list(lane.change_key), "left")
        .withColumn("ai_draft", F.coalesce("final_draft", "ai_draft"))
        .withColumn("is_approved", F.coalesce("__hit", "is_approved"))
        .select(*rows.columns)
    )


def change_log(drafts: DataFrame, approvals: DataFrame, lane: Lane) -> DataFrame:
    """Drafts and approvals of a lane as one log: change key, ``text``, ``at`` and whether it is a reviewer's ``edit``."""
    log = _storable(drafts, lane).select(
        *lane.change_key, F.col("draft").alias("text"), F.col("drafted_at").alias("at"), F.lit(False).alias("edit")
    )
    edits = approvals.select(
        *lane.change_key, F.col("final_draft").alias("text"), F.col("approved_at").alias("at"), F.lit(True).alias("edit")
    )
    return log.unionByName(edits)


def lane_state(rows: DataFrame, drafts: DataFrame, approvals: DataFrame, lane: Lane) -> DataFrame:
    """The view every queue and figure reads: the last text wins, be it a draft or a reviewer's edit.

    Drafts and approvals are one log, reduced to one row per key before the one join.
    At the same time an edit outranks a draft; an approval without a text only approves.
    """
    return state_from_log(rows, change_log(drafts, approvals, lane), lane)


def state_from_log(rows: DataFrame, log: DataFrame, lane: Lane) -> DataFrame:
    """``lane_state`` from a stored log. Where rows and log are stored by the change key, nothing is shuffled."""
    rows = with_state_columns(rows)
    log = log.withColumnsRenamed({"text": "__text", "at": "__at", "edit": "__edit"})
    turn = F.struct("__at", "__edit", "__text")
    changes = log.groupBy(*lane.change_key).agg(
        F.max_by("__text", F.when(F.col("__text").isNotNull(), turn)).alias("__text"),
        F.max(F.when(~F.col("__edit"), F.col("__at"))).alias("__drafted_at"),
        F.bool_or("__edit").alias("__approved"),
    )
    return (
        rows.join(changes, list(lane.change_key), "left")
        .withColumn("ai_draft", F.coalesce("__text", "ai_draft"))
        .withColumn("drafted_at", F.coalesce("__drafted_at", "drafted_at"))
        .withColumn("is_approved", F.coalesce("__approved", F.lit(False)) | F.col("is_approved"))
        .select(*rows.columns)
    )


def alert_status(approved: Column | str = "is_approved") -> Column:
    flag = F.col(approved) if isinstance(approved, str) else approved
    # Status words.
    return F.when(flag, "Actioned").when(~flag, "At Risk")


def drafted_rows(alerts: DataFrame) -> DataFrame:
    return alerts.filter(F.col("status") == "completed").select("account_id", "mrr", "recovery_draft")


def mark_sent(alerts: DataFrame, approvals: DataFrame) -> DataFrame:
    """Older shape: an approved alert takes the edited text and the status 'sent'."""
    edits = keep_first(approvals, ["event_id"], [F.desc_nulls_last("approved_at"), F.desc_nulls_last("final_draft")])
    edits = edits.select("event_id", "final_draft", F.lit(True).alias("__hit"))
    return (
        alerts.join(edits, "event_id", "left")
        .withColumn("recovery_draft", F.coalesce("final_draft", "recovery_draft"))
        .withColumn("status", F.when(F.col("__hit"), "sent").otherwise(F.col("status")))
        .select(*alerts.columns)
    )
