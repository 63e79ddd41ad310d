"""The three alert tables ("lanes") and the keys and orders that belong to each."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Lane:
    name: str
    rank: int  # which lane speaks for an account that is in several
    label: str  # name in reports
    row_key: tuple[str, ...]  # identifies one detected row
    change_key: tuple[str, ...]  # what drafts and approvals refer to
    subject: tuple[str, ...]  # one current row per subject in the latest_* views
    queue_key: tuple[str, ...]  # one row per key is drafted at a time
    time: str  # column that orders the lane
    ties: tuple[str, ...]  # descending tie-breaks that make the order total
    count: str | None  # count column the detection threshold applies to
    keeps_empty_drafts: bool  # an empty draft overwrites the stored one


# Lane labels and key columns.
TICKETS = Lane(
    name="tickets",
    rank=1,
    label="Ticket Recovery",
    row_key=("event_id",),
    change_key=("event_id",),
    subject=("account_id", "category"),
    queue_key=("account_id",),
    time="timestamp",
    ties=("event_id",),
    count=None,
    keeps_empty_drafts=True,
)
LOOPS = Lane(
    name="loops",
    rank=2,
    label="Systemic Failure",
    row_key=("account_id", "category", "mrr", "window_start"),
    change_key=("account_id", "category", "window_start"),
    subject=("account_id", "category"),
    queue_key=("account_id", "category"),
    time="window_start",
    ties=("incident_count", "mrr"),
    count="incident_count",
    keeps_empty_drafts=False,
)
CHURN = Lane(
    name="churn",
    rank=3,
    label="Silent Churn Risk",
    row_key=("account_id", "mrr", "window_start"),
    change_key=("account_id", "window_start"),
    subject=("account_id",),
    queue_key=("account_id",),
    time="window_start",
    ties=("login_count", "mrr"),
    count="login_count",
    keeps_empty_drafts=False,
)

LANES = (TICKETS, LOOPS, CHURN)
