"""Keep-one-per-key in a stated order: the work queues and the current views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accountwatch.lanes import Lane

_RANK = "__rank"


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int = 1, rank: str | None = None) -> DataFrame:
    """The first ``k`` rows of each key; null keys form one group.

    A bounded row_number is planned as a group limit before and after the
    shuffle: each map task sends at most ``k`` rows per key, however hot the key.
    """
    ranked = df.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = ranked.filter(F.col(_RANK) <= k)
    return kept.drop(_RANK) if rank is None else kept.withColumnRenamed(_RANK, rank)


def _oldest_first(lane: Lane) -> list[Column]:
    ties = F.asc_nulls_last if lane.count is None else F.desc_nulls_last
    return [F.asc_nulls_last(lane.time), *[ties(c) for c in lane.ties]]


def _newest_first(lane: Lane) -> list[Column]:
    order = [F.desc_nulls_last(c) for c in (lane.time, *lane.ties)]
    if lane.count is None:
        # Tickets with a stored draft come first; an empty draft counts.
        order.insert(0, F.col("ai_draft").isNotNull().desc())
    return order


def needs_draft(state: DataFrame, lane: Lane) -> DataFrame:
    undrafted = state.filter(F.col("ai_draft").isNull() | (F.col("ai_draft") == ""))
    return undrafted.filter(~F.col("is_approved")) if lane.count is None else undrafted


def ready_for_review(state: DataFrame, allow_empty: bool = False) -> DataFrame:
    drafted = F.col("ai_draft").isNotNull()
    if not allow_empty:
        drafted &= F.col("ai_draft") != ""
    return state.filter(drafted & ~F.col("is_approved"))


def pending(state: DataFrame) -> DataFrame:
    return state.filter(~F.col("is_approved"))


def draft_queue(state: DataFrame, lane: Lane, limit: int | None = None) -> DataFrame:
    """The oldest undrafted row of each queue key; ``limit`` takes the first keys."""
    queue = keep_first(needs_draft(state, lane), lane.queue_key, _oldest_first(lane))
    if limit is None:
        return queue
    return queue.orderBy(*[F.asc_nulls_last(c) for c in lane.queue_key]).limit(limit)


def latest(state: DataFrame, lane: Lane) -> DataFrame:
    """The row of each subject that a reviewer sees."""
    return keep_first(state, lane.subject, _newest_first(lane))


def approved_accounts(state: DataFrame, lane: Lane) -> DataFrame:
    """One approved row per account, in the lane's review order."""
    return keep_first(state.filter("is_approved"), ["account_id"], _newest_first(lane))
