"""Unions over the lanes and the revenue figures read from them.

Figures over several lanes take the ``latest`` views; the single-lane ones at
the end take whatever rows they are given.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accountwatch.lanes import CHURN, LANES, LOOPS, TICKETS, Lane
from accountwatch.operators.keep import keep_first
from accountwatch.operators.state import alert_status

_LANE_COLUMNS = ("account_id", "mrr", "is_approved", "ai_draft", "lane", "lane_rank")


def _pending() -> Column:
    return ~F.col("is_approved")


def _approved() -> Column:
    return F.col("is_approved")


def _drafted() -> Column:
    return F.col("ai_draft").isNotNull() & (F.col("ai_draft") != "")


def _sum(value: Column | str, condition: Column | None = None) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.coalesce(F.sum(value if condition is None else F.when(condition, value)), F.lit(0.0))


def _lane_rows(latest_rows: DataFrame, lane: Lane) -> DataFrame:
    return latest_rows.selectExpr(
        "account_id",
        "mrr",
        "is_approved",
        "ai_draft",
        f"'{lane.label}' as lane",
        f"{lane.rank} as lane_rank",
        ("ai_draft is not null" if lane is TICKETS else "false") + " as has_draft",
        lane.time,
        *(["category"] if "category" in lane.subject else []),
    )


def _tagged(tickets: DataFrame, loops: DataFrame, churn: DataFrame) -> DataFrame:
    parts = [_lane_rows(rows, lane) for rows, lane in ((tickets, TICKETS), (loops, LOOPS), (churn, CHURN))]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _account_order() -> list[Column]:
    """Ticket lane first, then loops, then churn; within a lane its review order."""
    return [
        F.asc("lane_rank"),
        F.desc("has_draft"),
        F.desc_nulls_last("timestamp"),
        F.desc_nulls_last("window_start"),
        F.desc_nulls_last("category"),
    ]


def _account_rank() -> Column:
    """The same order as one value whose maximum comes first."""
    return F.struct((-F.col("lane_rank")).alias("r"), "has_draft", "timestamp", "window_start", "category")


def all_lanes(tickets: DataFrame, loops: DataFrame, churn: DataFrame) -> DataFrame:
    return _tagged(tickets, loops, churn).select(*_LANE_COLUMNS)


def pending_all_lanes(tickets: DataFrame, loops: DataFrame, churn: DataFrame) -> DataFrame:
    return all_lanes(tickets, loops, churn).filter(_pending()).select("account_id", "mrr")


def one_row_per_account(tickets: DataFrame, loops: DataFrame, churn: DataFrame, only_pending: bool = False) -> DataFrame:
    rows = _tagged(tickets, loops, churn)
    if only_pending:
        rows = rows.filter(_pending())
    return keep_first(rows, ["account_id"], _account_order()).select(*_LANE_COLUMNS)


def lane_kpis(tickets: DataFrame, loops: DataFrame, churn: DataFrame) -> DataFrame:
    """Events at risk, success rate, revenue actioned and revenue at risk in one pass.

    One aggregation by account holds the first approved ticket and the first
    pending row of any lane; a second one adds the accounts up.
    """
    ticket = F.col("lane_rank") == TICKETS.rank
    rank = _account_rank()
    accounts = (
        _tagged(tickets, loops, churn)
        .groupBy("account_id")
        .agg(
            F.count("*").alias("rows"),
            F.count_if(ticket).alias("tickets"),
            F.count_if(ticket & _approved()).alias("approved"),
            F.max_by("mrr", F.when(ticket & _approved(), rank)).alias("actioned"),
            F.max_by("mrr", F.when(_pending(), rank)).alias("at_risk"),
        )
    )
    return accounts.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_risk_events"),
        F.coalesce(F.try_divide(F.sum("approved") * 100.0, F.sum("tickets")), F.lit(0.0)).alias("success_rate"),
        _sum("actioned").alias("revenue_actioned"),
        _sum("at_risk").alias("revenue_at_risk"),
    )


def risk_by_alert_type(tickets: DataFrame, loops: DataFrame, churn: DataFrame) -> DataFrame:
    """Pending revenue per lane; an account counts once in every lane it is in."""
    return all_lanes(tickets, loops, churn).groupBy("lane").agg(_sum("mrr", _pending()).alias("mrr"))


def revenue_funnel(tickets: DataFrame, loops: DataFrame, churn: DataFrame) -> DataFrame:
    """Revenue detected, drafted and actioned over one row per account."""
    # Stage names.
    stages = (
        ("Total Revenue Risk Detected", "total"),
        ("AI Draft Generated", "drafted"),
        ("Revenue Actioned", "actioned"),
    )
    sums = one_row_per_account(tickets, loops, churn).agg(
        _sum("mrr").alias("total"),
        _sum("mrr", _drafted()).alias("drafted"),
        _sum("mrr", _approved()).alias("actioned"),
    )
    pairs = F.array(*[F.struct(F.lit(stage).alias("stage"), F.col(name).alias("number")) for stage, name in stages])
    return sums.select(F.inline(pairs))


def top_exposed_accounts(tickets: DataFrame, loops: DataFrame, churn: DataFrame, n: int = 10) -> DataFrame:
    exposed = one_row_per_account(tickets, loops, churn, only_pending=True).select("account_id", "mrr")
    return exposed.orderBy(F.desc_nulls_last("mrr"), F.asc_nulls_last("account_id")).limit(n)


def account_overview(tickets: DataFrame, loops: DataFrame, churn: DataFrame) -> DataFrame:
    """One row per account, from which every figure of the overview is read; each lane is read once.

    Alerts and pending revenue by lane, the revenue of the first approved ticket and of
    the first pending row, and what its leading row says.
    """
    rank = _account_rank()
    ticket = F.col("lane_rank") == TICKETS.rank
    by_lane = []
    for lane in LANES:
        own = F.col("lane_rank") == lane.rank
        by_lane += [
            F.count_if(own & _pending()).alias(f"{lane.name}_pending"),
            F.count_if(own & _approved()).alias(f"{lane.name}_approved"),
            F.sum(F.when(own & _pending(), F.col("mrr"))).alias(f"{lane.name}_risk"),
        ]
    leading = F.struct("mrr", _drafted().alias("drafted"), _approved().alias("approved"))
    return (
        _tagged(tickets, loops, churn)
        .groupBy("account_id")
        .agg(
            *by_lane,
            F.max_by("mrr", F.when(ticket & _approved(), rank)).alias("actioned"),
            F.max_by("mrr", F.when(_pending(), rank)).alias("at_risk"),
            F.max_by(leading, rank).alias("leading"),
        )
    )


def overview_figures(accounts: DataFrame, n: int = 10) -> DataFrame:
    """Every figure of the overview in long form: ``figure``, the ``lane``, account and approval it is of, and ``number``.

    ``accounts`` is an ``account_overview``, stored, as three small passes read it.
    """

    def row(figure: str, number: Column, lane: Lane | None = None) -> Column:
        return F.struct(F.lit(figure).alias("figure"), F.lit(lane.label if lane else None).alias("lane"), number.cast("double").alias("number"))

    approved = F.sum(f"{TICKETS.name}_approved")
    tickets = approved + F.sum(f"{TICKETS.name}_pending")
    every = sum((F.col(f"{lane.name}_{state}") for lane in LANES for state in ("pending", "approved")), F.lit(0))
    lead = F.col("leading")
    totals = [
        row("total_risk_events", F.coalesce(F.sum(every), F.lit(0))),
        row("success_rate", F.coalesce(F.try_divide(approved * 100.0, tickets), F.lit(0.0))),
        row("revenue_actioned", _sum("actioned")),
        row("revenue_at_risk", _sum("at_risk")),
        row("Total Revenue Risk Detected", _sum(lead["mrr"])),
        row("AI Draft Generated", _sum(lead["mrr"], lead["drafted"])),
        row("Revenue Actioned", _sum(lead["mrr"], lead["approved"])),
    ]
    for lane in LANES:
        rows = F.sum(F.col(f"{lane.name}_pending") + F.col(f"{lane.name}_approved"))
        totals.append(F.when(rows > 0, row("pending_revenue", _sum(f"{lane.name}_risk"), lane)))
    totals = accounts.agg(F.array_compact(F.array(*totals)).alias("rows")).select(F.inline("rows"))
    counts = F.array(
        *[
            F.struct(F.lit(lane.label).alias("lane"), F.lit(state == "approved").alias("is_approved"), F.col(f"{lane.name}_{state}").cast("double").alias("number"))
            for lane in LANES
            for state in ("pending", "approved")
        ]
    )
    alerts = accounts.select("account_id", F.inline(counts)).where("number > 0").withColumn("figure", F.lit("alerts"))
    pending = sum((F.col(f"{lane.name}_pending") for lane in LANES), F.lit(0))
    exposed = accounts.where(pending > 0).orderBy(F.desc_nulls_last("at_risk"), F.asc_nulls_last("account_id")).limit(n)
    exposed = exposed.select("account_id", F.col("at_risk").alias("number"), F.lit("top_exposed").alias("figure"))
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (totals, alerts, exposed))
    return together.select("figure", "lane", "account_id", "is_approved", "number")


def actioned_accounts(tickets: DataFrame, loops: DataFrame, churn: DataFrame) -> DataFrame:
    """The operational report: accounts whose leading row is approved, with their status."""
    return one_row_per_account(tickets, loops, churn).filter(_approved()).withColumn("status", alert_status())


def report_columns(rows: DataFrame) -> DataFrame:
    return rows.select("account_id", "mrr", "category", "event_body", "ai_draft")


def alert_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("account_id", "is_approved").agg(F.count("*").alias("alerts"))


def exposure_by(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    return rows.groupBy(*columns).agg(F.sum("mrr").alias("mrr"))


def exposure_by_category(rows: DataFrame) -> DataFrame:
    """Revenue per category; no rows at all while no row has a category."""
    categorised = rows.where(F.col("category").isNotNull()).select(F.lit(1).alias("one")).limit(1)
    return exposure_by(rows, ["category"]).where(categorised.exists())


def draft_backlog(rows: DataFrame) -> DataFrame:
    """Raw-table figures; any stored draft counts, an empty one included."""
    waiting = F.col("ai_draft").isNotNull() & _pending()
    return rows.agg(
        F.count("*").alias("total_events"),
        F.count_if(waiting).alias("pending_review"),
        _sum("mrr", waiting).alias("revenue_pending_review"),
        _sum("mrr", F.col("ai_draft").isNull()).alias("revenue_undrafted"),
    )


def lane_success(rows: DataFrame, lane: Lane = TICKETS) -> DataFrame:
    """Raw-table success rate, and the revenue of each approved account counted once."""
    rank = F.struct(F.col("ai_draft").isNotNull().alias("drafted"), lane.time, *lane.ties)
    accounts = rows.groupBy("account_id").agg(
        F.count("*").alias("rows"),
        F.count_if(_approved()).alias("approved"),
        F.max_by("mrr", F.when(_approved(), rank)).alias("mrr"),
    )
    return accounts.agg(
        F.coalesce(F.try_divide(F.sum("approved") * 100.0, F.sum("rows")), F.lit(0.0)).alias("success_rate"),
        _sum("mrr").alias("revenue_actioned"),
    )


def status_kpis(alerts: DataFrame) -> DataFrame:
    return alerts.agg(
        F.count("*").alias("total_alerts"),
        _sum("mrr", F.col("status") == "pending").alias("revenue_pending"),
        F.count_if(F.col("status") == "completed").alias("drafts_ready"),
    )


def recent_drafts(alerts: DataFrame, n: int = 5) -> DataFrame:
    """The newest drafted alerts; a table has no order of its own, so time decides."""
    newest = alerts.filter(F.col("status") == "completed").orderBy(
        F.desc_nulls_last("timestamp"), F.desc_nulls_last("event_id")
    )
    return newest.select("account_id", "mrr", "recovery_draft").limit(n)


def mean_time_to_draft(rows: DataFrame, event_time: str = "event_timestamp") -> DataFrame:
    """Minutes from event to draft over the drafted rows; 0 while there is none."""
    gap = F.unix_micros("drafted_at") - F.unix_micros(event_time)
    return rows.agg(F.coalesce(F.avg(gap) / 60e6, F.lit(0.0)).alias("minutes"))
