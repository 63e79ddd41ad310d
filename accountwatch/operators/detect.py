"""Detection of accounts at risk. The same functions serve batch and streaming frames."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountwatch.config import DEFAULT, Band, RiskConfig


def with_event_time(events: DataFrame) -> DataFrame:
    """Epoch seconds to an instant, without a detour through local-time text."""
    return events.withColumn("event_timestamp", F.timestamp_seconds("timestamp"))


def priority_score(events: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    return events.withColumn("priority_score", F.col("mrr") * (F.lit(cfg.csat_scale) - F.col("csat_score")))


def low_csat_risk(events: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Valuable and unhappy, whatever the event type."""
    return events.filter((F.col("mrr") >= cfg.min_mrr) & (F.col("csat_score") <= cfg.max_csat))


def ticket_alerts(events: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    tickets = events.filter(F.col("event_type") == cfg.ticket_type)
    return priority_score(low_csat_risk(tickets, cfg), cfg)


_LOOP = ("account_id", "category", "mrr")


def event_window(cfg: RiskConfig) -> Column:
    if cfg.window_slide is None:
        return F.window("event_timestamp", cfg.window_width)
    return F.window("event_timestamp", cfg.window_width, cfg.window_slide)


def _with_bounds(counts: DataFrame, *columns: str) -> DataFrame:
    return counts.select(
        *columns,
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
    )


def enough_incidents(counts: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    return counts.filter(F.col("incident_count") >= cfg.min_incidents)


def no_feature_use(counts: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    return counts.filter((F.col("login_count") >= cfg.min_logins) & (F.col("feature_count") <= cfg.max_features))


def _tickets_of_value(events: DataFrame, cfg: RiskConfig) -> DataFrame:
    return events.filter((F.col("event_type") == cfg.ticket_type) & (F.col("mrr") >= cfg.min_mrr))


def ticket_counts(events: DataFrame, cfg: RiskConfig = DEFAULT, summary: str = "first") -> DataFrame:
    """Tickets per window, account, category and revenue, with the first (or last) text.

    Map tasks combine before the shuffle, so an account with a third of all
    tickets sends one row per task and window.
    """
    pick = {"first": F.min_by, "last": F.max_by}[summary]
    counts = _tickets_of_value(events, cfg).groupBy(event_window(cfg), *_LOOP).agg(
        F.count("*").alias("incident_count"),
        pick("event_body", F.struct("event_timestamp", "event_id")).alias("event_summary"),
    )
    return _with_bounds(counts, *_LOOP, "incident_count", "event_summary")


def _with_texts(counts: DataFrame, events: DataFrame, summary: str) -> DataFrame:
    """The first (or last) text of each window by the time of that event, ``__at``; at one time the event id decides."""
    pick = {"first": F.min_by, "last": F.max_by}[summary]
    counts = counts.withColumnsRenamed({c: f"__{c}" for c in _LOOP})
    same = [events[c].eqNullSafe(counts[f"__{c}"]) for c in _LOOP]
    found = counts.join(events, [*same, events["event_timestamp"] == counts["__at"]])
    texts = found.groupBy("window_start", "window_end", *_LOOP, "incident_count").agg(
        pick("event_body", F.struct("event_id")).alias("event_summary")
    )
    return texts.select(*_LOOP, "incident_count", "event_summary", "window_start", "window_end")


def added_tickets(events: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """What some events add to the counts of their windows, with the first text and where it stands in time."""
    first = F.struct("event_timestamp", "event_id")
    counts = (
        _tickets_of_value(events, cfg).groupBy(event_window(cfg), *_LOOP)
        .agg(F.count("*").alias("incident_count"), F.min_by("event_body", first).alias("event_summary"), F.min(first).alias("__first"))
    )
    bounded = _with_bounds(counts, *_LOOP, "incident_count", "event_summary", "__first")
    return bounded.withColumns({"first_at": F.col("__first.event_timestamp"), "first_id": F.col("__first.event_id")}).drop("__first")


def summed_tickets(added: DataFrame) -> DataFrame:
    """``ticket_counts`` from what its parts have added."""
    return added.groupBy("window_start", "window_end", "account_id", "category", "mrr").agg(
        F.sum("incident_count").alias("incident_count"),
        F.min_by("event_summary", F.struct("first_at", "first_id")).alias("event_summary"),
    ).select("account_id", "category", "mrr", "incident_count", "event_summary", "window_start", "window_end")


def friction_loops(events: DataFrame, cfg: RiskConfig = DEFAULT, summary: str = "first") -> DataFrame:
    """The same account reporting the same category again and again.

    In batch no text is shuffled or sorted to be counted: windows are counted with the
    time of the text they will show, those below the bound go, and only then are the texts
    of the others fetched. A stream has one pass and carries the texts along.
    """
    if events.isStreaming:
        return enough_incidents(ticket_counts(events, cfg, summary), cfg)
    tickets = _tickets_of_value(events, cfg)
    at = {"first": F.min, "last": F.max}[summary]("event_timestamp").alias("__at")
    counts = tickets.groupBy(event_window(cfg), *_LOOP).agg(F.count("*").alias("incident_count"), at)
    loops = enough_incidents(_with_bounds(counts, *_LOOP, "incident_count", "__at"), cfg)
    return _with_texts(loops, tickets.select(*_LOOP, "event_timestamp", "event_id", "event_body"), summary)


def windowed_by_band(events: DataFrame, bands: Sequence[Band]) -> DataFrame:
    """Events with the windows of their account's revenue band, as ``window``; none for accounts below all bands.

    Bands share no event, so each is a filter that reaches the scan, and what follows is one
    aggregation over all of them, on a stream with one state.
    """
    bands = sorted(bands, key=lambda band: band.min_mrr)
    parts = []
    for band, above in zip(bands, [*bands[1:], None], strict=True):
        own = F.col("mrr") >= band.min_mrr
        own = own if above is None else own & (F.col("mrr") < above.min_mrr)
        window = F.window("event_timestamp", band.width, band.slide) if band.slide else F.window("event_timestamp", band.width)
        parts.append(events.filter(own).select("*", window.alias("window")))
    return reduce(DataFrame.unionByName, parts)


def friction_loops_by_band(events: DataFrame, bands: Sequence[Band], cfg: RiskConfig = DEFAULT) -> DataFrame:
    """``friction_loops`` where each revenue band has a window width of its own."""
    first = F.struct("event_timestamp", "event_id")
    counts = windowed_by_band(_tickets_of_value(events, cfg), bands).groupBy("window", *_LOOP).agg(
        F.count("*").alias("incident_count"), F.min_by("event_body", first).alias("event_summary")
    )
    loops = _with_bounds(counts, *_LOOP, "incident_count", "event_summary")
    return enough_incidents(loops, cfg)


def usage_counts(events: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Logins and feature uses per window, account and revenue."""
    events = events.filter(F.col("mrr") >= cfg.min_mrr)
    counts = events.groupBy(event_window(cfg), "account_id", "mrr").agg(
        F.count_if(F.col("event_type") == cfg.login_type).alias("login_count"),
        F.count_if(F.col("event_type") == cfg.feature_type).alias("feature_count"),
    )
    return _with_bounds(counts, "account_id", "mrr", "login_count", "feature_count")


def summed_usage(added: DataFrame) -> DataFrame:
    """``usage_counts`` from what its parts have added; their rows are such counts themselves."""
    return added.groupBy("window_start", "window_end", "account_id", "mrr").agg(
        F.sum("login_count").alias("login_count"), F.sum("feature_count").alias("feature_count")
    ).select("account_id", "mrr", "login_count", "feature_count", "window_start", "window_end")


def silent_churners(events: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Many logins and no feature use within one window."""
    if cfg.min_logins > 0 and not events.isStreaming:
        # Other events cannot change a group that needs a login. A stream keeps
        # them: they move the watermark.
        events = events.filter(F.col("event_type").isin(cfg.login_type, cfg.feature_type))
    return no_feature_use(usage_counts(events, cfg), cfg)


def priority_ranking(alerts: DataFrame, n: int | None = None) -> DataFrame:
    """Most urgent alerts first; with ``n`` only a top-n per task reaches the final sort."""
    ranked = alerts.orderBy(F.desc_nulls_last("priority_score"), F.asc_nulls_last("event_id"))
    return ranked if n is None else ranked.limit(n)
