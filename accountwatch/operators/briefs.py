"""Drafting briefs, the pluggable writer, and the drafts that come back."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accountwatch.functions.text import strip_preamble
from accountwatch.lanes import CHURN, LOOPS, TICKETS, Lane

# Texts stored when there is nothing to write about or nothing came back.
NO_COMPLAINT = "No complaint provided."
NO_DRAFT = "Draft generation failed."
FAILED = "Agent Error: "


@dataclass(frozen=True)
class Sender:
    name: str = "Customer Success"
    company: str = "our company"


def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def _lines(*parts: Column) -> Column:
    return F.concat_ws("\n", *parts)


def _line(label: str, column: str) -> Column:
    return F.concat(F.lit(f"{label}: "), _text(column))


def _closing(sender: Sender, words: int, tone: str) -> list[Column]:
    return [
        F.lit("Open with 'Hi [Account] Team,' and put nothing before it."),
        F.lit(f"At most {words} words, no placeholders. Tone: {tone}."),
        F.lit(f"Sign as {sender.name}, {sender.company}."),
    ]


def ticket_brief(sender: Sender) -> Column:
    return _lines(
        F.lit(f"Write a recovery email from a senior customer success manager at {sender.company}."),
        _line("Account", "account_id"),
        _line("Issue type", "category"),
        _line("Complaint", "event_body"),
        _line("Resolution policy", "policy"),
        _line("Strategy", "recovery_strategy"),
        F.lit("Acknowledge the complaint, give the steps of the policy, end with one next step."),
        F.lit("Offer a call for technical or integration issues only. Never name an internal tier."),
        *_closing(sender, 100, "direct, empathetic, focused on the solution"),
    )


def loop_brief(sender: Sender) -> Column:
    return _lines(
        F.lit(f"Write an escalation email from a senior customer success manager at {sender.company}."),
        _line("Account", "account_id"),
        _line("Repeated issue", "category"),
        _line("Reports in the window", "incident_count"),
        _line("Reported as", "event_summary"),
        F.lit("Apologise for the repeated trouble, say that engineering has it, offer a 30-minute call."),
        *_closing(sender, 80, "accountable, focused on the solution"),
    )


def churn_brief(sender: Sender) -> Column:
    return _lines(
        F.lit(f"Write a re-engagement email from a product adoption specialist at {sender.company}."),
        _line("Account", "account_id"),
        _line("Logins without feature use", "login_count"),
        F.lit("Start from the observation, not from a sale, and offer a 15-minute onboarding call."),
        *_closing(sender, 70, "warm, observant, never pushy"),
    )


def offer_brief(sender: Sender) -> Column:
    return _lines(
        F.lit(f"Write a short recovery email from a senior customer success manager at {sender.company}."),
        _line("Account", "account_id"),
        _line("Issue type", "category"),
        _line("Strategy", "recovery_strategy"),
        F.lit("Address the customer by account when no name is known."),
        *_closing(sender, 80, "empathetic but formal"),
    )


_BRIEFS = {TICKETS.name: ticket_brief, LOOPS.name: loop_brief, CHURN.name: churn_brief, "offer": offer_brief}


def draft_brief(df: DataFrame, kind: Lane | str, sender: Sender = Sender()) -> DataFrame:
    """Add ``brief``: the lane's fields and instructions for whoever writes the draft."""
    name = kind if isinstance(kind, str) else kind.name
    return df.withColumn("brief", _BRIEFS[name](sender))


def draft_with(
    df: DataFrame,
    make_writer: Callable[[], Callable[[dict], str | None]],
    keys: Sequence[str],
    complaint: str | None = None,
    tasks: int | None = None,
    reads: Sequence[str] | None = None,
) -> DataFrame:
    """Have a caller-supplied writer draft each row: the keys, ``draft`` and ``error``.

    ``make_writer`` runs once per task, so a client is opened once and not per
    row; if that fails, the task does. A row without a draft says why in ``error``: nothing
    to write about, nothing came back, or the writer's failure, which does not stop the job.
    Briefs are small and a writer is slow: ``tasks`` spreads them over that many
    tasks where Spark, going by size, would pack them into few. ``reads`` names the
    columns the writer needs, if not all.
    """
    if reads is not None:
        df = df.select(*dict.fromkeys([*keys, *reads, *([complaint] if complaint else [])]))
    if tasks is not None:
        df = df.repartition(tasks)
    schema = T.StructType(
        [df.schema[k] for k in keys] + [T.StructField("draft", T.StringType()), T.StructField("error", T.StringType())]
    )
    no_complaint, no_draft, failed = NO_COMPLAINT, NO_DRAFT, FAILED

    def write(batches):
        import pyarrow as pa

        writer = make_writer()
        for batch in batches:
            drafts, errors = [], []
            for row in batch.to_pylist():
                draft = error = None
                if complaint is not None and not row[complaint]:
                    error = no_complaint
                else:
                    try:
                        draft = writer(row)
                        error = no_draft if draft is None else None
                    except Exception as failure:  # the writer is foreign code
                        error = f"{failed}{failure}"
                drafts.append(draft)
                errors.append(error)
            columns = [batch.column(key) for key in keys]
            columns += [pa.array(drafts, pa.string()), pa.array(errors, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keys, "draft", "error"])

    return df.mapInArrow(write, schema)


def clean_drafts(drafts: DataFrame) -> DataFrame:
    """Raw writer output to rows for the drafts table; failed rows stay out."""
    return drafts.filter(F.col("error").isNull()).select(
        *[c for c in drafts.columns if c not in ("draft", "error")],
        strip_preamble("draft").alias("draft"),
        F.current_timestamp().alias("drafted_at"),
    )
