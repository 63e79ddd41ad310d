"""Response tiers: ordered revenue bounds, each with the text a draft must follow."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Tier:
    text: str
    bound: float | None = None  # None: everybody else
    inclusive: bool = True


# Tier bounds and texts.
SUPPORT_TIERS = (
    Tier("ULTRA-VIP: Executive Outreach. Immediate 30-min Zoom invite.", 15000.0),
    Tier("VIP Concierge: Priority response within 1 hour.", 10000.0),
    Tier("Growth Account: Standard 4-hour recovery protocol."),
)
OFFER_TIERS = (
    Tier("High-Priority: Offer 1-on-1 Product Lead call + 20% loyalty discount.", 5000.0, inclusive=False),
    Tier("Standard: Offer 1 month free credit + technical guide."),
)
PROTOCOL = " Follow this specific protocol: "
NO_POLICY = "No specific policy found. Use general best practices."


def tier_text(mrr: Column | str, tiers: Sequence[Tier]) -> Column:
    """Text of the first tier whose bound the revenue reaches; missing revenue counts as 0."""
    revenue = F.coalesce(F.col(mrr) if isinstance(mrr, str) else mrr, F.lit(0.0))
    text = F.lit(tiers[-1].text)
    for tier in reversed(tiers[:-1]):
        reached = revenue >= tier.bound if tier.inclusive else revenue > tier.bound
        text = F.when(reached, tier.text).otherwise(text)
    return text


def response_tier(df: DataFrame, tiers: Sequence[Tier] = SUPPORT_TIERS, policy: str | None = "policy") -> DataFrame:
    """Add ``recovery_strategy``; with a policy column the protocol sentence follows the tier."""
    strategy = tier_text("mrr", tiers)
    if policy is not None:
        strategy = F.concat(strategy, F.lit(PROTOCOL), F.coalesce(F.col(policy), F.lit("")))
    return df.withColumn("recovery_strategy", strategy)


def policy_or_default(policy: Column | str) -> Column:
    return F.coalesce(F.col(policy) if isinstance(policy, str) else policy, F.lit(NO_POLICY))
