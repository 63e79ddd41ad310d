"""Thresholds, event names and windows in one frozen record."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class RiskConfig:
    # The detection thresholds every result depends on.
    min_mrr: float = 10000.0
    max_csat: int = 3
    csat_scale: int = 5
    min_incidents: int = 3
    min_logins: int = 5
    max_features: int = 0
    # Event type names.
    ticket_type: str = "support_ticket"
    login_type: str = "login"
    feature_type: str = "feature_access"
    # Event-time windows. A slide of None means tumbling windows.
    window_width: str = "2 minutes"
    window_slide: str | None = "1 minute"
    watermark: str = "1 minute"

    def tumbling(self) -> RiskConfig:
        """The same thresholds over windows that do not overlap."""
        return replace(self, window_slide=None)


@dataclass(frozen=True)
class Band:
    """Windows of the accounts from ``min_mrr`` up to the next band."""

    min_mrr: float
    width: str
    slide: str | None = None


DEFAULT = RiskConfig()

# The early prototype's looser screen: any event type, a tenth of the revenue.
LOW_CSAT = RiskConfig(min_mrr=1000.0)
