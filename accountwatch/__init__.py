"""Account-risk analytics as plain DataFrame operators, in batch and in Structured Streaming."""

from accountwatch.config import DEFAULT, RiskConfig
from accountwatch.lanes import CHURN, LANES, LOOPS, TICKETS, Lane

__all__ = ["CHURN", "DEFAULT", "LANES", "LOOPS", "TICKETS", "Lane", "RiskConfig"]
