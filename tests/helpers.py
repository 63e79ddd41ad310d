"""Small literal events with the shapes of the two burst scenarios."""

from accountwatch.operators.detect import with_event_time
from accountwatch.schemas import RAW_EVENT

T0 = 1704067200  # a full minute

DEFAULTS = dict(
    user_id="u",
    account_id="Acme",
    email="contact@acme.com",
    mrr=25000.0,
    event_type="support_ticket",
    category="API Latency",
    event_body="Requests time out",
    csat_score=1,
    timestamp=T0,
)


def raw(spark, rows):
    full = [{"event_id": f"e-{i:03d}", **DEFAULTS, **row} for i, row in enumerate(rows)]
    return spark.createDataFrame([tuple(r[n] for n in RAW_EVENT.names) for r in full], RAW_EVENT)


def events(spark, rows):
    return with_event_time(raw(spark, rows))


def tickets_at(*seconds, **fields):
    return [{"timestamp": T0 + s, **fields} for s in seconds]


def logins_at(*seconds, **fields):
    return tickets_at(*seconds, event_type="login", category="N/A", csat_score=3, **fields)
