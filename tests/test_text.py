import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from accountwatch.functions.text import BLANKS, contact_address, strip_preamble
from accountwatch.functions.tiers import NO_POLICY, OFFER_TIERS, policy_or_default, response_tier


def cleaned(spark, drafts):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(drafts)], "i int, draft string")
    return [r[0] for r in df.orderBy("i").select(strip_preamble("draft")).collect()]


def expected(draft):
    """The rule in words: keep from the first line that, trimmed, begins with 'hi ' in any case."""
    draft = draft.strip()
    lines = draft.split("\n")
    greetings = [i for i, line in enumerate(lines) if line.strip()[:3].lower() == "hi "]
    return "\n".join(lines[greetings[0] :]).strip() if greetings else draft


CASES = {
    "Here is:\n\nHi A Team,\nbody\nHi again": "Hi A Team,\nbody\nHi again",
    "Hello\nHi\nbody": "Hello\nHi\nbody",
    "Hi\tA": "Hi\tA",
    "x\r\n  HI B\r\n tail \n": "HI B\r\n tail",
    "This hi x\nHi \nHi y": "Hi y",
    "no greet\n ": "no greet",
    "": "",
    "\u00a0intro\n\u2003hi \u3000there": "hi \u3000there",
    "\U0001f600\nHi \U0001f600": "Hi \U0001f600",
    "a\u2028Hi B": "a\u2028Hi B",
}


def test_known_drafts(spark):
    assert cleaned(spark, CASES) == list(CASES.values())
    assert [expected(d) for d in CASES] == list(CASES.values())
    assert cleaned(spark, [None]) == [None]


def test_long_draft(spark):
    body = "line of text\n" * 100_000
    assert cleaned(spark, [body, body + "Hi A\n" + body]) == [body.strip(), "Hi A\n" + body.strip()]
    assert cleaned(spark, [" \n" * 100_000 + "x"]) == ["x"]


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="hHhHiIiI  ab\U0001f600" + BLANKS), min_size=20, max_size=60))
def test_any_draft(spark, drafts):
    assert cleaned(spark, drafts) == [expected(d) for d in drafts]


def test_contact_address(spark):
    df = spark.createDataFrame([("Smith, Jones and Sons",), (None,)], "name string")
    assert [r[0] for r in df.select(contact_address("name")).collect()] == ["contact@smithjonesandsons.com", None]


@pytest.mark.parametrize(
    "mrr, tier", [(9999.0, "Growth"), (10000.0, "VIP"), (14999.0, "VIP"), (15000.0, "ULTRA"), (None, "Growth")]
)
def test_support_tiers(spark, mrr, tier):
    df = spark.createDataFrame([(mrr, "do this"), (mrr, None)], "mrr double, policy string")
    full, bare = [r["recovery_strategy"] for r in response_tier(df).collect()]
    assert full.startswith(tier) and full.endswith(" Follow this specific protocol: do this")
    assert bare.endswith(" Follow this specific protocol: ")


@pytest.mark.parametrize("mrr, tier", [(5000.0, "Standard"), (5001.0, "High-Priority"), (None, "Standard")])
def test_offer_tiers(spark, mrr, tier):
    df = spark.createDataFrame([(mrr,)], "mrr double")
    assert response_tier(df, OFFER_TIERS, policy=None).first()["recovery_strategy"].startswith(tier)


def test_policy_default(spark):
    df = spark.createDataFrame([("p",), (None,)], "policy string")
    assert [r[0] for r in df.select(policy_or_default("policy")).collect()] == ["p", NO_POLICY]
