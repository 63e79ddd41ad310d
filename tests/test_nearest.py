import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from accountwatch.functions.tiers import NO_POLICY
from accountwatch.functions.vector import cosine_distance
from accountwatch.operators.nearest import nearest_policy
from accountwatch.schemas import KNOWLEDGE_BASE

FORMS = {"shipped": {}, "blocked": {"shipped_bytes": 0, "block_bytes": 64}}


def base(spark, vectors):
    return spark.createDataFrame([(i, "c", f"policy {i}", v) for i, v in vectors.items()], KNOWLEDGE_BASE)


def asked(spark, vectors):
    return spark.createDataFrame(list(vectors.items()), "k string, embedding array<float>")


@pytest.mark.parametrize("form", FORMS)
def test_geometry_and_ties(spark, form):
    kb = base(spark, {7: [1.0, 0.0], 3: [2.0, 0.0], 5: [0.0, 1.0], 9: [0.0, 0.0], 8: None, 6: [1.0, 2.0, 3.0]})
    q = asked(
        spark,
        {"same": [3.0, 0.0], "up": [0.1, 1.0], "away": [-1.0, 0.0], "zero": [0.0, 0.0], "none": None, "long": [1.0, 0.0, 0.0]},
    )
    got = {r["k"]: r for r in nearest_policy(q, kb, dim=2, **FORMS[form]).collect()}
    assert len(got) == 6
    assert (got["same"]["sop_id"], got["same"]["distance"], got["same"]["policy"]) == (3, 0.0, "policy 3")
    assert got["up"]["sop_id"] == 5
    assert (got["away"]["sop_id"], got["away"]["distance"]) == (5, 1.0)
    for name in ("zero", "none", "long"):
        assert (got[name]["sop_id"], got[name]["distance"], got[name]["policy"], got[name]["rank"]) == (None, None, NO_POLICY, 1)


@pytest.mark.parametrize("form", FORMS)
def test_empty_knowledge_base(spark, form):
    got = nearest_policy(asked(spark, {"a": [1.0]}), base(spark, {}), **FORMS[form]).collect()
    assert [(r["k"], r["policy"]) for r in got] == [("a", NO_POLICY)]


@pytest.mark.parametrize("form", FORMS)
@pytest.mark.parametrize("k", [1, 4, 50])
def test_equals_brute_force(spark, form, k):
    rng = np.random.default_rng(1)
    policies = rng.integers(-3, 4, (30, 5)).astype(float)
    queries = rng.integers(-3, 4, (200, 5)).astype(float)
    kb = base(spark, {i: v.tolist() for i, v in enumerate(policies)})
    q = asked(spark, {str(i): v.tolist() for i, v in enumerate(queries)})
    got = nearest_policy(q.repartition(5), kb, k=k, **FORMS[form])
    found = {}
    for r in got.orderBy("rank").collect():
        found.setdefault(int(r["k"]), []).append(r["sop_id"])
    for i, v in enumerate(queries):
        if not v.any():
            assert found[i] == [None]
            continue
        distance = {
            j: round(1 - float(v @ p) / (math.sqrt(v @ v) * math.sqrt(p @ p)), 9) for j, p in enumerate(policies) if p.any()
        }
        assert found[i] == sorted(distance, key=lambda j: (distance[j], j))[:k]


def test_other_columns_travel_along(spark):
    q = asked(spark, {"a": [1.0, 0.0]}).withColumn("mrr", F.lit(5.0)).withColumn("at", F.current_timestamp())
    got = nearest_policy(q, base(spark, {1: [1.0, 1.0]})).first()
    assert got["mrr"] == 5.0 and got["at"] is not None and "embedding" not in got


def test_column_form(spark):
    pairs = [([1.0, 0.0], [2.0, 0.0]), ([1.0, 0.0], [0.0, 1.0]), ([1.0], [-1.0]), ([0.0], [1.0]), ([1.0], [1.0, 2.0]), (None, [1.0])]
    df = spark.createDataFrame(pairs, "a array<float>, b array<float>")
    assert [r[0] for r in df.select(cosine_distance("a", "b")).collect()] == [0.0, 1.0, 2.0, None, None, None]


def test_vectors_of_mixed_length_are_named(spark):
    kb = base(spark, {1: [1.0, 0.0], 2: [0.0, 1.0], 6: [1.0, 2.0, 3.0]})
    with pytest.raises(ValueError, match="1 of length 3 .first sop_id 6."):
        nearest_policy(asked(spark, {"a": [1.0, 0.0]}), kb)


@pytest.mark.parametrize("form", FORMS)
def test_doubled_policies_and_odd_keys(spark, form):
    kb = base(spark, {1: [1.0, 0.0], 2: [0.0, 1.0]})
    q = spark.createDataFrame([(None, [1.0, 0.1]), (None, [0.1, 1.0]), ("a", [1.0, 0.0]), ("a", [0.0, 1.0]), ("b", None)], "k string, embedding array<float>")
    got = nearest_policy(q, kb.union(kb), k=2, **FORMS[form]).filter("rank = 1").select("k", "sop_id").collect()
    assert sorted(((r["k"] or "", r["sop_id"] or 0) for r in got)) == [("", 1), ("", 2), ("a", 1), ("a", 2), ("b", 0)]
    assert nearest_policy(q, kb.union(kb), k=2, **FORMS[form]).count() == 9


def clustered(rng, centres, each, dim, spread):
    middle = rng.normal(size=(centres, dim))
    return (np.repeat(middle, each, axis=0) + spread * rng.normal(size=(centres * each, dim))).round(4)


@pytest.mark.parametrize("k,block_bytes", [(1, 512), (3, 1024)])
def test_cells_that_cannot_hold_the_nearest_are_skipped(spark, k, block_bytes):
    """Clustered vectors with doubles, ties, a zero and a hot complaint: both forms agree."""
    rng = np.random.default_rng(3)
    known = clustered(rng, 12, 20, 8, 0.05).tolist()
    known += [known[0]] * 30 + [[2 * x for x in known[25]]] * 3 + [[0.0] * 8]
    kb = base(spark, dict(enumerate(known)))
    rows = clustered(np.random.default_rng(3), 12, 5, 8, 0.05).tolist() + [known[0]] * 60 + [[0.0] * 8, None]
    q = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], "k int, embedding array<float>").repartition(4)
    told = []
    got = nearest_policy(q, kb, k=k, shipped_bytes=0, block_bytes=block_bytes, report=told.append)
    want = nearest_policy(q, kb, k=k)
    columns = ["k", "sop_id", "distance", "rank", "policy"]
    assert sorted(map(str, got.select(columns).collect())) == sorted(map(str, want.select(columns).collect()))
    assert told[0]["complaints"] == len(rows) - 2 and told[0]["blocks"] > 12
    assert told[0]["skipped_share"] > 0.6
    assert told[0]["searched"] < told[0]["complaints"] * told[0]["blocks"] * 0.4


def test_vectors_without_clusters_cost_blocks_but_no_rows(spark):
    rng = np.random.default_rng(8)
    kb = base(spark, {i: v for i, v in enumerate(rng.normal(size=(120, 24)).tolist())})
    q = spark.createDataFrame(list(enumerate(rng.normal(size=(40, 24)).tolist())), "k int, embedding array<float>")
    columns = ["k", "sop_id", "rank"]
    got = nearest_policy(q, kb, k=5, shipped_bytes=0, block_bytes=24 * 8 * 10).select(columns)
    assert sorted(got.collect()) == sorted(nearest_policy(q, kb, k=5).select(columns).collect())


@pytest.mark.parametrize("form", FORMS)
def test_only_zero_vectors(spark, form):
    kb = base(spark, {1: [0.0, 0.0], 2: [0.0, 0.0]})
    got = nearest_policy(asked(spark, {"a": [1.0, 0.0], "b": None}), kb, **FORMS[form]).collect()
    assert sorted((r["k"], r["sop_id"], r["rank"], r["policy"]) for r in got) == [("a", None, 1, NO_POLICY), ("b", None, 1, NO_POLICY)]
