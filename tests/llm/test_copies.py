"""Exact and near copies, shards and quality rules against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from accountwatch.llm import exact, quality, shards, simhash
from accountwatch.llm.components import component_roots
from accountwatch.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def bare(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def test_exact_groups_of_hard_rows(spark, hard_docs):
    rows = exact.exact_groups(hard_docs).collect()
    source = [(r.doc_id, r.text) for r in hard_docs.collect()]
    groups = defaultdict(list)
    for doc, text in source:
        groups[bare(text)].append((-len(text or ""), doc is None, doc or 0, doc))
    want = Counter((m[3], min(ms)[3], len(ms)) for ms in groups.values() for m in ms)
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in rows) == want
    assert sum(r.kept for r in rows) == len(groups)
    kept = exact.drop_exact_copies(hard_docs)
    assert kept.columns == hard_docs.columns and kept.count() == len(groups)
    assert exact.exact_groups(hard_docs.where("false")).count() == 0
    assert exact.drop_exact_copies(hard_docs.where("false")).count() == 0


@pytest.mark.parametrize("shipped", [exact.SHIPPED_ROWS, 0])
def test_exact_copies_of_a_hot_text(spark, tmp_path, shipped):
    """A third of all rows share a text, in blanks and places that differ; ties go to the first row."""
    rows = [(i % 40 if i % 3 else None, "hot  text" if i % 2 else "hot text ", i) if i % 3 else (i, f"text {i % 50}", i) for i in range(600)]
    spark.createDataFrame(rows, "_hash bigint, text string, kept int").repartition(7).write.parquet(str(tmp_path / "t"))
    docs = spark.read.parquet(str(tmp_path / "t"))
    best = {}
    for at, r in enumerate(docs.collect()):
        key = (-len(r.text), r._hash is None, r._hash or 0, at)
        if bare(r.text) not in best or key < best[bare(r.text)][0]:
            best[bare(r.text)] = key, r
    kept = exact.drop_exact_copies(docs, "_hash", shipped_rows=shipped)
    assert sorted(r.kept for r in kept.collect()) == sorted(r.kept for _, r in best.values())
    groups = exact.exact_groups(docs, "_hash", carry=("kept",))
    assert groups.columns == ["_hash", "kept", "keep_id", "group_size", "kept_"]
    assert groups.where("kept_").count() == len(best) and groups.agg({"group_size": "max"}).first()[0] == 400


def test_no_text_is_shuffled_to_drop_few_copies(spark, hard_docs):
    plan = exact.drop_exact_copies(hard_docs)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_a_shared_bit_changes_nothing(spark, hard_docs, monkeypatch):
    monkeypatch.setattr(exact, "FILTER_BITS", 1 << 15)
    monkeypatch.setattr(exact, "_slot", lambda length, prefix: length * 0 + 7)
    for shipped in (exact.SHIPPED_ROWS, 0):
        assert exact.drop_exact_copies(hard_docs, shipped_rows=shipped).count() == len({bare(r.text) for r in hard_docs.collect()})


def plain_fingerprint(text, shingle=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints):
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            root[p] = root[root[p]]
            p = root[p]
        return p

    every = np.array(sorted(prints), dtype=np.uint64)
    for i, p in enumerate(every):
        for q in every[i + 1 :][np.bitwise_count(every[i + 1 :] ^ p) <= 3]:
            root[find(int(q))] = find(int(p))
    return {p: find(p) for p in prints}


def test_op8_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    prints = {r.doc_id: plain_fingerprint(r.text) for r in docs}
    roots = components(set(prints.values()))
    least = {}
    for doc, p in prints.items():
        least[roots[p]] = min(doc, least.get(roots[p], doc))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op8_simhash"](spark, SF).collect()}
    assert got == {doc: (f"{p:016x}", least[roots[p]]) for doc, p in prints.items()}


@pytest.mark.parametrize("most", [simhash.SLICE, 8])
def test_links_connect_what_lies_near(spark, most):
    rnd, prints = random.Random(5), set()
    for _ in range(60):
        p = rnd.getrandbits(64)
        for _ in range(rnd.choice([1, 2, 3, 40])):
            prints.add(p)
            for _ in range(rnd.choice([1, 2, 3, 4])):
                p ^= 1 << rnd.randrange(64)
    signed = {p: int(np.uint64(p).view(np.int64)) for p in prints}
    frame = spark.createDataFrame([(s,) for s in signed.values()], "fp bigint")
    found = {r.node: r.root for r in component_roots(simhash.links_between(frame, 3, most)).collect()}
    want, got = defaultdict(set), defaultdict(set)
    for p, root in components(prints).items():
        want[root].add(p)
        got[found.get(signed[p], signed[p])].add(p)
    assert sorted(map(sorted, want.values())) == sorted(map(sorted, got.values()))


def test_near_copies_of_hard_rows(spark, hard_docs):
    kept = simhash.drop_near_copies(hard_docs)
    prints = [plain_fingerprint(r.text) for r in hard_docs.collect()]
    assert kept.columns == hard_docs.columns
    assert kept.count() == len(set(components(set(prints)).values()))
    assert simhash.near_duplicate_classes(hard_docs.where("false")).count() == 0


def jump(key, count):
    """The published loop."""
    b, j = -1, 0
    while j < count:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_op5_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    keys = {r.doc_id: int(r.k) for r in docs.select("doc_id", shards.stable_key("doc_id").alias("k")).collect()}
    rows = QUERIES["op5_sharding"](spark, SF).collect()
    slots = defaultdict(list)
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 8, zlib.crc32(data), "key")
        assert (r.shard, r.grown_shard) == (jump(keys[r.doc_id], 24), jump(keys[r.doc_id], 25))
        assert r.grown_shard in (r.shard, 24)
        slots[r.shard].append(r.slot)
    assert len(rows) == len(texts) and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_of_hard_rows(spark, hard_docs):
    rows = shards.assign_shards(hard_docs, 3, 4, rows_per_piece=2).collect()
    assert len(rows) == hard_docs.count()
    for shard in {r.shard for r in rows}:
        mine = sorted(r.slot for r in rows if r.shard == shard)
        assert mine == list(range(len(mine)))
    assert shards.assign_shards(hard_docs.where("false"), 3, 4).count() == 0


def test_quality_of_hard_rows(spark, hard_docs):
    rows = quality.judged(quality.measured(hard_docs)).collect()
    assert len(rows) == hard_docs.count()
    for r in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        seen = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        covered = {i + k for i in range(len(words) - 7) if seen[tuple(words[i : i + 8])] > 1 for k in range(8)}
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(words), sum(map(len, words)), len(covered))
        assert r.base_failed == (len(words) < 20 or 100 * len(covered) > 30 * len(words))
        assert not (r.base_failed and r.kept)
    assert quality.judged(quality.measured(hard_docs.where("false"))).count() == 0
