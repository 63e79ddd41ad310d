"""Collocations against counts of every phrase, and automata against dictionaries."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from accountwatch.llm import collocations
from accountwatch.llm.automata import CountTransducer, union


def drawn_phrases(seed, count, words=b"abcdefghi"):
    rnd = random.Random(seed)
    return {tuple(bytes([rnd.choice(words)]) for _ in range(rnd.randint(1, 4))): rnd.randint(1, 1 << 40) for _ in range(count)}


@pytest.mark.parametrize("count", [0, 1, 5, 600])
def test_automata_hold_what_they_were_built_from(count):
    held = drawn_phrases(count, count)
    built = CountTransducer.build(sorted(held.items()))
    assert list(built.items()) == sorted(held.items()) and len(built) == len(held)
    again = CountTransducer.from_bytes(built.to_bytes())
    assert list(again.items()) == sorted(held.items())
    other = drawn_phrases(count + 1, count)
    met = {p: (a, b) for p, a, b in again.compose(CountTransducer.build(sorted(other.items())))}
    assert met == {p: (held[p], other[p]) for p in held.keys() & other.keys()}
    total = union([built, CountTransducer.build(sorted(other.items()))])
    assert total == dict(Counter(held) + Counter(other))


def test_automata_are_minimal():
    """All phrases of three words out of ten need four states, whatever their counts."""
    words = [b"%d" % i for i in range(10)]
    phrases = sorted((a, b, c) for a in words for b in words for c in words)
    built = CountTransducer.build((p, i + 1) for i, p in enumerate(phrases))
    assert len(built.states) == 4 and [w for _, w in built.items()] == list(range(1, 1001))


def plain(rows, least):
    counts, sizes = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for m in range(1, 6):
                counts.setdefault(lang, Counter()).update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, held in counts.items():
        found = {p: f for p, f in held.items() if f >= least and len(p) > 1}
        inner = {}
        for p, f in found.items():
            for s in range(2, len(p)):
                for i in range(len(p) - s + 1):
                    inner[p[i : i + s]] = max(f, inner.get(p[i : i + s], 0))
        kept = []
        for p, a in found.items():
            if inner.get(p, 0) < a:
                score, _, l, r = min((1000 * a * sizes[lang] // (held[p[:k]] * held[p[k:]]), k, held[p[:k]], held[p[k:]]) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, i, p.decode(), -a, l, r, sizes[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(kept)[:40], 1)]
    return sorted(out)


def mined(spark, rows, **settings):
    docs = spark.createDataFrame([(lang, text, 1) for lang, text in rows], "lang string, text string, rank int").repartition(3)
    return sorted(map(tuple, collocations.collocations(docs, top=40, **settings).collect()))


def drawn_docs(seed, count):
    rnd = random.Random(seed)
    words = ["New", "york", "de", "la", "ça", "x\x00y", "x\x1cy", "日本", "b"]
    marks = [" ", " ", "  ", "\t", ". ", ",", "\n", " \r", " ", "\xa0"]
    passage = "these five words always stand together"
    return [
        (rnd.choice(["en", "fr", None]), "".join(rnd.choice(words) + rnd.choice(marks) for _ in range(rnd.randint(0, 60))) + passage * rnd.randint(0, 1))
        for _ in range(count)
    ]


@pytest.mark.parametrize("chars", [1, 300, 8_000_000])
def test_equals_counts_of_every_phrase(spark, monkeypatch, chars):
    rows = drawn_docs(chars, 60) + [("en", None), (None, ""), ("und", "new york new york"), ("fr", "new york " * 400)]
    monkeypatch.setattr(collocations, "SHARD_CHARS", chars)
    expected = plain(rows, 6)
    assert expected and mined(spark, rows, least=6) == expected


def test_full_counters_change_nothing(spark, monkeypatch):
    """As on a corpus that is far too large for them."""
    rows = drawn_docs(8, 40)
    whole = mined(spark, rows, least=5)
    monkeypatch.setattr(collocations, "upper_counts", lambda texts, least: (np.ones((3, 64), dtype=bool), 100))
    assert whole and mined(spark, rows, least=5) == whole
    assert mined(spark, rows, least=10**9) == []


def test_counters_reach_the_least_count_where_a_phrase_does(spark, monkeypatch):
    monkeypatch.setattr(collocations, "COUNTERS", 1 << 12)
    monkeypatch.setattr(collocations, "COUNTER_BLOCK", 1 << 8)
    rows = drawn_docs(9, 50) + [("en", "again " * 700)]
    assert mined(spark, rows, least=300) == plain(rows, 300) != []


def test_hard_rows(spark, hard_docs):
    docs = hard_docs.withColumnsRenamed({"score": "lang"}).withColumnRenamed("_hash", "n")
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert sorted(map(tuple, collocations.collocations(docs, least=3, top=40).collect())) == plain(rows, 3)
    assert collocations.collocations(docs.where("false")).count() == 0


def test_products_beyond_64_bits():
    from accountwatch.llm.collocations import _scored
    import pyarrow as pa

    many = 1 << 40
    counts = {(b"a",): many, (b"b",): many, (b"a", b"b"): many - 1}
    blob = CountTransducer.build(sorted(counts.items())).to_bytes()
    phrases = pa.table({"n": pa.array([1 << 44]), "automaton": pa.array([blob], pa.binary())})
    answers = pa.table({"contained": [False], "automaton": pa.array([blob], pa.binary())})
    row = _scored((pa.scalar(0), pa.scalar("en")), answers, phrases).to_pylist()[0]
    assert row["score"] == 1000 * (many - 1) * (1 << 44) // many**2
