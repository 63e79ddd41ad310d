"""Language-model scores against a model of dictionaries, and its probabilities against their sum."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from accountwatch.llm import lm, toxicity
from accountwatch.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def tokens_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [""]


class Plain:
    """The same model, one probability at a time."""

    def __init__(self, texts):
        rows = [tokens_of(t) for t in texts]
        self.words = Counter(t for row in rows for t in row)
        self.pairs = Counter(p for row in rows for p in zip(["", *row], row))
        self.firsts = Counter(p for row in rows for p in ["", *row[:-1]])
        self.n = sum(self.words.values())
        self.word_kept, self.pair_kept = (lm.discounts([sum(c == r for c in held.values()) for r in range(1, 7)]) for held in (self.words, self.pairs))
        self.common = {w for w, c in self.words.items() if c >= self.n // lm.COMMON + 1}
        freed = sum(c * (1 - self.word_kept[c - 1]) for c in self.words.values() if c <= 5)
        self.scale = 1 if freed else self.n / (self.n + 1)
        self.unknown = freed / self.n if freed else 1 / (self.n + 1)
        self.after = {}
        for (a, b), c in self.pairs.items():
            self.after.setdefault(a, {})[b] = c

    def word(self, w):
        c = self.words[w]
        return self.unknown if not c else c / self.n * (self.word_kept[c - 1] if c <= 5 else self.scale)

    def pair(self, a, b):
        seen = self.after.get(a)
        if not seen:
            return self.word(b)
        scale = self.firsts[a] / (self.firsts[a] + 1) if a in self.common or min(seen.values()) > 5 else 1

        def own(w):
            return scale * seen[w] / self.firsts[a] * (self.pair_kept[seen[w] - 1] if seen[w] <= 5 else 1)

        if b in seen:
            return own(b)
        return (1 - sum(map(own, seen))) / (1 - sum(map(self.word, seen))) * self.word(b)

    def score(self, text):
        row = tokens_of(text)
        return sum(math.log10(self.pair(a, b)) for a, b in zip(["", *row], row))

    def base(self, text):
        return sum(math.log10((self.words[t] + 0.5) / (self.n + 0.5 * (len(self.words) + 1))) for t in tokens_of(text))


def check(rows, docs):
    """Rows of the operator against the plain model of the same documents."""
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in docs}
    model = Plain([t for i, t in docs if not held[i]])
    got = sorted(((r.doc_id or -1, r.n_tokens, r.n_known, r.held_out, r.train_tokens) for r in rows))
    assert got == sorted(
        (i or -1, len(tokens_of(t)), sum(model.words[w] > 0 for w in tokens_of(t)), held[i], model.n) for i, t in docs
    )
    want = sorted((i or -1, len(tokens_of(t)), model.base(t), model.score(t)) for i, t in docs)
    have = sorted((r.doc_id or -1, r.n_tokens, r.base_score, r.score) for r in rows)
    assert np.allclose(np.array(have, dtype=float), np.array(want, dtype=float), rtol=1e-9, atol=1e-9)
    return model


def scored(spark, docs):
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id bigint, text string, train int, id string").repartition(4)
    return lm.score_documents(frame, toxicity.remainder("doc_id") == 1).collect()


def drawn(seed, count, words=400):
    rnd = random.Random(seed)
    vocabulary = [f"W{int(words * rnd.random() ** 3)}" for _ in range(words)] + ["é", "a,b", "\x00", "日本"]
    return [(i, " \n".join(rnd.choice(vocabulary) for _ in range(rnd.randint(0, 40)))) for i in range(count)]


@pytest.mark.parametrize("common", [2, 400, 10**6])
def test_equals_the_plain_model(spark, monkeypatch, common):
    """With few, some and all words common; many small shards and parts."""
    monkeypatch.setattr(lm, "COMMON", common)
    monkeypatch.setattr(lm, "SHARD_CHARS", 900)
    docs = [*drawn(1, 250), (900, "the same text " * 30), (901, "the same text " * 30), (902, "of nothing known here")]
    model = check(scored(spark, docs), docs)
    for first in ["", "w0", "w1", "w17", "same", "nowhere"]:
        assert math.isclose(sum(model.pair(first, w) for w in [*model.words, "unknown!"]), 1, rel_tol=1e-9)


def test_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows = QUERIES["op13_lm_scores"](spark, SF).collect()
    check(rows, docs)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_hard_rows(spark, hard_docs):
    docs = [(r.doc_id, r.text) for r in hard_docs.collect()]
    renamed = hard_docs.withColumnsRenamed({"_hash": "shard", "row_number": "place"})
    check(lm.score_documents(renamed, toxicity.remainder("doc_id") == 1).collect(), docs)
    assert lm.score_documents(hard_docs.where("false"), F.lit(False)).count() == 0
    alone = lm.score_documents(hard_docs, F.lit(True)).collect()
    assert all(r.held_out and r.train_tokens == 0 and r.base_score == 0 and r.score == 0 for r in alone)


def test_counts_without_room_for_good_turing():
    assert (lm.discounts([0, 0, 0, 0, 0, 0]) < 1).all() and (lm.discounts([1, 50, 0, 0, 0, 3]) > 0).all()
    katz = lm.discounts([1000, 300, 130, 75, 48, 34])
    rest = 6 * 34 / 1000
    assert np.allclose(katz[0], (2 * 300 / 1000 - rest) / (1 - rest)) and (np.diff(katz) > 0).all()
