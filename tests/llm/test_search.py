"""Ranked search against scores computed one document at a time."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from accountwatch.llm import search
from accountwatch.llm.words import TERMS, words

_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return _TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_ranking(docs, items, k):
    cut = [(d, Counter(terms_of(t)), len(terms_of(t))) for d, t in docs]
    held = [x for x in cut if x[2]]
    total = sum(n for _, _, n in held)
    df = Counter(term for _, c, _ in held for term in c)
    out = []
    for item, text in items:
        if text is None:
            continue
        found = []
        for doc, c, n in held:
            m = 75 + 25 * n * len(held) // total
            score = sum(
                math.floor(1000 * math.log((2 * len(held) + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t in terms_of(text) if t in c
            )
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, row[3], -row[0]) for rank, row in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def ranked(spark, docs, items, k=5):
    frame = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id bigint, text string, score int, id string").repartition(3)
    asked = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, query string")
    rows = search.rank_documents(frame, asked, k)
    assert rows.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, rows.collect()), key=str)


def drawn(seed, count, vocabulary):
    rnd = random.Random(seed)
    return [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(0, 30))) for _ in range(count)]


@pytest.mark.parametrize("docs_at_once", [1, 7, 1024])
def test_equals_scores_one_by_one(spark, monkeypatch, docs_at_once):
    monkeypatch.setattr(search, "BLOCK_DOCS", docs_at_once)
    vocabulary = [f"w{i}" for i in range(12)] + ["É", "Word's", "9", "-"]
    docs = list(enumerate(drawn(1, 120, vocabulary))) + [(500, "w1 w2 w3"), (7, "w1 w2 w3"), (400, "w1 w2 w3"), (None, "w1 w2 w3")]
    items = list(enumerate(drawn(2, 12, vocabulary))) + [(50, " ".join(f"w{i}" for i in range(12)) + " w1 w1 nowhere")]
    assert ranked(spark, docs, items) == plain_ranking(docs, items, 5)


def test_more_terms_than_a_word_has_bits(spark):
    vocabulary = [f"t{i}" for i in range(200)]
    docs = list(enumerate(drawn(3, 60, vocabulary)))
    items = [(0, " ".join(vocabulary)), (1, " ".join(vocabulary[::2]) + " T1 t1")]
    assert ranked(spark, docs, items) == plain_ranking(docs, items, 5)


def test_hard_rows(spark, hard_docs, hard_texts):
    docs = [(r.doc_id, r.text) for r in hard_docs.collect()]
    items = [(1, "the cat sat"), (1, "the cat sat"), (2, None), (None, "THE CAT long"), (4, ""), (5, "x" * 3000), (6, hard_texts[-1])]
    assert ranked(spark, docs, items) == plain_ranking(docs, items, 5)
    assert ranked(spark, docs, []) == [] and ranked(spark, [], items) == []


def test_blocks_of_items_change_nothing(spark, monkeypatch):
    docs, items = list(enumerate(drawn(4, 40, list("abcdefgh")))), list(enumerate(drawn(5, 9, list("abcdefgh"))))
    whole = ranked(spark, docs, items)
    monkeypatch.setattr(search, "ITEM_CHARS", 40)
    assert ranked(spark, docs, items) == whole


def test_masks_that_cannot_reach_the_best_are_not_scored():
    n = np.full(400, 10)
    strong, weak = np.array([0, 1], "<i4").tobytes(), np.array([1], "<i4").tobytes()
    held = [strong if i % 4 == 0 else weak for i in range(400)]
    block = search.Block(list(range(400)), n, held, [np.ones(len(h) // 4, "<i4").tobytes() for h in held], 2, 400, 4000)
    scored = []
    block.scores = lambda rows, weights, docs, whole=block.scores: scored.extend(docs) or whole(rows, weights, docs)
    best = search.best_of_block(block, np.array([0, 1]), np.array([1000, 10]), [], 20)
    assert len(best) == 20 and len(scored) == 100 and all(doc % 4 == 0 for _, doc in best)


def test_terms_of_bytes_equal_the_pattern(hard_texts):
    for text in [*hard_texts, "A-b_C\x7f9ÀÉİx\x00y"]:
        assert [w.decode() for w in words(text, TERMS)] == terms_of(text)
