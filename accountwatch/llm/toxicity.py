"""Toxic passages by maximum-scoring segment search.

A word's score is its log-odds between toxic and other texts under a Dirichlet prior
drawn from both; words without significant odds cost a little each. One linear scan
finds all maximal-scoring segments of a text (Ruzzo and Tompa), and extreme-value
statistics (Karlin and Altschul) say how unlikely they are in a text of that length:
``-ln P`` of the best number of segments together. A logistic curve fitted on labelled
texts that the words were not learnt from turns that into a probability.

Defined results: a null or empty text has no words and the score of a text without
toxic words; words are runs of letters and digits of the lower-cased whole text;
repeated rows score alike; an empty table gives an empty result. Rows with a null label
or id do not teach; of several labels of one id the highest counts. Without labels of
both kinds all texts score 0. Other columns are carried unless they have a result's name.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountwatch.llm.text import unused, whole

#: Labelled rows of each class that teach, at most, drawn by a hash of the id; bounds the model's input.
TEACHING_ROWS = 10_000
#: Words of the model, at most; the most significant ones.
MODEL_WORDS = 50_000
#: A toxic word is so much likelier in toxic texts, and this many standard errors off zero.
LEAST_ODDS = math.log(8.0)
LEAST_Z = 3.0
#: A word of the model is in so many toxic teaching texts, and in more of them than of the others. This decides the
#: model where toxic labels are rare: words of one or two texts pass the odds by chance.
LEAST_TEXTS = 3
#: What the prior weighs: so much for any word, and so much in all by the words' share of both kinds.
LEAST_PRIOR = 0.5
PRIOR = 10.0
#: Lengths of the beginnings of words that are tokens too.
BEGINNINGS = (4, 5, 6, 7)
#: Words whose score a worker remembers.
REMEMBERED = 300_000
#: Segments of a text that count together, at most so many: the best ones.
SEGMENTS_TOGETHER = 64

_WORD = re.compile(r"[^\W_]+")
PASSAGES = "array<struct<begin:int,end:int,score:double>>"


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def tokens_of(word: str) -> list[str]:
    """The word and its beginnings, which stand for its inflections and compounds."""
    return [word, *(word[:k] + "*" for k in BEGINNINGS if len(word) > k)]


@dataclass
class Model:
    scores: dict[str, float] = field(default_factory=dict)
    cost: float = 0.01
    decay: float = 1.0
    scale: float = 1.0
    intercept: float = -40.0
    slope: float = 0.0
    seen: dict[str, float] = field(default_factory=dict, repr=False)

    def passages(self, words: list[str]) -> list[tuple[int, int, float]]:
        new = set(words).difference(self.seen)
        if len(self.seen) + len(new) > REMEMBERED:
            self.seen.clear()
            new = set(words)
        for word in new:
            self.seen[word] = max((self.scores.get(t, 0.0) for t in tokens_of(word)), default=0.0)
        hits = [(i, score) for i, score in enumerate(map(self.seen.__getitem__, words)) if score > 0]
        return maximal_segments(hits, self.cost)

    def surprise(self, passages: list[tuple[int, int, float]], n: int) -> float:
        """``-ln P`` of the best segments together in a text of ``n`` words, 0 for none."""
        best = total = 0.0
        ranked = sorted((score for _, _, score in passages), reverse=True)[:SEGMENTS_TOGETHER]
        for r, score in enumerate(ranked, 1):
            total += self.decay * score - math.log(max(self.scale * n, 1.0))
            if total <= 0:
                break
            best = max(best, total - (r - 1) * math.log(max(total, 1.0)) + math.lgamma(r + 1) + math.lgamma(r))
        return best

    def probability(self, surprise: float) -> float:
        return 1.0 / (1.0 + math.exp(-max(-700.0, min(700.0, self.intercept + self.slope * surprise))))


def maximal_segments(hits: list[tuple[int, float]], cost: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments, as begin, end (exclusive) and score.

    ``hits`` are the places and scores above zero, in order; all other places cost
    ``cost``. Each segment is known by the running sums before and after it.
    """
    found: list[list[float]] = []
    gained = 0.0
    for done, (at, score) in enumerate(hits):
        before = gained - cost * (at - done)
        gained += score
        begin, after = at, before + score
        # Join with the last segment that began lower, if this one ends higher than it did.
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= before:
                j -= 1
            if j < 0 or found[j][3] >= after:
                found.append([begin, at + 1, before, after])
                break
            begin, before = found[j][0], found[j][2]
            del found[j:]
    return [(int(b), int(e), after - before) for b, e, before, after in found]


def learn_words(toxic: Counter[str], other: Counter[str]) -> Model:
    """Scores from the number of toxic and other texts that hold each word."""
    n1, n0 = sum(toxic.values()), sum(other.values())
    if not n1 or not n0:
        return Model()
    ranked = []
    for word, y1 in toxic.items():
        y0 = other.get(word, 0)
        if y1 < LEAST_TEXTS or y1 <= y0:
            continue
        prior = LEAST_PRIOR + PRIOR * (y1 + y0) / (n1 + n0)
        odds = math.log((y1 + prior) / (n1 + PRIOR - y1)) - math.log((y0 + prior) / (n0 + PRIOR - y0))
        z = odds / math.sqrt(1 / (y1 + prior) + 1 / (y0 + prior))
        if odds >= LEAST_ODDS and z >= LEAST_Z:
            ranked.append((z, word, odds))
    scores = {word: odds for _, word, odds in sorted(ranked, reverse=True)[:MODEL_WORDS]}
    share1 = sum(toxic[w] for w in scores) / n1
    share0 = sum(other.get(w, 0) for w in scores) / n0
    model = Model(scores, cost=max(0.005, math.log((1 - share0) / (1 - min(share1, 0.5)))))
    model.decay = _decay([(other.get(w, 0) + 0.5, s) for w, s in scores.items()], n0, model.cost)
    return model


def _decay(weighted: list[tuple[float, float]], total: int, cost: float) -> float:
    """The positive root of the mean of exp(x * score) being one, over words of other texts."""
    shares = np.array([w for w, _ in weighted]) / total
    scores = np.array([s for _, s in weighted])

    def excess(x: float) -> float:
        return float(shares @ np.exp(x * scores) + (1 - shares.sum()) * math.exp(-x * cost) - 1)

    low, high = 0.0, 4.0
    if not weighted or excess(1e-3) >= 0:
        return 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return low


def fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Intercept and slope of a logistic curve with a slight pull towards flat."""
    weights = np.zeros(2)
    design = np.stack([np.ones_like(x), x / max(x.max(initial=0.0), 1.0)], axis=1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -500, 500)))
        gradient = design.T @ (p - y) + 1e-2 * weights
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        weights -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(weights[0]), float(weights[1] / max(x.max(initial=0.0), 1.0))


def remainder(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", rows: int = TEACHING_ROWS) -> Model:
    """The model of labelled texts whose remainder is not 0.

    Remainders 1 to 3 teach words, 4 the curve. A bounded number of ids goes to the
    tasks; texts are not shuffled, and only counts and figures come back.
    """
    known = (
        labels.select(F.col(id_col).alias("id"), F.col("toxic").cast("int").alias("toxic"))
        .dropna()
        .groupBy("id")
        .agg(F.max("toxic").alias("toxic"))
        .where(F.crc32(F.col("id").cast("string").cast("binary")) % 5 != 0)
    )
    order = F.xxhash64("id")
    taught = known.where("toxic = 1").orderBy(order, "id").limit(rows).union(known.where("toxic = 0").orderBy(order, "id").limit(rows))
    rows_in = docs.select(F.col(id_col).alias("id"), whole(text).alias("text")).join(F.broadcast(taught), "id")
    teaching = rows_in.select("toxic", (F.crc32(F.col("id").cast("string").cast("binary")) % 5 == 4).alias("curve"), "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[int, Counter[str]] = {0: Counter(), 1: Counter()}
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts[min(max(toxic, 0), 1)].update(set(chain.from_iterable(map(tokens_of, set(words_of(text))))))
            for toxic, found in counts.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([toxic] * len(found), pa.int32()), pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())],
                    names=["toxic", "word", "n"],
                )

    counted = teaching.where(~F.col("curve")).select("toxic", "text").mapInArrow(count, "toxic int, word string, n bigint")
    by_word = counted.groupBy("word").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("y1"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("y0")
    )
    by_word = by_word.checkpoint()
    totals = by_word.agg(F.sum("y1"), F.sum("y0")).first()
    # What learn_words leaves out for its few texts stays where it is.
    likely = by_word.where((F.col("y1") >= LEAST_TEXTS) & (F.col("y1") > F.col("y0"))).select("word", "y1", "y0").toPandas()
    toxic, other = Counter(dict(zip(likely.word, likely.y1, strict=True))), Counter(dict(zip(likely.word, likely.y0, strict=True)))
    # One entry each stands for all words that stayed behind.
    toxic[""] += (totals[0] or 0) - sum(toxic.values())
    other[""] += (totals[1] or 0) - sum(other.values())
    model = learn_words(toxic, other)
    model.scores.pop("", None)

    def figure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                tokens = words_of(text)
                passages = model.passages(tokens)
                out.append((len(tokens), len(passages), [score for _, _, score in passages]))
            n, segments, scores = (list(c) for c in zip(*out, strict=True)) if out else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(segments, pa.int64()), pa.array(scores, pa.list_(pa.float64()))],
                names=["toxic", "n", "segments", "scores"],
            )

    curve = teaching.where("curve").select("toxic", "text").mapInArrow(figure, "toxic int, n bigint, segments bigint, scores array<double>").toPandas()
    if curve.toxic.nunique() < 2:
        return Model()
    clean = curve[curve.toxic == 0]
    # Segments of other texts per word fix the scale: their expected number above a score s is scale * n * exp(-decay * s).
    least = min(model.scores.values(), default=1.0)
    model.scale = max(clean.segments.sum(), 1) * math.exp(model.decay * least) / max(clean.n.sum(), 1)
    x = np.array([model.surprise([(0, 0, s) for s in row.scores], row.n) for row in curve.itertuples()])
    model.intercept, model.slope = fit_curve(x, curve.toxic.to_numpy().astype(float))
    return model


def score_documents(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score``, ``predicted`` and ``passages`` (word ranges with their scores). One pass, no shuffle."""
    hidden = unused(docs, "toxicity_found")

    @F.pandas_udf(f"struct<score:double,passages:{PASSAGES}>")
    def judged(texts):
        import pandas as pd

        scores, spans = [], []
        for value in texts:
            tokens = words_of(value)
            passages = model.passages(tokens)
            scores.append(model.probability(model.surprise(passages, len(tokens))))
            spans.append([{"begin": b, "end": e, "score": s} for b, e, s in passages])
        return pd.DataFrame({"score": scores, "passages": spans})

    kept = [c for c in docs.columns if c.lower() not in ("score", "predicted", "passages")]
    return (
        docs.withColumn(hidden, judged(whole(text)))
        .select(*kept, F.col(hidden)["score"].alias("score"), F.col(hidden)["passages"].alias("passages"))
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    )


def drop_toxic(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with their own columns and nothing else."""

    @F.pandas_udf("double")
    def scored(texts):
        import pandas as pd

        tokens = (words_of(value) for value in texts)
        return pd.Series([model.probability(model.surprise(model.passages(t), len(t))) for t in tokens], dtype="float64")

    return docs.where(scored(whole(text)) < 0.5)
