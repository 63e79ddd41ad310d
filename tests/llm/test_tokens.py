"""Encoding, packing and counting against the libraries on whole texts."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from accountwatch.llm import bpe, packing, token_counts
from accountwatch.llm.chunks import ChunkCounter
from accountwatch.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
RANKS = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def own():
    return bpe.worker_bpe(RANKS, P.PATTERN)


def drawn_texts(seed, count, most=200):
    rnd = random.Random(seed)
    return ["".join(rnd.choice("abcthe \n\t'sré1.,  日") for _ in range(rnd.randint(0, most))) for _ in range(count)]


def test_ids_and_round_trip(own, library, hard_texts):
    texts = [t or "" for t in hard_texts] + drawn_texts(1, 2000)
    for text, ids in zip(texts, own.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
        assert b"".join(own.decode(ids)) == text.encode()


@pytest.mark.parametrize("many", [1, 10**9])
def test_both_ways_to_merge(monkeypatch, library, many):
    monkeypatch.setattr(bpe, "MANY", many)
    monkeypatch.setattr(bpe, "PART_BYTES", 500)
    fresh = bpe.Bpe(bpe.read_ranks(RANKS), P.PATTERN)
    texts = [*drawn_texts(2, 500), "ahahahah aaaa", "x" * 1000]
    assert [np.frombuffer(i, "<u4").tolist() for i in fresh.encode(texts)] == [library.encode_ordinary(t) for t in texts]


def test_op3_whole_table(spark, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op3_bpe"](spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = np.array(library.encode_ordinary(docs[r.doc_id]), "<u4").tobytes()
        assert (r.n_tokens, r.ids_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


def check_packing(rows, ids_of):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(ids_of)
    for doc, ids in ids_of.items():
        at = 0
        for r in sorted(pieces[doc], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    return sum(len(i) for i in ids_of.values()), len(sequences)


def test_op4_whole_table(spark):
    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    ids_of = {r.doc_id: np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4") for r in docs}
    tokens, sequences = check_packing(QUERIES["op4_packing"](spark, SF).collect(), ids_of)
    assert tokens / (1024 * sequences) > 0.97


def test_packing_encodes_as_the_file_says(hard_texts):
    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    encode = packing.worker_encoder(P.path("byte_bpe_50k.json"), P.PATTERN)
    for text in [t or "" for t in hard_texts] + drawn_texts(5, 2000) + ["<|endoftext|>", "a <|endoftext|> b", "<|endoftext|><|endoftext|>x", " x<|endoftext|>", "<|endoftext|", "<|ENDOFTEXT|>", "a" * 50_000, " \n" * 50_000, "é日" * 5000]:
        assert encode(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_packing_of_hard_rows(spark, hard_docs):
    out = packing.pack(hard_docs, P.path("byte_bpe_50k.json"), P.PATTERN)
    rows = out.collect()
    assert sum(r.length for r in rows if r.start == 0) and {r.doc_id for r in rows} == {r.doc_id for r in hard_docs.collect()}
    assert packing.pack(hard_docs.where("false"), P.path("byte_bpe_50k.json"), P.PATTERN).count() == 0


def test_windows_are_near_equal_and_never_too_full():
    rnd = random.Random(4)
    for _ in range(20):
        sizes = [rnd.randint(1, 1023) if rnd.random() < 0.5 else rnd.randint(1, 64) for _ in range(rnd.randint(0, 300))]
        window = packing.windows(sizes)
        sums = np.bincount(window, weights=sizes) if sizes else np.zeros(1)
        assert sums.max() <= 1024 and len(window) == len(sizes)
    sums = np.bincount(packing.partition(list(range(1, 400)), 16), weights=list(range(1, 400)))
    assert np.ptp(sums) < 0.01 * sums.mean()


def test_edits_equal_a_full_count(own, library):
    rnd = random.Random(7)
    for text in ["", "a", *drawn_texts(3, 40, 3000)]:
        counted = token_counts.CountedText(text, own)
        for new in drawn_texts(rnd.random(), 10, 60) + [" " * 5, "word " * 5000]:
            begin = rnd.randint(0, len(counted.text) + 2)
            counted.edit(begin, begin + rnd.choice([0, 1, 5, 800]), new)
            assert counted.n_tokens == len(library.encode_ordinary(counted.text))
            assert counted.tree.chars[1] == len(counted.text)


def test_edits_leave_the_rest_alone(own):
    counted = token_counts.CountedText("some words and more " * 5000, own)
    counted.edit(50_000, 50_003, "other")
    assert counted.recoded < counted.n_tokens / 100


def test_counts_equal_the_library(hard_texts, library):
    fresh = bpe.Bpe(bpe.read_ranks(RANKS), P.PATTERN)
    texts = [t or "" for t in hard_texts] + drawn_texts(8, 1000)
    for size in (1, 24):
        for text, (chars, tokens) in zip(texts, fresh.counter.runs(texts, size), strict=True):
            assert (sum(chars), sum(tokens)) == (len(text), len(library.encode_ordinary(text)))


@pytest.mark.parametrize("part", [1, 100, 1 << 21])
def test_words_merged_side_by_side_have_as_many_ids(monkeypatch, own, part):
    monkeypatch.setattr(bpe, "PART_BYTES", part)
    rnd = random.Random(9)
    words = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 90))).encode() for letters in ("ah", "the", "aeinrst", "aé日😀") for _ in range(150)]
    words += [b"", b"a", b"aaaa" * 16, b"aaaa" * 16 + b"a", b" internationalization"]
    assert own.replay.count(words) == [len(ids) for word in words for ids in own.replay.encode([word])]
    assert own.replay.count([]) == []


@pytest.mark.parametrize("most", [0, 2000, 32_000_000])
def test_counts_with_caches_that_forget(most, library):
    counter = ChunkCounter(P.PATTERN, lambda words: [len(library.encode_ordinary(word)) for word in words], most)
    for seed in range(20):
        texts = drawn_texts(seed, 30)
        assert [sum(tokens) for _, tokens in counter.runs(texts, 24)] == [len(library.encode_ordinary(t)) for t in texts]


def test_edits_of_many_texts_count_their_words_together(library):
    fresh = bpe.Bpe(bpe.read_ranks(RANKS), P.PATTERN)
    texts = [token_counts.CountedText(text, fresh) for text in drawn_texts(10, 200)]
    calls, count = [], fresh.counter.count_words
    fresh.counter.count_words = lambda words: calls.append(len(words)) or count(words)
    token_counts.edit_together(fresh, [(text, 3, 5, f" new{k}word") for k, text in enumerate(texts)])
    assert len(calls) == 1
    assert [text.n_tokens for text in texts] == [len(library.encode_ordinary(text.text)) for text in texts]
    assert [sum(text.tree.tokens[text.tree.size :]) for text in texts] == [text.n_tokens for text in texts]


def test_op7_whole_table(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    scripts = {r.doc_id: r for r in docs.select("doc_id", "text", token_counts.drawn_edits().alias("e")).collect()}
    rows = QUERIES["op7_token_counts"](spark, SF).collect()
    assert len(rows) == len(scripts)
    for r in rows:
        text = scripts[r.doc_id].text or ""
        assert r.n_tokens == len(library.encode_ordinary(text))
        for e in scripts[r.doc_id].e:
            text = text[: e.begin] + e.text + text[max(e.begin, e.end) :]
        assert (r.n_tokens_edited, r.text_crc32) == (len(library.encode_ordinary(text)), zlib.crc32(text.encode()))


def test_hard_rows_are_counted(spark, hard_docs, library):
    edits = "array(named_struct('begin', 1, 'end', cast(null as int), 'text', cast(null as string)), null)"
    from pyspark.sql import functions as F

    rows = token_counts.count_with_edits(hard_docs, RANKS, P.PATTERN, F.expr(edits)).collect()
    # The first character stays: a character may be several tokens.
    left = [len(library.encode_ordinary((r.text or "")[:1])) for r in hard_docs.collect()]
    assert sorted(r.n_tokens_edited for r in rows) == sorted(left) and all(r.n_edits == 1 for r in rows)
    assert token_counts.count_with_edits(hard_docs.where("false"), RANKS, P.PATTERN, F.expr(edits)).count() == 0
