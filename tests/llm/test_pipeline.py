"""The whole pipeline against a plain chain in Python, and names that clash."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from test_copies import bare, components, plain_fingerprint
from tokenizers import Tokenizer

import corpus_pipeline
from accountwatch.llm import packing, pii, shards, toxicity
from accountwatch.llm.queries import QUERIES, surrogate_key

SF = "/root/testdata/sf0.01"


def test_run_equals_a_plain_chain(spark):
    """Which documents stay, and every id of every piece."""
    predicted = {r.doc_id: r.predicted for r in QUERIES["op2_toxicity"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect() if not predicted[r.doc_id]}
    assert 0 < len(texts) < docs.count()

    equal = defaultdict(list)
    for doc, text in texts.items():
        equal[bare(text)].append((-len(text), doc))
    single = {min(group)[1] for group in equal.values()}
    assert len(single) < len(texts)

    prints = {doc: plain_fingerprint(texts[doc]) for doc in single}
    roots = components(set(prints.values()))
    near = defaultdict(list)
    for doc, fingerprint in prints.items():
        near[roots[fingerprint]].append(doc)
    kept = {min(group) for group in near.values()}

    rows = spark.createDataFrame([(doc, texts[doc]) for doc in sorted(kept)], "doc_id bigint, text string")
    written = {r.doc_id: r.text for r in pii.replace_entities(rows, surrogate_key(spark)).collect()}
    assert any(written[doc] != texts[doc] for doc in kept)

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {doc: [*tokenizer.encode(text, add_special_tokens=False).ids, 0] for doc, text in written.items()}
    places, pieces = defaultdict(list), defaultdict(list)
    for r in corpus_pipeline.run(spark, SF).collect():
        part = np.array(ids[r.doc_id][r.start : r.start + r.length], dtype="<u4")
        assert (len(part), zlib.crc32(part.tobytes())) == (r.length, r.ids_crc32) and r.doc_tokens == len(ids[r.doc_id])
        pieces[r.doc_id].append((r.start, r.length))
        places[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == kept
    for doc, found in pieces.items():
        assert gapless(found) == len(ids[doc])
    assert all(gapless(found) <= 1024 for found in places.values())


def gapless(parts):
    end = 0
    for begin, length in sorted(parts):
        assert begin == end
        end += length
    return end


def test_an_id_named_like_a_result(spark, hard_docs):
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    for name, run in (
        ("shard", lambda docs: shards.assign_shards(docs, 3, 4, key="shard")),
        ("length", lambda docs: packing.pack(docs, tokenizer, public_tokenizers.PATTERN, "length")),
    ):
        out = run(hard_docs.withColumnRenamed("doc_id", name))
        assert out.columns[0] == name and f"{name}_" in out.columns and len(set(out.columns)) == len(out.columns)
        assert {r[name] for r in out.collect()} == {r.doc_id for r in hard_docs.collect()}


def test_words_of_few_toxic_texts_do_not_teach():
    toxic = {"rare": toxicity.LEAST_TEXTS - 1, "vile": 40, "": 1000}
    model = toxicity.learn_words(toxic, {"": 100_000, "vile": 1})
    assert set(model.scores) - {""} == {"vile"}


def test_extra_columns_pass_the_filters(spark, hard_docs):
    docs = hard_docs.withColumn("passages", F.lit(1)).withColumn("keep_id", F.lit(2))
    assert toxicity.drop_toxic(docs, toxicity.Model()).columns == docs.columns
