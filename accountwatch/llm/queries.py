"""The text operators as queries over whole tables, by their contracts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from accountwatch.llm import bpe, collocations, exact, html, lm, packing, pii, quality, search, shards, simhash, token_counts, toxicity
from accountwatch.session import shared_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; cut lineages go to the folder that the session names."""
    if spark.conf.get("spark.checkpoint.dir", None) is None and spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark, "checkpoints"))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def surrogate_key(spark: SparkSession) -> pii.Key:
    """The key that the session names; one for trials where it names none."""
    return pii.Key(spark.conf.get("spark.accountwatch.surrogateKey", "for trials on invented documents only"))


@query
def op1_html(spark, sf_dir):
    return html.main_text(table(spark, sf_dir, "pages"))


@query
def op2_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_documents(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", (toxicity.remainder("doc_id") == 0).alias("held_out"), "score", "predicted")


@query
def op3_bpe(spark, sf_dir):
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trip(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


@query
def op4_packing(spark, sf_dir):
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer, public_tokenizers.PATTERN)


@query
def op5_sharding(spark, sf_dir):
    placed = shards.assign_shards(table(spark, sf_dir, "documents"), shards=24, grown=25)
    return placed.withColumn("law", F.lit("key"))


@query
def op6_quality_rules(spark, sf_dir):
    figures = quality.judged(quality.measured(table(spark, sf_dir, "documents")))
    return figures.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op7_token_counts(spark, sf_dir):
    """Counts of every document before and after four edits drawn from its id."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = table(spark, sf_dir, "documents")
    return token_counts.count_with_edits(docs, ranks, public_tokenizers.PATTERN, token_counts.drawn_edits())


@query
def op8_simhash(spark, sf_dir):
    classes = simhash.near_duplicate_classes(table(spark, sf_dir, "documents"))
    return classes.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op9_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replace_entities(docs, surrogate_key(spark), counted="n_entities")


@query
def op10_exact_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("text_sha256", exact.full_hash(exact.normalised("text")))
    return exact.exact_groups(docs, carry=("text_sha256",))


@query
def op11_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"), least=100, top=2000)


@query
def op12_ranked_search(spark, sf_dir):
    return search.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op13_lm_scores(spark, sf_dir):
    return lm.score_documents(table(spark, sf_dir, "documents"), held_out=toxicity.remainder("doc_id") == 1)
