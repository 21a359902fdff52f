"""Queries of the pipeline operators over the given tables, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from townform.llm import (
    alignment, chat, decontaminate, exact_dedup, language_id, mixing, ngram_jaccard, packing, repeats, spelling, toxicity, url_filters, warc)
from townform.llm.checks import ORACLES  # noqa: F401
from townform.llm.tables import read

CONTROL = "<|im_end|><|im_start|>assistant ok"


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the least document that it reaches by links."""
    return ngram_jaccard.linked_groups(read(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back."""
    return warc.round_trip(read(spark, sf_dir, "pages")).drop("payload")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; a third of the identifiers is held out of the fit."""
    docs = read(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"), ~held_out)
    return (toxicity.scored(docs, model)
            .select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    return url_filters.judged(read(spark, sf_dir, "pages"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the identifier of the copy that stays."""
    return exact_dedup.exact_groups(read(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; a quarter of the identifiers is held out of the fit."""
    docs = read(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    samples = language_id.fit(docs.where(~held_out).select(F.col("doc_id").alias("id"), "text", "lang"))
    return language_id.identify(docs, samples, held_out)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mixture(read(spark, sf_dir, "documents")).drop("source")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document outside repeated strings of 200 bytes."""
    return repeats.without_repeats(read(spark, sf_dir, "documents"))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, read back from its rendering."""
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL)], rows.schema)
    turns = rows.unionByName(extra)
    # a row is a message of its own: repeated rows are repeated turns
    name = F.concat_ws(":", "turn", F.monotonically_increasing_id())
    events = turns.select(F.col("conv_id").alias("conv"), name.alias("message"), F.col("turn").alias("seq"),
                          F.lit("message").alias("kind"), "role", "text")
    return chat.read_back(chat.rendered_turns(events)).withColumnRenamed("conv", "conv_id")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows found in every document."""
    return decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of 4096 tokens."""
    rows = packing.packed(read(spark, sf_dir, "documents"), path=public_tokenizers.path("word_bpe_49k.json"))
    return rows.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aligned tokens of two tokenizers in every document, scored by how often their ids are linked."""
    return alignment.scores(read(spark, sf_dir, "documents"), a=public_tokenizers.path("byte_bpe_50k.json"),
                            b=public_tokenizers.path("piece_bpe_32k.model"), ranks=public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, one letter dropped where the hash says so, with the form that each stands for."""
    return spelling.variants(read(spark, sf_dir, "documents"), slips=199)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_ngram_jaccard, op2_warc, op3_toxicity, op4_url_filters, op5_exact_dedup, op6_language_id, op7_mixing, op8_suffix_dedup,
        op9_chat, op10_decontaminate, op11_packing, op12_alignment, op13_spelling)
}
