"""Registered queries ``opN_<name>``: each applies one operator, with its
production parameters, to the whole of its table and returns the full result."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import neardup, toxicity, wordlm
from .embeddings import near_duplicates
from .fingerprints import neighbour_fingerprints
from .html import extract_main_text
from .language import fit, learnable, predict
from .lines import fuzzy_lines
from .mixing import mix, mix_sql
from .negatives import hard_negatives, negatives_sql
from .packing import pack_documents
from .spelling import spelling_variants
from .tokens import count_tokens

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def tokenizer_file(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    usable, held_out = learnable()
    return predict(docs.withColumn("held_out", held_out), fit(docs, usable)) \
        .select("doc_id", "held_out", "lang_pred", "score")


@query
def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


ORACLE["op3_source_mixing"] = mix_sql()


@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_lines(table(spark, sf_dir, "documents")).drop("row")


@query
def op5_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: documents labelled of good quality.  Background: all documents."""
    good = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return wordlm.score(table(spark, sf_dir, "documents").select("doc_id", "text"), good)


@query
def op6_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "group_id", "kept")


@query
def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_fingerprints(table(spark, sf_dir, "documents"))


@query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"), "text")
    return (count_tokens(docs, tokenizer_file("byte_bpe_50k.json")).drop("text")
            .withColumn("over_limit", F.col("n_tokens") > 1024))


@query
def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_main_text(pages).drop("html").withColumn("n_chars", F.length("text").cast("bigint"))


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


@query
def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents").select("doc_id", "text"), toxicity.held_out()
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held)
    return toxicity.score(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"))


ORACLE["op13_hard_negatives"] = negatives_sql()
