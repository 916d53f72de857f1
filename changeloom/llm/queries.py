"""Registered queries of this subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    ann_postings,
    blas_search,
    fim_index,
    language_crf,
    noisy_channel,
    ordinal_quality,
    phrase_dedup,
    piece_viterbi,
    signature_join,
    source_mix,
    token_counts,
    topk_histogram,
    warc,
)
from .common import table

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    _QUERIES[build.__name__] = build
    return build


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle() -> dict[str, str]:
    return {
        "op5_warc": warc.ORACLE,
        "op6_topk_histogram": topk_histogram.ORACLE,
        "op8_source_mix": source_mix.ORACLE,
        "op12_blas_search": blas_search.ORACLE,
        "op13_fim_index": fim_index.ORACLE,
    }


@query
def op9_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_crf.fit(docs)
    rows = docs.select("doc_id", "text")
    return language_crf.identify(rows, model).select(
        "doc_id", language_crf.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )


@query
def op4_signature_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signature_join.similarity_components(table(spark, sf_dir, "documents"), width=4, percent=85).select(
        "doc_id", "n_shingles", "component_id"
    )


@query
def op3_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_dedup.removals(table(spark, sf_dir, "documents"), length=50)


@query
def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.mix(table(spark, sf_dir, "documents"), weights=(5, 2, 1), most=3.0, seed=7)


@query
def op7_piece_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = piece_viterbi.load(public_tokenizers.path("piece_bpe_32k.model"))
    ids = piece_viterbi.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), pieces)
    return piece_viterbi.decode(ids, pieces).select(
        "doc_id", "n_pieces", "n_fallback", "ids", F.col("decoded").eqNullSafe(F.coalesce("text", F.lit(""))).alias("comes_back")
    )


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), path).withColumn("over_limit", F.col("n_tokens") > 4096)


@query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op2_ann_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_postings.nearest(table(spark, sf_dir, "embeddings"), every=100, k=10)


@query
def op6_topk_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_histogram.top_k(table(spark, sf_dir, "embeddings"), every=50, k=5, scale=256.0)


@query
def op10_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = ordinal_quality.fit(docs, table(spark, sf_dir, "labels"))
    return ordinal_quality.rate(docs.select("doc_id", "text"), model).select(
        "doc_id", "expected_grade", "p_acceptable", "p_good", "grade", (F.col("p_good") >= 0.5).alias("selected")
    )


@query
def op11_noisy_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = noisy_channel.fit(docs, table(spark, sf_dir, "labels"))
    return noisy_channel.score(docs.select("doc_id", "text"), model).select(
        "doc_id",
        noisy_channel.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
    )


@query
def op12_blas_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blas_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


@query
def op13_fim_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fim_index.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"), seed=42, rate=50, spm=80)
    return cut.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fim_index.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
