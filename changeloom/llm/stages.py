"""The stages of the corpus pipeline. Each takes ``(spark, docs, sf_dir)`` and returns documents.

The first ones return the columns of ``docs``. A row without id stays in every stage that goes by
ids; it is in no group and repeats nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.workspace import written
from . import language_crf, phrase_dedup, piece_viterbi, signature_join, source_mix

#: A word that fits all languages alike has an equal share of each; a document needs a fifth more, at most this.
LEAST_LANGUAGE_SCORE = 0.3
LEAST_LANGUAGE_SHARES = 1.2
SHINGLE_WORDS = 5
LEAST_SIMILARITY_PERCENT = 80
REPEATED_BYTES = 50
SOURCE_WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3.0
PIECES_FILE = "piece_bpe_32k.model"


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
CORE = ("doc_id", "text", "lang", "source", "n_chars")


def _carrying(stage: Stage) -> Stage:
    """The stage on the columns that documents have; all others go through it as one struct, so no name of theirs can clash.

    Columns that the stage adds replace those of the same name.
    """

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        others = [c for c in docs.columns if c not in CORE]
        if not others:
            return stage(spark, docs, sf_dir)
        core = [c for c in docs.columns if c in CORE]
        packed = docs.select(*core, F.struct(*[F.col(f"`{c}`") for c in others]).alias("extra_columns"))
        out = stage(spark, packed, sf_dir)
        added = [c for c in out.columns if c not in packed.columns]
        unpacked = [F.col(c) if c in core else F.col(f"extra_columns.`{c}`").alias(c) for c in docs.columns if c not in added]
        return out.select(*unpacked, *added)

    return run


@_carrying
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter, and those whose words belong to no language more than by chance.

    Where no row has a language to learn from, every document with a letter stays.
    """
    model = language_crf.fit(docs)
    if not model.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    least = min(LEAST_LANGUAGE_SCORE, LEAST_LANGUAGE_SHARES / len(model.languages))
    out = language_crf.identify(docs, model, lang_out="_lang", score_out="_score")
    return out.filter((F.col("_lang") != language_crf.UND) & (F.col("_score") >= least)).select(*docs.columns)


@_carrying
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the row with the smallest id of each group of near copies. Rows that share an id are rows like others."""
    keyed = written(docs.withColumn("_row", F.monotonically_increasing_id()), "keyed")
    rows = keyed.withColumn("doc_id", F.when(F.col("doc_id").isNotNull(), F.col("_row")))
    comps = signature_join.similarity_components(rows, SHINGLE_WORDS, LEAST_SIMILARITY_PERCENT)
    comps = written(comps.filter("doc_id is not null").select(F.col("doc_id").alias("_row"), "component_id"), "groups")
    first = comps.join(keyed.select("_row", "doc_id"), "_row").groupBy("component_id").agg(F.min_by("_row", F.struct("doc_id", "_row")).alias("_first"))
    later = comps.join(first, "component_id").filter("_row <> _first").select("_row")
    return keyed.join(later, "_row", "left_anti").select(*docs.columns)


@_carrying
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts what a document with a smaller id has already said. Characters of which a byte goes, go; blank rests are dropped."""
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    marked = docs.withColumn("_null", F.col("text").isNull())
    out = phrase_dedup.cut(marked, REPEATED_BYTES, (*others, "_null"), as_text=True)
    changed = F.size("spans") > 0
    columns = {c: F.col(f"carried.`{c}`") for c in others} | {"doc_id": F.col("doc_id")}
    columns["text"] = F.when(changed, F.col("kept_text")).when(~F.col("carried._null"), F.col("text_bytes").cast("string"))
    if "n_chars" in columns:
        columns["n_chars"] = F.when(changed, F.length("kept_text").cast(docs.schema["n_chars"].dataType)).otherwise(columns["n_chars"])
    left = out.filter(~changed | (F.trim(F.translate("kept_text", "\t\n\v\f\r", " " * 5)) != ""))
    return left.select(*[columns[c].alias(c) for c in docs.columns])


@_carrying
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix reads it, to the nearest whole number; documents that it does not reach go, as do those without words."""
    keyed = written(docs.withColumn("_row", F.monotonically_increasing_id()), "keyed")
    # Counted by row, as ids may be missing or repeated. A document without a word is read no time.
    times = F.coalesce(F.floor(F.try_divide("taken", "size") + 0.5), F.lit(0).cast("long"))
    taken = source_mix.mix(keyed, SOURCE_WEIGHTS, MOST_REPEATS, key="_row").select(F.col("row").alias("_row"), times.alias("_times"))
    rows = keyed.join(taken.filter("_times > 0"), "_row")
    return rows.withColumn("_time", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times")))).select(*docs.columns)


@_carrying
def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document."""
    return piece_viterbi.encode(docs, piece_viterbi.load(public_tokenizers.path(PIECES_FILE)))
