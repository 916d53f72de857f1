"""Token counts of whole texts, with overlap resynchronisation for huge ones.

Texts of at most ``stretch`` characters are encoded as they are. Longer ones are cut into stretches that
overlap, which are encoded anywhere in the cluster, with the offsets of their tokens. Two
neighbours are spliced at a token that both have in the overlap, at the same place: what is before it comes from the
left one, what is after it from the right one. Where they have none in common, the overlap is doubled, again and
again; when it would be more than the right stretch, the two become one, at worst the whole text.

Why a common token proves the splice: merging goes by rank, and a merge needs two neighbouring
symbols. In the left stretch no merge crossed the token's start, in the right one none crossed its end,
and up to such a crossing the symbols on either side are those of the whole text. So none crosses there either.

Defined cases: a null text counts as empty, with 0 tokens. Rows are independent, so repeated rows count alike,
ids may be null, and other columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, Window, functions as F

from ..sources.workspace import written

STRETCH = 32_768
OVERLAP = 512

_models: dict[str, sentencepiece.SentencePieceProcessor] = {}


def model(path: str) -> sentencepiece.SentencePieceProcessor:
    if path not in _models:
        _models[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _models[path]


def _short(docs: DataFrame, path: str) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = model(path)
        for batch in batches:
            n = []
            for lo in range(0, batch.num_rows, 256):
                texts = [t or "" for t in batch.column(2).slice(lo, 256).to_pylist()]
                n += [len(ids) for ids in encoder.encode(texts, num_threads=1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    return docs.select("doc_id", "n_bytes", "text").mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")


def _stretches(docs: DataFrame, stretch: int, overlap: int) -> DataFrame:
    """``row, doc_id, n_bytes, part, start, at, text``: stretches of ``stretch`` characters and the overlap after each.

    ``start`` counts characters, ``at`` bytes.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", "doc_id", "n_bytes", "part", "start", "at", "text"]
        for batch in batches:
            for row, doc_id, n_bytes, text in zip(*(c.to_pylist() for c in batch.columns)):
                starts = list(range(0, max(len(text) - overlap, 1), stretch))
                at = np.cumsum([0, *(len(text[s : s + stretch].encode()) for s in starts)])
                for lo in range(0, len(starts), 64):
                    own = starts[lo : lo + 64]
                    k = len(own)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([row] * k, pa.int64()), pa.array([doc_id] * k, pa.int64()), pa.array([n_bytes] * k, pa.int64()),
                            pa.array(range(lo, lo + k), pa.int64()), pa.array(own, pa.int64()),
                            pa.array(at[lo : lo + k], pa.int64()), pa.array([text[s : s + stretch + overlap] for s in own], pa.string()),
                        ],
                        names=names,
                    )

    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "n_bytes", "text")
    return rows.mapInArrow(cut, "row long, doc_id long, n_bytes long, part long, start long, at long, text string")


def tokens(text: str, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (in bytes) of the tokens of a text."""
    found = model(path).encode(text, return_type="proto").pieces
    return np.array([p.begin for p in found], dtype=np.int64), np.array([p.end for p in found], dtype=np.int64)


def _encoded(stretches: DataFrame, path: str) -> DataFrame:
    """Each stretch's number of tokens, and the places of the tokens in its first and last part."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, heads, tails = [], [], []
            for start, text, head, tail in zip(*(batch.column(k).to_pylist() for k in range(4, 8))):
                first, end = tokens(text, path)
                # A token as one number: its place in the document and its length. Single bytes, which may be parts of a character, are no places to splice.
                key = np.where(end > first + 1, (first + start) * 1024 + np.minimum(end - first, 1023), -1 - np.arange(len(first)))
                n.append(len(key))
                heads.append(key[first + start < head])
                tails.append(key[first + start >= tail])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(n, pa.int64()), pa.array(heads, pa.list_(pa.int64())), pa.array(tails, pa.list_(pa.int64()))],
                names=["row", "doc_id", "n_bytes", "part", "n", "head", "tail"],
            )

    return stretches.select("row", "doc_id", "n_bytes", "part", "at", "text", "head_to", "tail_from").mapInArrow(
        encode, "row long, doc_id long, n_bytes long, part long, n long, head array<long>, tail array<long>"
    )


def _spliced(stretches: DataFrame, path: str) -> DataFrame:
    """``row, doc_id, n_bytes, n_tokens`` of texts given by their stretches."""
    spark = stretches.sparkSession
    done = None
    while True:
        order = Window.partitionBy("row").orderBy("part")
        stop = F.col("at") + F.octet_length("text")
        bounded = stretches.withColumn("head_to", F.coalesce(F.lag(stop).over(order), F.lit(-1).cast("long"))).withColumn(
            "tail_from", F.coalesce(F.lead("at").over(order), F.lit((1 << 62)).cast("long"))
        )
        size = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
        encoded = written(_encoded(bounded.repartition(size, "row", "part"), path), "encoded")
        common = F.array_intersect(F.filter("tail", lambda k: k >= 0), F.col("next"))
        pairs = encoded.withColumn("next", F.lead("head").over(order))
        pairs = pairs.withColumn("common", F.when(F.col("next").isNotNull(), common)).withColumn("splice", F.try_element_at("common", F.expr("cast(size(common) div 2 + 1 as int)")))
        after = F.size("tail") - F.array_position("tail", F.col("splice"))
        pairs = pairs.withColumn("dropped", F.when(F.col("next").isNull(), 0).otherwise(after + F.array_position("next", F.col("splice"))))
        totals = written(
            pairs.groupBy("row", "doc_id", "n_bytes").agg(
                F.sum("n").alias("n"), F.sum("dropped").alias("dropped"),
                F.max((F.col("next").isNotNull() & F.col("splice").isNull()).cast("int")).alias("apart"),
            ),
            "spliced",
        )
        good = totals.filter("apart = 0").select("row", "doc_id", "n_bytes", (F.col("n") - F.col("dropped")).alias("n_tokens"))
        done = good if done is None else done.unionByName(good)
        again = totals.filter("apart = 1").select("row")
        if again.isEmpty():
            return done
        failed = pairs.filter(F.col("next").isNotNull() & F.col("splice").isNull()).select("row", "part")
        stretches = written(_widened(stretches.join(again, "row"), failed), "stretches")


def _widened(stretches: DataFrame, failed: DataFrame) -> DataFrame:
    """``stretches`` where those in ``failed(row, part)``, which have no token in common with the next one, reach twice as far into it.

    Where that is further than the next one's own text goes, the two become one; of a run of such, every other one,
    so that texts grow by doubling.
    """
    order = Window.partitionBy("row").orderBy("part")
    places = stretches.select("row", "part", "start", F.length("text").alias("chars"))
    places = places.withColumn("own", F.coalesce(F.lead("start").over(order) - F.col("start"), F.col("chars"))).withColumn("reach", F.col("chars") - F.col("own"))
    places = places.withColumn("next_own", F.lead("own").over(order)).withColumn("next_part", F.lead("part").over(order))
    places = places.join(failed.withColumn("failed", F.lit(True)), ["row", "part"], "left")
    places = places.withColumn("wider", F.coalesce(F.col("failed") & (2 * F.col("reach") <= F.col("next_own")) & (F.col("reach") > 0), F.lit(False)))
    places = places.withColumn("ends", F.coalesce(F.col("failed"), F.lit(False)) & ~F.col("wider"))
    places = places.withColumn("run", F.sum((~F.col("ends")).cast("int")).over(order))
    place = F.row_number().over(Window.partitionBy("row", "run", "ends").orderBy("part"))
    places = places.withColumn("joins", F.col("ends") & (place % 2 == 1))
    places = places.withColumn("into", F.when(F.lag("joins").over(order), F.lag("part").over(order)).otherwise(F.col("part")))
    places = written(places.select("row", "part", F.col("own").cast("int").alias("own"), (2 * F.col("reach")).cast("int").alias("wide"), "next_part", "wider", "joins", "into"), "places")

    after = stretches.select("row", F.col("part").alias("next_part"), F.col("text").alias("next_text"))
    more = places.filter("wider").join(after, ["row", "next_part"]).select("row", "part", F.substr("next_text", F.lit(1), F.col("wide")).alias("more"))
    rows = stretches.join(places, ["row", "part"]).join(more, ["row", "part"], "left")
    own = F.substr("text", F.lit(1), F.col("own"))
    rows = rows.withColumn("text", F.when(F.col("more").isNull(), F.col("text")).otherwise(F.concat(own, F.col("more"))))
    tails = rows.filter("into <> part").select("row", F.col("into").alias("part"), F.col("text").alias("tail"))
    heads = rows.filter("into = part").join(tails, ["row", "part"], "left")
    text = F.when(F.col("tail").isNull(), F.col("text")).otherwise(F.concat(own, F.col("tail")))
    return heads.select("row", "doc_id", "n_bytes", "part", "start", "at", text.alias("text"))


def count_tokens(docs: DataFrame, path: str, stretch: int = STRETCH, overlap: int = OVERLAP) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of each row's whole text, as the library at ``path`` encodes it."""
    rows = docs.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    huge = F.coalesce(F.length("text"), F.lit(0)) > stretch + overlap
    stretches = written(_stretches(rows.filter(huge), stretch, overlap), "stretches")
    long = _spliced(stretches, path).select("doc_id", "n_bytes", "n_tokens")
    return _short(rows.filter(~huge), path).unionByName(long)
