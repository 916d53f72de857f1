"""Mixing sources to target weights by a low-discrepancy schedule.

The sources take slots in turn: slot ``j`` is the point ``frac(j * golden ratio)``, and the source whose
stretch of the cumulative targets holds the point owns the slot, so every run of slots is close to the
target weights. The slots of a source are ranked; its k-th slot reads its k-th block. Blocks are equal numbers of
words of the source's documents, shuffled by a hash and laid end to end, again and again where the
target is larger than the source. A source too small for the schedule gets one slot at the end.

Targets share the total by weight; a target stops at ``most`` times its source, and what is over is
shared again by weight among the others.

Defined cases: a null text has size 0 and takes 0. Null is a source like others, last in order. Equal
rows may take different numbers, as one of them may be read once more. A source without words has
target 0. An empty table gives an empty one; other columns pass through, except those named like the added ones.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..sources.workspace import written
from . import textbytes

GOLDEN = 0.6180339887498949
BLOCK_WORDS = 8192
SLOTS_PER_SOURCE = 64
ROWS_PER_RANGE = 20_000
_CELLS = 1024
_STRETCH = 4096


def sized(docs: DataFrame) -> DataFrame:
    """``docs`` with ``size``, the number of words of the text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(batch.schema.get_field_index("text"))
            sizes = [np.diff(textbytes.words(data, offsets)[2]) for _, _, data, offsets in textbytes.pieces(text)]
            sizes = pa.array(np.concatenate(sizes) if sizes else [], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, sizes], names=[*batch.schema.names, "size"])

    docs = docs.drop("size")
    return docs.mapInArrow(count, T.StructType([*docs.schema.fields, T.StructField("size", T.LongType())]))


def targets(sources: DataFrame, weights: Sequence[float], most: float) -> DataFrame:
    """``sources(source, source_size)`` with ``src``, a number in their order, and ``target``.

    With a level x, a source gets the smaller of ``most`` times its size and its weight times x.
    Sources are put in order of the level at which they are full; running sums give the level that
    shares out the total. One row a source, so one task is enough.
    """
    order = (F.col("source").isNull(), F.col("source"))
    everything = Window.partitionBy(F.lit(0))
    rows = sources.withColumn("src", F.row_number().over(everything.orderBy(*order)) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("src") % len(weights) + 1).cast("int"))
    full = everything.orderBy("fills_at", "src")
    rows = (
        rows.withColumn("weight", weight)
        .withColumn("cap", F.lit(float(most)) * F.col("source_size"))
        .withColumn("fills_at", F.col("cap") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("full", F.coalesce(F.sum("cap").over(full.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(full.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("total") - F.col("full")) / F.col("open"))
    )
    # Full sources come first; the first one that its level does not fill sets the level of all after it.
    first = F.min(F.when(F.col("level") <= F.col("fills_at"), F.struct("fills_at", "src", "level"))).over(everything)
    target = F.least("cap", F.col("weight") * F.coalesce(first["level"], F.col("fills_at")))
    return rows.select("src", "source", "source_size", target.alias("target"))


def schedule(sources: DataFrame, slots: int) -> DataFrame:
    """``slot, src, turn`` for ``sources(src, target)``: the owner of each slot and how many it had before."""
    order = Window.partitionBy(F.lit(0)).orderBy("src")
    end = F.sum("target").over(order)
    shares = sources.filter("target > 0").select(
        "src",
        (F.coalesce(F.sum("target").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)) / F.sum("target").over(Window.partitionBy(F.lit(0)))).alias("low"),
        F.when(F.lead("src").over(order).isNull(), 2.0).otherwise(end / F.sum("target").over(Window.partitionBy(F.lit(0)))).alias("high"),
    )
    # A source is listed at every cell of [0, 1) that it touches, so that points find it by an equal key.
    last = F.least(F.floor(F.col("high") * _CELLS), F.lit(_CELLS - 1))
    cells = shares.withColumn("cell", F.explode(F.sequence(F.least(F.floor(F.col("low") * _CELLS), last), last)))
    points = sources.sparkSession.range(slots).select(F.col("id").alias("slot"), (F.col("id") * GOLDEN % 1.0).alias("point"))
    owned = points.withColumn("cell", F.floor(F.col("point") * _CELLS)).join(cells, "cell").filter("point >= low and point < high")
    owned = owned.select("slot", "src", F.expr(f"slot div {_STRETCH}").alias("stretch"))
    # Turns: counts of whole stretches before, and the rank within the slot's own.
    counts = owned.groupBy("src", "stretch").count()
    before = counts.select("src", "stretch", (F.sum("count").over(Window.partitionBy("src").orderBy("stretch")) - F.col("count")).alias("before"))
    within = F.row_number().over(Window.partitionBy("src", "stretch").orderBy("slot")) - 1
    placed = owned.withColumn("within", within).join(before, ["src", "stretch"])
    turns = placed.select("slot", "src", (F.col("within") + F.col("before")).alias("turn"))
    missed = sources.filter("target >= 0.5").join(turns, "src", "left_anti")
    return turns.unionByName(missed.select((F.col("src") + slots).alias("slot"), F.col("src"), F.lit(0).cast("long").alias("turn")))


def _order(seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))


def laid_out(rows: DataFrame, seed: int, most_rows: int) -> DataFrame:
    """``rows(src, doc_id, size)`` with ``start``: the words of the source before this document, in shuffled order.

    A source is cut into ranges of the hash; sums of whole ranges and running sums within one give
    the place, so no task sees a whole source.
    """
    ranges = max(1, -(-most_rows // ROWS_PER_RANGE))
    rows = rows.withColumn("order", _order(seed))
    rows = rows.withColumn("range", F.expr(f"cast(conv(substr(order, 1, 8), 16, 10) as bigint) * {ranges} div 4294967296"))
    sums = rows.groupBy("src", "range").agg(F.sum("size").alias("words"))
    sums = sums.select("src", "range", (F.sum("words").over(Window.partitionBy("src").orderBy("range")) - F.col("words")).alias("before"))
    running = F.sum("size").over(Window.partitionBy("src", "range").orderBy("order", "doc_id", "size", "row").rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("upto", running).join(sums, ["src", "range"]).select(
        "row", "src", "doc_id", "size", (F.col("before") + F.col("upto") - F.col("size")).alias("start")
    )


def pieces(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), most: float = 3.0, seed: int = 7, key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The mix, and the documents with their sizes and targets. ``row`` is the unique column ``key``, or else made here.

    Mix: ``slot, row, doc_id, first, end``, the words of a document that a slot reads, in order of ``slot`` and ``first``.
    """
    row = F.col(key) if key else F.monotonically_increasing_id()
    own = [key] if key else []
    rows = written(sized(docs.select("doc_id", "source", "text", *own)).select("doc_id", "source", "size", row.alias("row")), "sized")
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    totals = written(totals, "totals")
    sources = written(targets(totals.drop("rows"), weights, most).withColumn("take", F.floor(F.col("target") + 0.5)), "sources")
    n, words = sources.agg(F.count("*"), F.sum("source_size")).first()
    most_rows = totals.agg(F.max("rows")).first()[0] or 0
    slots = max(n * SLOTS_PER_SOURCE, (words or 0) // BLOCK_WORDS)
    turns = written(schedule(sources, slots), "turns")
    # Blocks of a source: as many as it has slots, of equal size.
    had = turns.groupBy("src").agg(F.count("*").alias("blocks"))
    plan = sources.join(had, "src").select("src", "source_size", "take", F.expr("greatest(1, (take + blocks - 1) div blocks)").alias("block"))
    known = rows.join(sources.select("src", F.col("source").alias("s"), "source_size", "target"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    placed = laid_out(known.filter("size > 0").select("row", "src", "doc_id", "size"), seed, most_rows).join(plan, "src")
    read = placed.withColumn("round", F.explode(F.expr("sequence(0L, greatest(0L, (take - 1) div source_size))")))
    read = read.withColumn("from", F.expr("round * source_size + start")).withColumn("to", F.expr("least(from + size, take)")).filter("from < to")
    read = read.withColumn("turn", F.explode(F.expr("sequence(from div block, (to - 1) div block)")))
    read = read.select("src", "turn", "row", "doc_id", (F.greatest(F.col("from"), F.expr("turn * block")) - F.expr("round * source_size + start")).alias("first"),
                       (F.least(F.col("to"), F.expr("(turn + 1) * block")) - F.expr("round * source_size + start")).alias("end"))
    return read.join(turns, ["src", "turn"]).select("slot", "row", "doc_id", "first", "end"), known


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), most: float = 3.0, seed: int = 7, key: str | None = None) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of each row: the words that the mix takes, repeats counted.

    What the schedule decides follows: ``n_slots`` and ``first_slot``, how often a slot reads the row and the first one that
    does (null: none), and ``slot_words``, the most words that one slot reads of it. With ``key``, a unique column of ``docs``, it is added as ``row``.
    """
    read, known = pieces(docs, weights, most, seed, key)
    words = F.col("end") - F.col("first")
    taken = read.groupBy("row").agg(F.sum(words).alias("taken"), F.count("*").alias("n_slots"), F.min("slot").alias("first_slot"), F.max(words).alias("slot_words"))
    none = F.lit(0).cast("long")
    sums = [F.coalesce(c, none).alias(c) for c in ("taken", "n_slots", "slot_words")]
    return known.join(taken, "row", "left").select("doc_id", "size", "source_size", "target", *sums, "first_slot", *(["row"] if key else []))


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS shuffled
  FROM documents),
ranked AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS src
  FROM sized GROUP BY source),
weighed AS (
  SELECT *, CASE src % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight, 3.0::DOUBLE * source_size AS cap FROM ranked),
levels AS (
  SELECT *, cap / weight AS fills_at, sum(source_size) OVER () AS total,
         coalesce(sum(cap) OVER (ORDER BY cap / weight, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS before,
         sum(weight) OVER (ORDER BY cap / weight, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS still
  FROM weighed),
settled AS (
  SELECT (total - before) / still AS level FROM levels
  WHERE (total - before) / still <= fills_at ORDER BY fills_at, src LIMIT 1),
shares AS (
  SELECT src, source, source_size, least(cap, weight * level) AS target, CAST(floor(least(cap, weight * level) + 0.5) AS BIGINT) AS take
  FROM levels, settled),
-- The schedule: slot j belongs to the source whose stretch of the cumulative targets holds frac(j * golden ratio).
stretches AS (
  SELECT src, (sum(target) OVER (ORDER BY src) - target) / sum(target) OVER () AS low,
         CASE WHEN lead(src) OVER (ORDER BY src) IS NULL THEN 2.0 ELSE sum(target) OVER (ORDER BY src) / sum(target) OVER () END AS high
  FROM shares WHERE target > 0),
points AS (
  SELECT slot, (CAST(slot AS DOUBLE) * CAST(0.6180339887498949 AS DOUBLE)) % CAST(1 AS DOUBLE) AS point
  FROM (SELECT unnest(range((SELECT greatest(count(*) * 64, sum(source_size) // 8192)::BIGINT FROM shares))) AS slot)),
owned AS (SELECT slot, src FROM points JOIN stretches ON point >= low AND point < high),
turns AS (
  SELECT slot, src, row_number() OVER (PARTITION BY src ORDER BY slot) - 1 AS turn FROM owned
  UNION ALL
  SELECT src + (SELECT count(*) FROM points), src, 0 FROM shares WHERE target >= 0.5 AND src NOT IN (SELECT src FROM owned)),
blocks AS (
  SELECT src, greatest(1, (any_value(take) + count(*) - 1) // count(*)) AS block FROM shares JOIN turns USING (src) GROUP BY src),
placed AS (
  SELECT row_number() OVER () AS row, doc_id, size, src, source_size, target, take,
         sum(size) OVER (PARTITION BY sized.source ORDER BY shuffled, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS start
  FROM sized JOIN shares ON sized.source IS NOT DISTINCT FROM shares.source),
rounds AS (
  SELECT row, src, size, take, round * source_size + start AS lo, least(round * source_size + start + size, take) AS hi
  FROM (SELECT *, unnest(range(0, greatest(0, (take - 1) // greatest(source_size, 1)) + 1)) AS round FROM placed WHERE size > 0)
  WHERE round * source_size + start < take),
reads AS (
  SELECT row, src, block, lo, hi, unnest(range(CAST(lo // block AS BIGINT), CAST((hi - 1) // block + 1 AS BIGINT))) AS turn
  FROM rounds JOIN blocks USING (src)),
scheduled AS (
  SELECT row, sum(least(hi, (turn + 1) * block) - greatest(lo, turn * block)) AS taken, count(*) AS n_slots, min(slot) AS first_slot,
         max(least(hi, (turn + 1) * block) - greatest(lo, turn * block)) AS slot_words
  FROM reads JOIN turns USING (src, turn) GROUP BY row)
SELECT doc_id, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken, CAST(coalesce(n_slots, 0) AS BIGINT) AS n_slots,
       CAST(coalesce(slot_words, 0) AS BIGINT) AS slot_words, CAST(first_slot AS BIGINT) AS first_slot
FROM placed LEFT JOIN scheduled USING (row)
"""
