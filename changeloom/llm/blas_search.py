"""Ranked lexical search by dense blocked matrix multiplication.

Terms are runs of ASCII letters and digits and of other characters beyond ASCII, A-Z as a-z. With N documents that
have a term, L terms in all, n terms in a document (m = 100 - 25 + (25 n N) div L), a term in df documents and tf times in
this one, a document scores for an item the sum over the item's terms, repeats included, of

    floor(1000 ln((2N + 2) / (2 df + 1))) * ((1000000000 tf) div (1000 tf + 12 m))

1. Items are dealt by hash into chunks of about ``CHUNK_BYTES`` of text and ``CHUNK_ITEMS`` items, whatever their number. Only one
   chunk at a time is in the driver and, as a broadcast, in the tasks, so that bound holds for any number of items (one
   longer than a chunk is a chunk's content by itself).
2. One pass over all documents per chunk stores each document's length and its counts of the chunk's terms, as packed
   binary; N, L and df are sums over these rows.
3. A task reads the stored rows in tiles of ``TILE_DOCS`` documents. Of each tile of ``TILE_ITEMS`` items the terms that the document
   tile holds make the columns of a dense matrix of weights, and these terms' impacts a dense matrix of the documents;
   the product of the two, block by block of ``TILE_TERMS`` terms, gives all scores of tile by tile. All numbers are integers and every
   partial sum is proven to be below 2**53 before a block is multiplied (blocks are halved, and weights split, until it is), so
   float64 gives them exactly; blocks are added up in 64-bit integers.
4. Of a tile, the columns at or above an item's k-th best score are kept, ties included, and merged with the best so far by
   score and id. So a task gives out k rows an item; these are ranked in two steps, by item and salt and then by item.

Terms are told apart by their length and a 64-bit hash. Texts are walked in stretches.

Defined cases: null and empty texts have no terms and are never found; an item without terms, or without any document
above 0, has no rows. Documents that repeat an id are ranked each; among equal scores null ids come last. Items that repeat
id and text are one item; those that repeat only the id are ranked each by itself. Empty tables give no rows. Other columns are
ignored. Scores have to stay below 2**63.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from . import textbytes
from .common import spread, stored
from .stretches import spans, stretches

CHUNK_BYTES = 4 << 20
CHUNK_ITEMS = 2_000
TILE_ITEMS = 256
TILE_DOCS = 512
TILE_TERMS = 4_096
SALTS = 64
#: Exclusive bound of what float64 sums exactly.
EXACT = 1 << 53
_HALF = 1 << 20

_TERM = np.zeros(256, dtype=bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_POSTINGS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.binary()), ("tf", pa.binary())])
_POSTINGS_DDL = "doc_id long, n long, terms binary, tf binary"
_BEST = pa.schema([("item", pa.int32()), ("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])
_BEST_DDL = "item int, item_id long, doc_id long, score long"


def _between(data: np.ndarray) -> np.ndarray:
    return ~_TERM[data]


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms in order, and each row's first term."""
    starts, ends, first = spans(_TERM[data], offsets)
    return textbytes.span_hashes(textbytes.LOWER[data], starts, ends), first


@dataclass(frozen=True)
class Items:
    """A chunk of items: its vocabulary, and of each item the places and counts of its terms."""

    ids: list
    vocabulary: np.ndarray
    bounds: np.ndarray
    terms: np.ndarray
    counts: np.ndarray


def items_of(ids: list, texts: pa.Array) -> Items:
    """Long items are walked in stretches, so an item may come in several runs."""
    rows, hashes = [], []
    for lo, _, data, offsets in stretches(texts, _between):
        own, first = _terms(data, offsets)
        rows.append(np.repeat(np.arange(len(offsets) - 1), np.diff(first)) + lo)
        hashes.append(own)
    row = np.concatenate(rows) if rows else np.zeros(0, dtype=np.int64)
    vocabulary, place = np.unique(np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64), return_inverse=True)
    pairs, counts = np.unique(row * max(len(vocabulary), 1) + place, return_counts=True)
    row, terms = np.divmod(pairs, max(len(vocabulary), 1))
    return Items(ids, vocabulary, np.searchsorted(row, np.arange(len(ids) + 1)), terms, counts)


def _postings(vocabulary: np.ndarray):
    """Each document's length and, packed, its counts of the vocabulary's terms."""
    width = len(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.zeros(batch.num_rows, dtype=np.int64)
            found: list[tuple[np.ndarray, np.ndarray]] = []
            for lo, hi, data, offsets in stretches(batch.column(1), _between):
                hashes, first = _terms(data, offsets)
                sizes = np.diff(first)
                lengths[lo:hi] += sizes
                place = np.searchsorted(vocabulary, hashes)
                place[place == width] = 0
                known = vocabulary[place] == hashes if width else np.zeros(len(hashes), dtype=bool)
                row = np.repeat(np.arange(lo, hi), sizes)[known]
                found.append(np.unique(row * max(width, 1) + place[known], return_counts=True))
            if found:
                pairs, where = np.unique(np.concatenate([p for p, _ in found]), return_inverse=True)
                counts = np.bincount(where, np.concatenate([c for _, c in found]), len(pairs)).astype(np.int64)
            else:
                pairs = counts = np.zeros(0, dtype=np.int64)
            row, terms = np.divmod(pairs, max(width, 1))
            bounds = np.searchsorted(row, np.arange(batch.num_rows + 1))
            terms, counts = terms.astype(np.int32), counts.astype(np.int64)
            columns = [
                pa.array([values[a:b].tobytes() for a, b in zip(bounds, bounds[1:])], pa.binary()) for values in (terms, counts)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths), *columns], schema=_POSTINGS)

    return count


def _frequencies(width: int):
    """A task's documents per term, as rows of a table."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, dtype=np.int64)
        for batch in batches:
            terms = np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype=np.int32)
            total += np.bincount(terms, minlength=width)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["term", "df"])

    return count


def weights_of(df: np.ndarray, documents: int) -> np.ndarray:
    return np.floor(1000 * np.log((2 * documents + 2) / (2 * df + 1))).astype(np.int64)


def impacts_of(tf: np.ndarray, n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """What one occurrence of weight 1 adds; below 10**6."""
    if len(n) and int(n.max()) * documents * 25 >= 1 << 63:  # beyond 64 bits: one by one
        m = np.array([75 + 25 * int(x) * documents // total for x in n], dtype=np.int64)
    else:
        m = 75 + 25 * n * documents // total
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


def product(weights: np.ndarray, impacts: np.ndarray) -> np.ndarray:
    """The exact integer product of two matrices of whole numbers from 0 up, by float64 blocks.

    A block whose sums could reach 2**53 is halved; where one term alone could, its weights are split into two parts.
    """
    total = np.zeros((weights.shape[0], impacts.shape[1]), dtype=np.int64)
    if not weights.size or not impacts.size:
        return total
    todo = [(0, weights.shape[1])]
    while todo:
        lo, hi = todo.pop()
        left, right = weights[:, lo:hi], impacts[lo:hi]
        # Python integers: the bound itself may be beyond 64 bits.
        bound = (hi - lo) * int(left.max()) * int(right.max())
        if bound >= EXACT:
            bound = max(sum(map(int, row)) for row in left) * int(right.max()) if hi - lo < 64 else bound
        if bound < EXACT:
            total += (left.astype(np.float64) @ right.astype(np.float64)).astype(np.int64)
        elif hi - lo > 1:
            todo += [(lo, (lo + hi) // 2), ((lo + hi) // 2, hi)]
        else:
            high, low = np.divmod(left, _HALF)
            total += product(high, right) * _HALF + product(low, right)
    return total


class Best:
    """The k best documents of each item so far, by score, then id (null last)."""

    def __init__(self, items: int, k: int):
        self.k, self.bar = k, np.ones(items, dtype=np.int64)
        self.item, self.score, self.doc, self.null = (np.zeros(0, dtype=t) for t in (np.int64, np.int64, np.int64, bool))

    def add(self, first: int, scores: np.ndarray, docs: np.ndarray, nulls: np.ndarray) -> None:
        """``scores``: items from ``first`` on by documents."""
        bar = self.bar[first : first + len(scores)]
        if scores.shape[1] > self.k:
            bar = np.maximum(bar, np.partition(scores, -self.k, axis=1)[:, -self.k])
        item, doc = np.nonzero(scores >= bar[:, None])
        if not len(item):
            return
        both = [
            np.concatenate(pair)
            for pair in (
                (self.item, item + first),
                (self.score, scores[item, doc]),
                (self.doc, docs[doc]),
                (self.null, nulls[doc]),
            )
        ]
        order = np.lexsort((both[2], both[3], -both[1], both[0]))
        item = both[0][order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        order = order[place < self.k]
        self.item, self.score, self.doc, self.null = (column[order] for column in both)
        ends = np.searchsorted(self.item, np.arange(len(self.bar)), side="right")
        sizes = np.diff(np.concatenate(([0], ends)))
        full = np.flatnonzero(sizes == self.k)
        self.bar[full] = self.score[ends[full] - 1]


def _score(chunk, k: int, documents: int, total: int):
    """A task's k best documents of every item of the chunk."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights = chunk.value
        width, best = len(items.vocabulary), Best(len(items.ids), k)
        tiles = []
        for lo in range(0, len(items.ids), TILE_ITEMS):
            hi = min(lo + TILE_ITEMS, len(items.ids))
            own = slice(items.bounds[lo], items.bounds[hi])
            order = np.argsort(items.terms[own], kind="stable")
            row = np.repeat(np.arange(hi - lo), np.diff(items.bounds[lo : hi + 1]))[order]
            terms, counts = items.terms[own][order], items.counts[own][order]
            tiles.append((lo, hi, np.searchsorted(terms, np.arange(width + 1)), row, counts * weights[terms]))
        for batch in batches:
            for at in range(0, batch.num_rows, TILE_DOCS):
                part = batch.slice(at, TILE_DOCS)
                terms = np.frombuffer(b"".join(part.column(2).to_pylist()), dtype=np.int32)
                tf = np.frombuffer(b"".join(part.column(3).to_pylist()), dtype=np.int64)
                if not len(terms):
                    continue
                sizes = np.array([len(x) // 4 for x in part.column(2).to_pylist()])
                doc, n = np.repeat(np.arange(len(sizes)), sizes), part.column(1).to_numpy()
                some, column = np.unique(terms, return_inverse=True)
                impact = impacts_of(tf, n[doc], documents, total)
                ids = part.column(0).fill_null(2**63 - 1).to_numpy()
                nulls = np.asarray(part.column(0).is_null())
                for lo, hi, starts, row, values in tiles:
                    used = np.flatnonzero(starts[some + 1] > starts[some])
                    if not len(used):
                        continue
                    scores = np.zeros((hi - lo, len(sizes)), dtype=np.int64)
                    for block in range(0, len(used), TILE_TERMS):
                        part_used = used[block : block + TILE_TERMS]
                        counts = starts[some[part_used] + 1] - starts[some[part_used]]
                        entry = spread(starts[some[part_used]], counts)
                        left = np.zeros((hi - lo, len(part_used)), dtype=np.int64)
                        left[row[entry], np.repeat(np.arange(len(part_used)), counts)] = values[entry]
                        place = np.full(len(some), -1)
                        place[part_used] = np.arange(len(part_used))
                        own = place[column]
                        here = own >= 0
                        right = np.zeros((len(part_used), len(sizes)), dtype=np.int64)
                        right[own[here], doc[here]] = impact[here]
                        scores += product(left, right)
                    best.add(lo, scores, ids, nulls)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(best.item, pa.int32()),
                pa.array([items.ids[i] for i in best.item], pa.int64()),
                pa.array(best.doc, mask=best.null),
                pa.array(best.score),
            ],
            schema=_BEST,
        )

    return score


def search(docs: DataFrame, items: DataFrame, k: int = 20, chunk_bytes: int = CHUNK_BYTES, chunk_items: int = CHUNK_ITEMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k best documents of every item."""
    spark = docs.sparkSession
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    size = items.agg(F.count("*"), F.sum(F.octet_length("text").cast("long"))).first()
    chunks = max(1, -(-size[0] // chunk_items), -(-(size[1] or 0) // chunk_bytes))
    items = items.withColumn("chunk", F.pmod(F.xxhash64("item_id", "text"), F.lit(chunks)))
    found = None
    for number in range(chunks):
        own = items.filter(F.col("chunk") == number).orderBy("item_id", "text").toArrow()
        part = _chunk(spark, docs, own, k).withColumn("chunk", F.lit(number))
        found = part if found is None else found.unionByName(part)
    order = (F.desc("score"), F.asc_nulls_last("doc_id"))
    salted = Window.partitionBy("chunk", "item", "salt").orderBy(*order)
    whole = Window.partitionBy("chunk", "item").orderBy(*order)
    few = found.withColumn("place", F.row_number().over(salted)).filter(F.col("place") <= k)
    return few.withColumn("rank", F.row_number().over(whole)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def _chunk(spark, docs: DataFrame, own: pa.Table, k: int) -> DataFrame:
    texts = own.column("text").combine_chunks() if own.num_rows else pa.array([], pa.string())
    items = items_of(own.column("item_id").to_pylist(), texts)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    postings = stored(rows.mapInArrow(_postings(items.vocabulary), _POSTINGS_DDL), "postings")
    sums = postings.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    documents, total = sums[0], sums[1] or 0
    counts = postings.select("terms").mapInArrow(_frequencies(len(items.vocabulary)), "term int, df long")
    df = np.zeros(len(items.vocabulary), dtype=np.int64)
    for row in counts.groupBy("term").agg(F.sum("df").alias("df")).collect():  # as many as the chunk's terms at most
        df[row["term"]] = row["df"]
    chunk = spark.sparkContext.broadcast((items, weights_of(df, documents)))
    best = postings.mapInArrow(_score(chunk, k, documents, total), _BEST_DDL)
    return best.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), s AS (
  SELECT count(*) FILTER (len(terms) > 0)::BIGINT AS big_n, sum(len(terms))::BIGINT AS big_l FROM d
), q AS (
  SELECT item_id, term, count(*)::BIGINT AS c
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM (SELECT DISTINCT item_id, text FROM benchmark))
  GROUP BY item_id, term
), p AS (
  SELECT r, any_value(doc_id) AS doc_id, any_value(n)::BIGINT AS n, term, count(*)::BIGINT AS tf
  FROM (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY r, term
), w AS (
  SELECT term, floor(1000 * ln((2 * any_value(big_n) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM p, s GROUP BY term
), x AS (
  SELECT r, doc_id, term, (1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * big_n) // big_l)) AS impact FROM p, s
), t AS (
  SELECT item_id, r, any_value(x.doc_id) AS doc_id, sum(c * w * impact)::BIGINT AS score
  FROM x JOIN q USING (term) JOIN w USING (term) GROUP BY item_id, r
), o AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM t WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM o WHERE rank <= 20
"""
