"""Exact top-k inner products by distributed histogram selection.

Queries and candidates are dealt into blocks; a task scores one block of queries against one of
candidates. It does not return scores but counts of them in bins, from coarse to fine: the sums over
all tasks tell in which bin a query's k-th largest score lies, and the next round counts within that
bin, until bins are single scores. A last round returns the scores above the k-th and, of those equal to
it, the k with the smallest ids of each task; ties go to the smaller id.

A task counts only bins down to the one of its own k-th score, as the k-th of all is not below it: at
most k rows per query and task, whatever the number of equal vectors.

Defined cases: components are ``floor(scale * x)``; scores are whole numbers and exact, and stop at the ends of
the long range. Vectors that are null, empty, without id or hold null or non-finite components take no
part; vectors are compared with those of equal length. Of rows that repeat a query's id, the
smallest vector asks; as candidates all of them count. Fewer candidates than k: all are returned. An
empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..sources.workspace import written
from .vectors import matrix, usable

CANDIDATES = 4096
QUERIES = 1024
BIN_BITS = 10
_LONG = np.iinfo(np.int64)


def scores(q: np.ndarray, c: np.ndarray, scale: float) -> np.ndarray:
    """Inner products of whole components as int64."""
    a, b = np.floor(scale * q), np.floor(scale * c)
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2.0**53:
        return (a @ b.T).astype(np.int64)
    exact = np.array([[int(x) for x in r] for r in a], dtype=object) @ np.array([[int(x) for x in r] for r in b], dtype=object).T
    return np.clip(exact, _LONG.min, _LONG.max).astype(np.int64)


def _scored(queries: pa.Table, candidates: pa.Table, scale: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of queries and candidates, and scores; a query's own rows are marked by a mask."""
    ask, own = queries.column("vec_id").to_numpy(), candidates.column("vec_id").to_numpy()
    return ask, own, scores(matrix(queries.column("v")), matrix(candidates.column("v")), scale)


def top_k(table: DataFrame, every: int, k: int, scale: float = 256.0) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` best of all rows for each row whose id is divisible by ``every``."""
    rows = usable(table)
    n, most, longest = rows.agg(F.count("*"), F.max(F.array_max(F.transform("v", F.abs))), F.max("dim")).first()
    spark = table.sparkSession
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    asked = rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id", "dim").agg(F.min("v").alias("v"))
    asked = asked.groupBy("vec_id").agg(F.min(F.struct("v", "dim")).alias("s")).select("vec_id", "s.v", "s.dim")
    n_asked = asked.count()
    c_blocks, q_blocks = -(-n // CANDIDATES), max(1, -(-n_asked // QUERIES))
    queries = written(asked.withColumn("qb", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(q_blocks))), "queries")
    candidates = rows.withColumn("cb", F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(c_blocks))).withColumn(
        "qb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(q_blocks - 1).cast("long")))
    )
    spread_out = candidates.groupBy("dim", "cb", "qb")

    def asking(state: DataFrame) -> DataFrame:
        wide = queries.join(state, "vec_id") if state is not None else queries
        return wide.withColumn("cb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(c_blocks - 1).cast("long"))))

    limit = min(min(scale * float(most) + 1, 2.0**32) ** 2 * longest, 2.0**63)
    shift = max(0, int(np.ceil(np.log2(limit))) + 1 - BIN_BITS)
    state = None  # vec_id, low, high: the k-th score is from low to high; above: how many are larger than high
    while True:
        at, first = shift, state is None

        def count(q: pa.Table, c: pa.Table) -> pa.Table:
            ask, own, score = _scored(q, c, scale)
            ids, bins, counts = [], [], []
            low = np.full(len(ask), _LONG.min) if first else q.column("low").to_numpy()
            high = np.full(len(ask), _LONG.max) if first else q.column("high").to_numpy()
            for i in range(len(ask)):
                mine = score[i][own != ask[i]]
                mine = mine[(mine >= low[i]) & (mine <= high[i])]
                if not len(mine):
                    continue
                if len(mine) > k:
                    mine = mine[mine >> at >= np.partition(mine, len(mine) - k)[len(mine) - k] >> at]
                b, m = np.unique(mine >> at, return_counts=True)
                ids.append(np.full(len(b), ask[i]))
                bins.append(b)
                counts.append(m)
            empty = np.zeros(0, dtype=np.int64)
            return pa.table({
                "vec_id": pa.array(np.concatenate(ids or [empty]), pa.int64()),
                "bin": pa.array(np.concatenate(bins or [empty]), pa.int64()),
                "n": pa.array(np.concatenate(counts or [empty]), pa.int64()),
            })

        counted = asking(state).groupBy("dim", "cb", "qb").cogroup(spread_out).applyInArrow(count, "vec_id long, bin long, n long")
        counted = counted.groupBy("vec_id", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("vec_id").orderBy(F.desc("bin"))
        counted = counted.withColumn("upto", F.sum("n").over(down))
        before = queries.select("vec_id", F.lit(0).cast("long").alias("above")) if first else state.select("vec_id", "above")
        # The bin in which the count reaches k; queries with fewer candidates keep their lowest bin.
        found = counted.join(before, "vec_id").filter(f"upto + above - n < {k}").groupBy("vec_id").agg(
            F.min(F.struct("bin", (F.col("upto") + F.col("above") - F.col("n")).alias("above"))).alias("s")
        )
        low = F.shiftleft("s.bin", at)
        high = low + F.lit((1 << at) - 1)
        state = written(found.select("vec_id", low.alias("low"), high.alias("high"), F.col("s.above").alias("above")), "state")
        if not shift:
            break
        shift = max(0, shift - BIN_BITS)

    def take(q: pa.Table, c: pa.Table) -> pa.Table:
        ask, own, score = _scored(q, c, scale)
        low = q.column("low").to_numpy()
        found = []
        for i in range(len(ask)):
            good = np.flatnonzero((score[i] >= low[i]) & (own != ask[i]))
            good = good[np.lexsort((own[good], -score[i][good]))][:k]
            found.append((np.full(len(good), ask[i]), own[good], score[i][good]))
        a, b, s = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, dtype=np.int64),) * 3
        return pa.table({"query_id": pa.array(a, pa.int64()), "vec_id": pa.array(b, pa.int64()), "score": pa.array(s, pa.int64())})

    best = asking(state).groupBy("dim", "cb", "qb").cogroup(spread_out).applyInArrow(take, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS f FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.f, c.f) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
