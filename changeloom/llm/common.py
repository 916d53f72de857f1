"""Helpers of several operators: input sizes, keys that several documents share, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.workspace import written

KEY_BYTES = 5
KEYS_PER_BUCKET = 400_000
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

BUCKETED = pa.schema([("bucket", pa.int32()), ("blob", pa.binary())])
BUCKETED_DDL = "bucket int, blob binary"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """Bytes of all texts: one scan and one number, from which the sizes of groups follow."""
    return docs.agg(F.sum(F.octet_length(column).cast("long"))).first()[0] or 0


def _planes(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of unsigned values, byte by byte, so that equal high bytes compress."""
    raw = values.view(np.uint8).reshape(len(values), values.dtype.itemsize)[:, :width]
    return np.ascontiguousarray(raw.T).tobytes()


def _unplanes(blob: memoryview, at: int, n: int, width: int) -> tuple[np.ndarray, int]:
    raw = np.zeros((n, 8), dtype=np.uint8)
    raw[:, :width] = np.frombuffer(blob, dtype=np.uint8, count=n * width, offset=at).reshape(width, n).T
    return raw.view(np.uint64).reshape(n), at + n * width


def bucketed(keys: np.ndarray, owners: np.ndarray, extra: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """``(key, owner, extra)`` rows packed by the bucket of their key. ``extra``: uint32."""
    if not len(keys):
        return
    bucket = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    order = np.argsort(bucket, kind="stable")
    bucket, keys, owners, extra = bucket[order], keys[order], owners[order], extra[order]
    cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    ids, blobs, size = [], [], 0
    for lo, hi in zip(cuts, np.append(cuts[1:], len(keys))):
        blob = (
            np.uint64(hi - lo).tobytes()
            + _planes(keys[lo:hi], KEY_BYTES)
            + _planes(owners[lo:hi].view(np.uint64), 8)
            + _planes(extra[lo:hi].astype(np.uint32), 4)
        )
        ids.append(int(bucket[lo]))
        blobs.append(blob)
        size += len(blob)
        if size > 8_000_000:
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(blobs, pa.binary())], schema=BUCKETED)
            ids, blobs, size = [], [], 0
    if ids:
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(blobs, pa.binary())], schema=BUCKETED)


def unbucketed(blobs: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, owners and extras of the blobs of one bucket."""
    keys, owners, extra = [], [], []
    for value in blobs:
        blob = value.as_buffer()
        n = int(np.frombuffer(blob, dtype=np.uint64, count=1)[0])
        k, at = _unplanes(blob, 8, n, KEY_BYTES)
        o, at = _unplanes(blob, at, n, 8)
        x, at = _unplanes(blob, at, n, 4)
        keys.append(k)
        owners.append(o.view(np.int64))
        extra.append(x.astype(np.uint32))
    return np.concatenate(keys), np.concatenate(owners), np.concatenate(extra)


def runs(*columns: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal values in sorted columns."""
    if not len(columns[0]):
        return np.zeros(0, dtype=np.int64)
    change = np.zeros(len(columns[0]), dtype=bool)
    change[0] = True
    for c in columns:
        change[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(change)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``written``, with the shuffles behind the table deleted as soon as it is there.

    Otherwise they stay until the driver happens to collect its garbage, which may be long after the disks are full.
    """
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, "false")
    conf.set(_CLEANUP, "true")
    try:
        return written(df, purpose)
    finally:
        conf.set(_CLEANUP, before)


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of several spans, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """``(node, comp)``: the smallest node that each node of ``edges(a, b)`` reaches.

    Alternates large-star and small-star steps. Neighbours are never gathered: a step is a minimum
    per node and a join of the edges with it, so a node with very many edges costs only rows.
    """
    edges = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        large = large.unionByName(edges.join(low, "a").select("a", F.col("m").alias("b")).filter("a <> b"))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("x"), "m").filter("x <> m").select(F.col("x").alias("a"), F.col("m").alias("b"))
        edges = stored(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct()
    )
