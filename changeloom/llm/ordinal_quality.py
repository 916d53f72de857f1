"""Quality of documents by ordinal cumulative-link regression on graded ratings.

One vector of weights over hashed text features gives a document a score s; ordered thresholds
turn it into grades: P(grade <= j) = 1 / (1 + exp(s - threshold_j)). The expected grade ranks documents, the
tail probability P(grade >= j) selects them.

Grades of the ratings table: 0 toxic, 1 of low quality, 2 good.

Features are the presence of words (A-Z as a-z, without punctuation at their ends), of the punctuation itself, and of a few
ranges of shares (repeated neighbours, words without letters, distinct words); hashed to ``2 ** BITS`` weights.
A feature that fewer than ``LEAST_ROWS`` rated rows have gets no weight.

Learning takes a sample of at most ``SAMPLE_ROWS`` rated rows, by a hash of their id, and goes on in the driver over
the features that the sample's rows have; everything else scores all rows in one pass.

Defined cases: a null or empty text has only the features of its shares. Rated twice, a document has its lowest
grade; a rating without quality or toxicity counts as not toxic and of low quality. Without ratings, every grade is
equally likely. Rows are independent; other columns pass through unless they are named like the added ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from . import textbytes

BITS = 18
SAMPLE_ROWS = 8_000
LEAST_ROWS = 3
GRADES = 3

_WORDLIKE = np.zeros(256, dtype=bool)
_WORDLIKE[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)]] = True
_SHARES = np.array([0.0, 0.005, 0.02, 0.1, 0.3, 0.6])


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    thresholds: np.ndarray


def row_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(row, feature)`` of each row's distinct features, in order of rows."""
    low = textbytes.LOWER[data]
    starts, ends, first = textbytes.words(low, offsets)
    rows = len(offsets) - 1
    row = np.repeat(np.arange(rows), np.diff(first))
    lo, hi = starts.copy(), ends.copy()
    for _ in range(4):
        hi -= ~_WORDLIKE[low[hi - 1]] & (hi - lo > 1)
        lo += ~_WORDLIKE[low[np.minimum(lo, len(low) - 1)]] & (hi - lo > 1)
    word = textbytes.span_hashes(low, lo, hi)
    tail = hi < ends
    ending = textbytes.span_hashes(low, hi[tail], ends[tail]) + np.uint64(1)
    counts = np.bincount(row, minlength=rows)
    some = np.maximum(counts, 1)
    same = np.zeros(len(word), dtype=bool)
    same[1:] = (word[1:] == word[:-1]) & (row[1:] == row[:-1])
    plain = ~_WORDLIKE[low[lo]] if len(lo) else np.zeros(0, dtype=bool)
    mask = np.uint64((1 << BITS) - 1)
    pairs = np.unique((row.astype(np.uint64) << np.uint64(BITS)) | (word & mask))
    distinct = np.bincount((pairs >> np.uint64(BITS)).astype(np.int64), minlength=rows)
    keys = [pairs, (row[tail].astype(np.uint64) << np.uint64(BITS)) | (textbytes.mixed(ending) & mask)]
    for k, share in enumerate((np.bincount(row[same], minlength=rows) / some, np.bincount(row[plain], minlength=rows) / some, distinct / some)):
        level = np.searchsorted(_SHARES, share, side="right").astype(np.uint64)
        name = textbytes.mixed(level + np.uint64(1000 * (k + 1)))
        keys.append((np.arange(rows, dtype=np.uint64) << np.uint64(BITS)) | (name & mask))
    keys = np.unique(np.concatenate(keys))
    return (keys >> np.uint64(BITS)).astype(np.int64), (keys & mask).astype(np.int32)


def grade_probabilities(score: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    upto = 1.0 / (1.0 + np.exp(np.clip(score[:, None] - thresholds, -500, 500)))
    edges = np.hstack((np.zeros((len(score), 1)), upto, np.ones((len(score), 1))))
    return np.maximum(np.diff(edges, axis=1), 0.0)


def train(rows: list[np.ndarray], grades: np.ndarray, epochs: int = 30, rate: float = 0.1, decay: float = 1e-4, seed: int = 3) -> Model:
    """Maximum likelihood by adaptive gradient steps; thresholds stay in order, as steps between them are exponentials."""
    weights = np.zeros(1 << BITS)
    if not len(rows):
        return Model(weights, np.log(np.arange(1, GRADES) / np.arange(GRADES - 1, 0, -1)))
    common = np.bincount(np.concatenate(rows), minlength=1 << BITS) >= LEAST_ROWS
    rows = [r[common[r]] for r in rows]
    share = np.clip(np.cumsum(np.bincount(grades, minlength=GRADES))[:-1] / len(grades), 1e-3, 1 - 1e-3)
    start = np.log(share / (1 - share))
    free = np.concatenate((start[:1], np.log(np.maximum(np.diff(start), 1e-2))))
    seen, seen_free = np.full(1 << BITS, 1e-6), np.full(len(free), 1e-6)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for lo in range(0, len(order), 64):
            own = order[lo : lo + 64]
            at = np.repeat(np.arange(len(own)), [len(rows[i]) for i in own])
            feature = np.concatenate([rows[i] for i in own])
            score = np.bincount(at, weights[feature], len(own))
            steps = np.exp(free[1:])
            thresholds = free[0] + np.concatenate(([0.0], np.cumsum(steps)))
            edges = np.concatenate(([-1e3], thresholds, [1e3]))
            g = grades[own]
            upper, lower = edges[g + 1] - score, edges[g] - score
            f_up, f_low = 1 / (1 + np.exp(-np.clip(upper, -500, 500))), 1 / (1 + np.exp(-np.clip(lower, -500, 500)))
            p = np.maximum(f_up - f_low, 1e-12)
            d_up, d_low = f_up * (1 - f_up) / p, f_low * (1 - f_low) / p
            slope = d_up - d_low  # of -log p with respect to the score
            grad = np.bincount(feature, slope[at], 1 << BITS)[feature] / len(own) + decay * weights[feature]
            used, where = np.unique(feature, return_index=True)
            step = grad[where]
            seen[used] += step * step
            weights[used] -= rate * step / np.sqrt(seen[used])
            by_threshold = np.bincount(g, -d_up, GRADES)[: GRADES - 1] + np.bincount(g, d_low, GRADES)[1:]
            by_threshold /= len(own)
            grad_free = np.concatenate(([by_threshold.sum()], [by_threshold[k:].sum() * steps[k - 1] for k in range(1, GRADES - 1)]))
            seen_free += grad_free * grad_free
            free -= rate * grad_free / np.sqrt(seen_free)
    return Model(weights, free[0] + np.concatenate(([0.0], np.cumsum(np.exp(free[1:])))))


def graded(labels: DataFrame) -> DataFrame:
    """``doc_id, grade`` of the rated documents."""
    grade = F.when(F.coalesce("toxic", F.lit(0)) == 1, 0).when(F.coalesce("quality", F.lit(0)) == 1, 2).otherwise(1)
    return labels.filter("doc_id is not null").groupBy("doc_id").agg(F.min(grade).cast("int").alias("grade"))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    rated = graded(labels)
    count = rated.count()
    if not count:
        return train([], np.zeros(0, dtype=np.int64))
    h = F.xxhash64("doc_id", F.lit(29))
    drawn = F.pmod(h, F.lit(1 << 30)) < int(min(1.0, sample_rows / count) * (1 << 30))
    sample = F.broadcast(rated.filter(drawn).orderBy(h, "doc_id").limit(sample_rows))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in textbytes.pieces(batch.column(2)):
                row, feature = row_features(data, offsets)
                bounds = np.searchsorted(row, np.arange(hi - lo + 1))
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(feature, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), lists], names=["doc_id", "grade", "features"])

    rows = docs.select("doc_id", "text").join(sample, "doc_id").select("doc_id", "grade", "text")
    found = rows.mapInArrow(extract, "doc_id long, grade int, features array<int>").orderBy("doc_id", "features").limit(2 * sample_rows).toArrow()
    return train([np.asarray(f.values) for f in found.column("features").combine_chunks()] if found.num_rows else [], found.column("grade").to_numpy())


ADDED = ("expected_grade", "p_acceptable", "p_good", "grade")


def rate(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``expected_grade``, ``p_acceptable`` (grade 1 or more), ``p_good`` (grade 2) and the likeliest ``grade``."""
    docs = docs.drop(*ADDED)
    fields = [T.StructField(n, T.DoubleType()) for n in ADDED[:3]] + [T.StructField("grade", T.IntegerType())]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in textbytes.pieces(batch.column(batch.schema.get_field_index(text))):
                row, feature = row_features(data, offsets)
                p = grade_probabilities(np.bincount(row, model.weights[feature], hi - lo), model.thresholds)
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.slice(lo, hi - lo).columns, pa.array(p @ np.arange(GRADES)), pa.array(np.minimum(p[:, 1:].sum(axis=1), 1.0)),
                        pa.array(p[:, -1]), pa.array(p.argmax(axis=1), pa.int32()),
                    ],
                    names=[*batch.schema.names, *ADDED],
                )

    return docs.mapInArrow(score, T.StructType([*docs.schema.fields, *fields]))


def select(rated: DataFrame, least_grade: int = 1, probability: float = 0.5) -> DataFrame:
    """The rows that reach the grade with at least this probability."""
    tail = {1: "p_acceptable", 2: "p_good"}[least_grade]
    return rated.filter(F.col(tail) >= probability)
