"""Language identification by a linear-chain conditional random field over words.

A word's score for a language is the sum of hashed affix, n-gram and lexicon weights; transitions
between the languages of neighbouring words are learned too. Forward-backward gives every word of
a document its language probabilities, so that code-switched documents are labelled word by word;
a document's language is the one with the largest mean probability over its words.

Training text is labelled by document. Runs of words of different documents are strung together, so
that the transitions are learned from sequences that switch.

Defined cases: a null text, or one without a letter, is ``und`` with score 0. Words are maximal runs
of letters, cut every 16 letters. Rows are independent: repeated rows get equal results, other columns
pass through, an empty table gives an empty one. A row without ``doc_id`` is not learned from and not held out.
Without a labelled row to learn from, everything is ``und``. Memory is a text's words times the languages.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

WORD_CHARS = 16
FEATURE_BITS = 16
LEXICON_WORDS = 2000
SEGMENT = 128
#: With more languages than this, documents are not cut into segments.
MOST_CUT_LANGUAGES = 32
#: Numbers in the matrices that are held at once.
HELD_PRODUCTS = 1 << 21
UND = "und"

_WORD = re.compile(r"[^\W\d_]{1,%d}" % WORD_CHARS)
_PIECE_CHARS = 1 << 20


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    weights: np.ndarray  # feature x language
    transitions: np.ndarray  # language x language, as scores
    start: np.ndarray
    lexicon: frozenset[str]


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether the row is kept from learning: crc32 of the id as text leaves no remainder."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def _hashed(values: np.ndarray, salt: int) -> np.ndarray:
    h = (values ^ np.uint64(salt * 0x9E3779B1)) * np.uint64(0x9E3779B97F4A7C15)
    return ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)


def features(types: np.ndarray, lexicon: frozenset[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature ids of each word type and a mask of the ones it has: affixes of 1 to 3, n-grams of 2 and 3, the word itself."""
    lower = [w.lower()[:WORD_CHARS] for w in types]
    chars = np.array(lower, dtype=f"U{WORD_CHARS}").view(np.uint32).reshape(len(lower), WORD_CHARS).astype(np.uint64)
    length = np.array([len(w) for w in lower])
    at = np.arange(WORD_CHARS)
    ids, mask = [], []
    gram = np.zeros_like(chars)
    for n in (1, 2, 3):
        width = WORD_CHARS - n + 1
        gram = gram[:, :width] * np.uint64(1 << 21) + chars[:, n - 1 :]
        has = length >= n
        ids += [_hashed(gram[:, :1], n), _hashed(gram[np.arange(len(lower)), np.maximum(length - n, 0)][:, None], 3 + n)]
        mask += [has[:, None], has[:, None]]
        if n > 1:
            ids.append(_hashed(gram, 6 + n))
            mask.append(at[:width] + n <= length[:, None])
    word = np.zeros(len(lower), dtype=np.uint64)
    for j in range(WORD_CHARS):
        word = word * np.uint64(0x100000001B3) + chars[:, j]
    ids.append(_hashed(word[:, None], 10))
    mask.append(np.array([w in lexicon for w in lower], dtype=bool)[:, None])
    return np.hstack(ids), np.hstack(mask)


def emissions(types: np.ndarray, model: Model) -> np.ndarray:
    out = np.empty((len(types), len(model.languages)), dtype=np.float64)
    for lo in range(0, len(types), 4096):
        ids, mask = features(types[lo : lo + 4096], model.lexicon)
        # Row 0 of the padded table is zero: features that a word lacks.
        out[lo : lo + 4096] = model.weights[np.where(mask, ids + 1, 0)].sum(axis=1)
    return out


def _exp(scores: np.ndarray) -> np.ndarray:
    return np.exp(scores - scores.max(axis=-1, keepdims=True))


def posteriors(word_type: np.ndarray, doc: np.ndarray, emission: np.ndarray, model: Model) -> np.ndarray:
    """Language probabilities of each word, by forward-backward over each document's words.

    Documents are cut into segments of fixed length, and all segments go forward and backward in
    step, as vectors: memory is words times languages. What enters a segment of a longer document comes
    first, from products of transition and emission matrices of the segments between its ends, which
    gives exactly the messages of the unsegmented chain. With many languages these products
    cost more than going through a document word by word, so that documents are not cut.
    """
    n, size = len(word_type), emission.shape[1]
    if not n:
        return np.zeros((0, size))
    heads = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
    lengths = np.diff(np.append(heads, n))
    segment = SEGMENT if size <= MOST_CUT_LANGUAGES else int(lengths.max())
    parts = (lengths + segment - 1) // segment
    first = np.concatenate(([0], np.cumsum(parts)))[:-1]
    base = np.repeat(heads, parts) + (np.arange(int(parts.sum())) - np.repeat(first, parts)) * segment
    filled = np.diff(np.append(base, n))
    table = _exp(emission)
    move, start = np.exp(model.transitions - model.transitions.max()), np.exp(model.start - model.start.max())

    def forward(own: np.ndarray, entering: np.ndarray, heading: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
        """What leaves the segments ``own``, the longest of which come first; ``heading``: those that begin a document."""
        a = entering.copy()
        running = np.searchsorted(-filled[own], -np.arange(filled[own[0]]), side="left")
        for t, k in enumerate(running):
            # The first word of a document follows the start scores, whatever entered.
            moved = np.where(heading[:k, None], start, a[:k] @ move) if t == 0 else a[:k] @ move
            moved *= table[word_type[base[own[:k]] + t]]
            moved /= moved.sum(axis=1, keepdims=True)
            a[:k] = moved
            if out is not None:
                out[base[own[:k]] + t] = moved
        return a

    def backward(own: np.ndarray, entering: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
        """The same from the right; ``out`` is multiplied by the messages."""
        b = entering.copy()
        running = np.searchsorted(-filled[own], -np.arange(filled[own[0]]), side="left")
        for t in range(len(running) - 1, -1, -1):
            k = running[t]
            at = base[own[:k]] + t
            if out is not None:
                out[at] *= b[:k]
            moved = (b[:k] * table[word_type[at]]) @ move.T
            b[:k] = moved / moved.sum(axis=1, keepdims=True)
        return b

    def products(own: np.ndarray) -> np.ndarray:
        """For whole segments ``own``, what they make of any message that enters."""
        p = np.broadcast_to(np.eye(size), (len(own), size, size)).copy()
        for t in range(segment):
            p = (p.reshape(-1, size) @ move).reshape(p.shape) * table[word_type[base[own] + t]][:, None, :]
            if t % 4 == 3:
                p /= p.sum(axis=(1, 2), keepdims=True)
        return p

    left, right = np.ones((len(base), size)), np.ones((len(base), size))
    cut = np.flatnonzero(parts > 1)
    if len(cut):
        # The ends of a document need vectors only. The segments between go in blocks, so that few matrices are held.
        heads_of, tails = first[cut], first[cut] + parts[cut] - 1
        tails = tails[np.argsort(-filled[tails], kind="stable")]
        left[heads_of + 1] = forward(heads_of, left[heads_of], np.ones(len(cut), dtype=bool))
        right[tails - 1] = backward(tails, right[tails])
        inner = np.ones(len(base), dtype=bool)
        inner[first] = inner[first + parts - 1] = False
        inner = np.flatnonzero(inner)
        block = max(1, HELD_PRODUCTS // (size * size))
        for lo in range(0, len(inner), block):
            own = inner[lo : lo + block]
            for s, p in zip(own, products(own)):
                x = left[s] @ p
                left[s + 1] = x / x.sum()
        for lo in range((len(inner) - 1) // block * block, -1, -block) if len(inner) else ():
            own = inner[lo : lo + block]
            for s, p in zip(own[::-1], products(own)[::-1]):
                x = p @ right[s]
                right[s - 1] = x / x.sum()

    # Segments from the longest to the shortest, so that those still running at a step are the first ones.
    order = np.argsort(-filled, kind="stable")
    heading = np.zeros(len(base), dtype=bool)
    heading[first] = True
    out = np.empty((n, size))
    forward(order, left[order], heading[order], out)
    backward(order, right[order], out)
    return out / out.sum(axis=1, keepdims=True)


def _train_batch(ids, mask, sequences, labels, weights, move, start):
    """Gradients of the log-likelihood of a block of equally long sequences."""
    count, steps = sequences.shape
    size = len(start)
    types, at = np.unique(sequences, return_inverse=True)
    at = at.reshape(sequences.shape)
    used = np.where(mask[types], ids[types] + 1, 0)
    emission = weights[used].sum(axis=1)
    e = _exp(emission)[at]
    m, s = np.exp(move), np.exp(start)
    alpha, beta = np.empty((steps, count, size)), np.empty((steps, count, size))
    a = s * e[:, 0]
    for t in range(steps):
        if t:
            a = (a @ m) * e[:, t]
        a = a / a.sum(axis=1, keepdims=True)
        alpha[t] = a
    b = np.ones((count, size))
    for t in range(steps - 1, -1, -1):
        beta[t] = b
        b = (b * e[:, t]) @ m.T
        b = b / b.sum(axis=1, keepdims=True)
    post = alpha * beta
    post /= post.sum(axis=2, keepdims=True)
    pair = np.zeros((size, size))
    for t in range(1, steps):
        a, b = alpha[t - 1], e[:, t] * beta[t]
        pair += (a / ((a @ m) * b).sum(axis=1, keepdims=True)).T @ b * m
    gold_pair = np.zeros((size, size))
    np.add.at(gold_pair, (labels[:, :-1].ravel(), labels[:, 1:].ravel()), 1)
    delta = np.eye(size)[labels] - post.transpose(1, 0, 2)
    by_type = np.stack([np.bincount(at.ravel(), delta[:, :, k].ravel(), len(types)) for k in range(size)], axis=1)
    flat = used.ravel()
    grad = np.stack([np.bincount(flat, np.repeat(by_type[:, k], used.shape[1]), len(weights)) for k in range(size)], axis=1)
    grad[0] = 0
    return grad / count, (gold_pair - pair) / count, (np.eye(size)[labels[:, 0]] - post[0]).mean(axis=0)


def train(texts: list[str], langs: list[str], steps: int = 128, run: int = 24, epochs: int = 4, rate: float = 0.3, seed: int = 11) -> Model:
    """Maximum likelihood by adaptive gradient steps over sequences strung from the documents' runs of words."""
    languages = tuple(sorted(set(langs)))
    rows = [([w.lower() for w in _WORD.findall(t)], languages.index(k)) for t, k in zip(texts, langs)]
    rows = [(w, k) for w, k in rows if w]
    words = pd.Series([w for ws, _ in rows for w in ws], dtype=object)
    if not len(words) or not languages:
        return Model(languages, np.zeros((2, max(len(languages), 1))), np.zeros((1, 1)), np.zeros(1), frozenset())
    code, types = pd.factorize(words)
    label = np.repeat([k for _, k in rows], [len(w) for w, _ in rows])
    common = np.argsort(-np.bincount(code), kind="stable")[:LEXICON_WORDS]
    lexicon = frozenset(types[common])
    ids, mask = features(np.asarray(types, dtype=object), lexicon)
    rng = np.random.default_rng(seed)
    size = len(languages)
    weights = np.zeros(((1 << FEATURE_BITS) + 1, size))
    move, start = np.zeros((size, size)), np.zeros(size)
    seen = [np.full_like(x, 1e-8) for x in (weights, move, start)]
    steps = min(steps, len(code))
    for _ in range(epochs):
        # Runs of 1 to 2 * run words, in random order: sequences that keep to a language and then switch.
        cuts = np.unique(np.concatenate(([0], np.cumsum(rng.integers(1, 2 * run, len(code) // run + 2)))))
        cuts = np.append(cuts[cuts < len(code)], len(code))
        runs = [np.arange(lo, hi) for lo, hi in zip(cuts, cuts[1:])]
        order = np.concatenate([runs[i] for i in rng.permutation(len(runs))])
        order = order[: len(order) // steps * steps].reshape(-1, steps)
        for lo in range(0, len(order), 256):
            block = order[lo : lo + 256]
            grads = _train_batch(ids, mask, code[block], label[block], weights, move, start)
            for value, grad, total in zip((weights, move, start), grads, seen):
                total += grad * grad
                value += rate * grad / np.sqrt(total)
    return Model(languages, weights, move, start, lexicon)


def fit(docs: DataFrame, sample_rows: int = 1200, sample_chars: int = 20_000) -> Model:
    """Learns from about ``sample_rows`` labelled rows of the learning folds, evenly from the languages.

    The bounds are on what is learned from alone: rows are taken by a hash of their id, of texts with
    more than ``sample_chars`` characters so many from a hashed place on, and the driver holds at most twice the rows.
    A language needs a row at least: of more than ``sample_rows`` languages the most frequent are learned.
    """
    usable = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.filter(F.col("text").rlike(r"\p{L}"))
    counts = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(sample_rows).collect()
    if not counts:
        return train([], [])
    each = max(sample_rows // len(counts), 1)
    share = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.0, each / r["count"]))])
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 20)) / float(1 << 20)
    place = F.pmod(F.xxhash64("doc_id", F.lit(23)), F.greatest(F.length("text") - sample_chars + 1, F.lit(1))).cast("int") + 1
    rows = (
        usable.filter(F.coalesce(drawn < share[F.col("lang")], F.lit(False)))
        .select("lang", F.substr("text", place, F.lit(sample_chars)).alias("text"), F.xxhash64("doc_id", F.lit(17)).alias("h"), "doc_id")
        .orderBy("h", "doc_id", "text")
        .limit(2 * sample_rows)
        .collect()
    )
    return train([r["text"] for r in rows], [r["lang"] for r in rows])


def _predict(texts: list[str | None], model: Model) -> tuple[list[str], list[float]]:
    found = [_WORD.findall(t) if t else [] for t in texts]
    counts = np.array([len(f) for f in found])
    code, types = pd.factorize(pd.Series([w for f in found for w in f], dtype=object))
    letters = np.array([w.isalpha() or any(c.isalpha() for c in w) for w in types], dtype=bool)
    doc = np.repeat(np.arange(len(texts)), counts)
    keep = letters[code] if len(code) else np.zeros(0, dtype=bool)
    code, doc = code[keep], doc[keep]
    post = posteriors(code, doc, emissions(np.asarray(types, dtype=object), model), model)
    size = len(model.languages)
    total = np.stack([np.bincount(doc, post[:, k], len(texts)) for k in range(size)], axis=1)
    n = np.bincount(doc, minlength=len(texts))
    best = total.argmax(axis=1)
    score = np.where(n > 0, total[np.arange(len(texts)), best] / np.maximum(n, 1), 0.0)
    return [model.languages[b] if k else UND for b, k in zip(best, n)], np.clip(score, 0.0, 1.0).tolist()


def identify(docs: DataFrame, model: Model, text: str = "text", lang_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its mean probability."""
    if {lang_out, score_out} & set(docs.columns):
        docs = docs.drop(lang_out, score_out)
    schema = T.StructType([*docs.schema.fields, T.StructField(lang_out, T.StringType()), T.StructField(score_out, T.DoubleType())])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            size = pc.fill_null(pc.utf8_length(column), 0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(size)
            lo, most = 0, _PIECE_CHARS * 4 // max(len(model.languages), 4)
            while lo < batch.num_rows:
                hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + most, side="right")))
                part = batch.slice(lo, hi - lo)
                if model.languages:
                    langs, scores = _predict(part.column(batch.schema.get_field_index(text)).to_pylist(), model)
                else:
                    langs, scores = [UND] * part.num_rows, [0.0] * part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                    names=[*batch.schema.names, lang_out, score_out],
                )
                lo = hi

    return docs.mapInArrow(predict, schema)
