"""Toxicity of disguised text by a noisy channel: restore the likeliest plain writing, then score it.

*Channel.* A writer may put look-alikes for letters (leetspeak), put single separators between letters, and repeat
letters. A stretch that shows such signs (a look-alike beside letters, three equal letters in a row, three or more
single characters in a row, or a word chopped by separators) becomes a lattice: each run of equal characters may
stand for one or two of a letter, a look-alike for any of its letters or for itself, a separator for nothing or
for a space. Each reading has a cost, as the channel has written it so.

*Source.* A character language model, P(c | the two characters before), over a to z, any other letter, and the gap between
words. Its counts are those of all texts of the corpus, summed by Spark; smoothing goes by the shorter contexts.

*Decoding.* The Viterbi path through the lattice, exact over all pairs of last characters, many stretches at once. A stretch longer than
``WINDOW`` runs is decoded in windows that overlap by ``MARGIN``, of which the middles count.

*Score.* Logistic regression on the words of the restored text and their stems, told apart by how often a text has them. Labels are learned from at most ``SAMPLE_ROWS`` rows,
drawn by a hash of their id, only of ids with crc32 mod 3 not 1 (``held_out``). Which of these features count is decided over the sample by Spark: those in
at least ``LEAST_ROWS`` rows whose labels they part with a likelihood ratio of ``LEAST_RATIO`` or more.

Two passes over the corpus without a shuffle of texts: counts, then scores. Texts are walked in stretches.

Defined cases: null and empty texts, and texts without known words, have the score of a text without signs. A document labelled more
than once is toxic if any label says so; null labels and null ids are not learned from. Without labels of both kinds every score is the
share of toxic ones among those there are (0 without any). Rows are scored each by itself; an input column ``score`` is
replaced, others pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from . import textbytes
from .common import spread, stored
from .stretches import spans, stretches

SAMPLE_ROWS = 8_000
LEAST_ROWS = 3
LEAST_RATIO = 15.0
#: Characters of a stem, which words of one root share.
STEM = 5
#: How often a text has to have a word or stem, for one feature each.
LEVELS = (1, 2, 4)
WINDOW = 256
MARGIN = 32
#: Runs of characters that are decoded at once, about.
BLOCK = 8_192

# What look-alikes stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "gq",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c",
}
SEPARATORS = " \t\n\v\f\r.-_*,'~/"
# Those that may begin or end a word; the others do so as punctuation.
EDGES = "@$"

# Costs of readings, as negative logarithms.
_AS_LETTER, _AS_ITSELF = 1.0, 9.0  # each look-alike
_PARTED, _WIDE_JOINED = 5.0, 4.0  # a single separator that parts words, several that do not
_REPEATED, _DOUBLE_AS_ONE = 0.5, 6.0  # three and more of a letter, two that mean one

LETTERS = 28
_OTHER, _GAP = 26, 27
_STATES = LETTERS * LETTERS
_NEVER = np.float32(-1e9)

_SYMBOL = np.full(256, _GAP, dtype=np.int64)
_SYMBOL[ord("a") : ord("z") + 1] = np.arange(26)
_SYMBOL[ord("A") : ord("Z") + 1] = np.arange(26)
_SYMBOL[0x80:] = _OTHER


def _bytes(*chars: str) -> np.ndarray:
    mask = np.zeros(256, dtype=bool)
    for c in chars:
        mask[ord(c)] = True
    return mask


_SPACE = _bytes(*" \t\n\v\f\r")
_LETTER = _SYMBOL < _OTHER
_LIKE, _EDGE = _bytes(*LOOKALIKES), _bytes(*EDGES)
_PARTING = _bytes(*SEPARATORS) & ~_SPACE
_BASE = np.uint64(2**64 - 4)
_BEYOND = np.arange(256) >= 0x80
_WORD = _LETTER | _BEYOND
_CORE = _WORD | _bytes(*"0123456789")


def _between(data: np.ndarray) -> np.ndarray:
    """White space between words of two letters and more: no stretch of single characters is cut there."""
    marked = np.zeros(len(data), dtype=bool)
    if len(data) > 4:
        word = _WORD[data]
        marked[2:-2] = _SPACE[data[2:-2]] & word[:-4] & word[1:-3] & word[3:-1] & word[4:]
    return marked


# Language model


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of three characters in a row, a task's rows of a table of at most ``LETTERS ** 3`` rows."""
    total = np.zeros(LETTERS**3, dtype=np.int64)
    for batch in batches:
        for _, _, data, offsets in stretches(batch.column(0), _between):
            total += grams(data, offsets)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["gram", "n"])


def grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of (two characters before, character) over the words of the texts; a gap comes before and after each."""
    inside = _WORD[data]
    starts, ends, _ = spans(inside, offsets)
    # All words one after the other, each with a gap behind it.
    sizes = ends - starts + 1
    at = np.cumsum(sizes) - sizes
    symbols = np.full(int(sizes.sum()), _GAP, dtype=np.int64)
    keep = np.ones(len(symbols), dtype=bool)
    keep[at + sizes - 1] = False
    symbols[keep] = _SYMBOL[data[spread(starts, ends - starts)]]
    if not len(symbols):
        return np.zeros(LETTERS**3, dtype=np.int64)
    one = np.concatenate(([_GAP], symbols[:-1]))
    two = np.where(one == _GAP, _GAP, np.concatenate(([_GAP, _GAP], symbols[:-2]))[: len(symbols)])
    return np.bincount((two * LETTERS + one) * LETTERS + symbols, minlength=LETTERS**3)


def language_model(counts: np.ndarray) -> np.ndarray:
    """log P(c | a, b) as an array by a, b, c; each length of context leans on the next shorter one. After a gap, a gap is free."""
    three = counts.reshape(LETTERS, LETTERS, LETTERS).astype(float)
    two = three.sum(axis=0)
    one = two.sum(axis=0)
    p1 = (one + 1) / (one.sum() + LETTERS)
    p2 = (two + 8 * p1) / (two.sum(axis=1, keepdims=True) + 8)
    p3 = (three + 8 * p2) / (three.sum(axis=2, keepdims=True) + 8)
    model = np.log(p3)
    model[:, _GAP, _GAP] = 0.0
    return model.astype(np.float32)


# Lattices

Reading = tuple[str, str, float]  # what it puts in the text, the characters the model sees, its cost


@lru_cache(maxsize=65_536)
def readings(char: str, run: int) -> tuple[Reading, ...]:
    """What a run of equal characters may stand for."""
    if char in SEPARATORS:
        gap = char * run if char.isspace() or run > 1 else " "
        return ("", "", 0.0 if run == 1 else _WIDE_JOINED), (gap, " ", _PARTED if run == 1 else 0.0)
    like = LOOKALIKES.get(char)
    letters, cost = (char.lower(), 0.0) if like is None else (like, _AS_LETTER)
    if like is None and not (len(letters) == 1 and "a" <= letters <= "z"):
        return ((char * run, "?" if char.isalpha() else " ", 0.0),)
    single = 0.0 if run == 1 else _DOUBLE_AS_ONE if run == 2 else _REPEATED
    found = [(c, c, cost + single) for c in letters]
    if run > 1:
        found += [(c + c, c + c, cost + (_REPEATED if run > 2 else 0.0)) for c in letters]
    if like is not None:
        found.append((char * run, " ", _AS_ITSELF * run))
    return tuple(found)


def lattice(text: str) -> list[tuple[Reading, ...]]:
    """The runs of a stretch and their readings."""
    found, at = [], 0
    while at < len(text):
        end = at + 1
        while end < len(text) and text[end].lower() == text[at].lower():
            end += 1
        found.append(readings(text[at].lower(), end - at))
        at = end
    return found


def _symbols(seen: str) -> tuple[int, ...]:
    return tuple(_GAP if c == " " else _OTHER if c == "?" else ord(c) - 97 for c in seen)


def _step(scores: np.ndarray, model: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One more character for each row: the best scores by (last, symbol) pair and the character that was given up."""
    # scores: rows x a x b; a row's symbol c takes state (a, b) to (b, c).
    all_ = scores + model[:, :, symbol].transpose(2, 0, 1)
    given = all_.argmax(axis=1)
    return np.take_along_axis(all_, given[:, None, :], axis=1)[:, 0, :], given.astype(np.uint8)


def viterbi(lattices: list[list[tuple[Reading, ...]]], model: np.ndarray) -> list[list[int]]:
    """The reading chosen at each run of each lattice; a gap is before and after each."""
    result: list[list[int]] = [[] for _ in lattices]
    order = sorted(range(len(lattices)), key=lambda i: len(lattices[i]))
    lo = 0
    while lo < len(order):
        # By length, so that runs x rows, and with them the memory of a block, are bounded.
        rows = max(1, BLOCK // max(len(lattices[order[min(lo + BLOCK // 16, len(order)) - 1]]), 1))
        own = order[lo : lo + rows]
        for i, choice in zip(own, _viterbi_block([lattices[i] for i in own], model)):
            result[i] = choice
        lo += rows
    return result


def _viterbi_block(block: list[list[tuple[Reading, ...]]], model: np.ndarray) -> list[list[int]]:
    rows, length = len(block), max(map(len, block))
    most = max((len(r) for one in block for r in one), default=0)
    # The symbols (none: -1) and cost of reading k at run j of each row; beyond its end a row keeps still.
    first, second = (np.full((length, most, rows), -1, dtype=np.int64) for _ in range(2))
    cost = np.full((length, most, rows), np.inf, dtype=np.float32)
    cost[:, 0, :] = 0.0
    for i, one in enumerate(block):
        for j, options in enumerate(one):
            for k, (_, seen, price) in enumerate(options):
                symbols = _symbols(seen)
                if symbols:
                    first[j, k, i] = symbols[0]
                    if len(symbols) > 1:
                        second[j, k, i] = symbols[1]
                cost[j, k, i] = price
    scores = np.full((rows, LETTERS, LETTERS), _NEVER, dtype=np.float32)
    scores[:, _GAP, _GAP] = 0.0
    chosen = np.zeros((length, rows, LETTERS, LETTERS), dtype=np.uint8)
    back = np.zeros((length, most, 2, rows, LETTERS), dtype=np.uint8)
    for j in range(length):
        best = np.full_like(scores, _NEVER)
        for k in range(most):
            here = np.flatnonzero(np.isfinite(cost[j, k]))
            if not len(here):
                continue
            still = here[first[j, k, here] < 0]
            if len(still):
                moved = scores[still] - cost[j, k, still][:, None, None]
                better = moved > best[still]
                best[still] = np.where(better, moved, best[still])
                chosen[j, still] = np.where(better, k, chosen[j, still])
            for double in (False, True):
                go = here[(first[j, k, here] >= 0) & ((second[j, k, here] >= 0) == double)]
                if not len(go):
                    continue
                symbol = first[j, k, go]
                reached, given = _step(scores[go], model, symbol)
                back[j, k, 0, go] = given
                last = symbol
                if double:
                    middle = np.full((len(go), LETTERS, LETTERS), _NEVER, dtype=np.float32)
                    middle[np.arange(len(go)), :, symbol] = reached
                    last = second[j, k, go]
                    reached, given = _step(middle, model, last)
                    back[j, k, 1, go] = given
                reached = reached - cost[j, k, go][:, None]
                before = best[go, :, last]
                better = reached > before
                best[go, :, last] = np.where(better, reached, before)
                chosen[j, go, :, last] = np.where(better, k, chosen[j, go, :, last])
        scores = best
    ended = scores + model[:, :, _GAP]
    state = ended.reshape(rows, -1).argmax(axis=1)
    found = []
    for i, one in enumerate(block):
        a, b = divmod(int(state[i]), LETTERS)
        path = []
        for j in range(length - 1, -1, -1):
            k = int(chosen[j, i, a, b])
            if second[j, k, i] >= 0:
                a, b = int(back[j, k, 1, i, a]), a
                a, b = int(back[j, k, 0, i, a]), a
            elif first[j, k, i] >= 0:
                a, b = int(back[j, k, 0, i, a]), a
            path.append(k)
        found.append(path[::-1][: len(one)])
    return found


def decode(texts: list[str], model: np.ndarray) -> list[str]:
    """The likeliest plain writing of each stretch."""
    lattices = [lattice(text) for text in texts]
    parts, whose = [], []
    for i, one in enumerate(lattices):
        for lo in range(0, len(one), WINDOW):
            start, end = max(lo - MARGIN, 0), min(lo + WINDOW + MARGIN, len(one))
            parts.append(one[start:end])
            whose.append((i, lo - start, min(WINDOW, len(one) - lo), lo))
    out: list[list[str]] = [[] for _ in texts]
    for (i, skip, size, lo), path in zip(whose, viterbi(parts, model)):
        out[i] += [lattices[i][lo + n][k][0] for n, k in enumerate(path[skip : skip + size])]
    return ["".join(pieces) for pieces in out]


# Finding what is disguised


def suspects(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches to restore, in order and apart."""
    starts, ends, first = spans(~_SPACE[data], offsets)
    if not len(starts):
        return starts, ends
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))

    # From the first to the last letter or digit; one or two look-alikes at an end belong to the word, more are decoration.
    sums = np.concatenate(([0], np.cumsum(_CORE[data])))
    places = np.append(np.flatnonzero(_CORE[data]), len(data))
    some = sums[ends] > sums[starts]
    lo = np.where(some, places[sums[starts]], starts)
    hi = np.where(some, places[np.maximum(sums[ends] - 1, 0)] + 1, ends)
    edge = np.concatenate((_EDGE[data], [False]))

    def grown(at: np.ndarray, step: int, end: np.ndarray) -> np.ndarray:
        out = at
        for reach in (1, 2, 3):
            more = some & (out == at + step * (reach - 1)) & (step * (end - out) > 0) & edge[out - (step < 0)]
            out = np.where(more, out + step, out)
        return np.where(out == at + 3 * step, at, out)

    lo, hi = grown(lo, -1, starts), grown(hi, 1, ends)

    def within(marked: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(marked)))
        return sums[hi] - sums[lo]

    letters, like, parting = within(_LETTER[data]), within(_LIKE[data]), within(_PARTING[data])
    lower = textbytes.LOWER[data]
    triple = np.zeros(len(data), dtype=bool)
    triple[2:] = _LETTER[data[2:]] & (lower[2:] == lower[1:-1]) & (lower[2:] == lower[:-2])
    mark = (letters > 0) & (like > 0)
    mark |= within(triple) > 0
    mark |= (parting >= 2) & (letters + like <= 2 * (parting + 1)) & (letters > 0)
    mark &= some
    single = (hi - lo == 1) & (letters + like == 1) & some
    # Runs of single characters are one stretch.
    change = np.flatnonzero(np.concatenate(([True], (single[1:] != single[:-1]) | (row[1:] != row[:-1]))))
    sizes = np.diff(np.append(change, len(single)))
    long = single[change] & (sizes >= 3)
    rest = mark & ~np.repeat(long, sizes)
    left = np.concatenate((lo[rest], lo[change[long]]))
    right = np.concatenate((hi[rest], hi[(change + sizes - 1)[long]]))
    order = np.argsort(left, kind="stable")
    return left[order], right[order]


def restore(data: np.ndarray, offsets: np.ndarray, model: np.ndarray, known: dict[bytes, bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts with their disguised stretches written plainly; ``known`` remembers stretches."""
    left, right = suspects(data, offsets)
    if not len(left):
        return data, offsets
    raw = data.tobytes()
    pieces = [raw[a:b] for a, b in zip(left, right)]
    new = list({p for p in pieces if p not in known})
    if len(known) + len(new) > 200_000:
        known.clear()
        new = list(set(pieces))
    for piece, plain in zip(new, decode([p.decode("utf-8", "replace") for p in new], model)):
        known[piece] = plain.encode()
    out, at, shift, grown = [], 0, np.zeros(len(left) + 1, dtype=np.int64), 0
    for n, (a, b, piece) in enumerate(zip(left, right, pieces)):
        plain = known[piece]
        out += [raw[at:a], plain]
        at, grown = b, grown + len(plain) - (b - a)
        shift[n + 1] = grown
    out.append(raw[at:])
    moved = offsets + shift[np.searchsorted(right, offsets, side="right")]
    return np.frombuffer(b"".join(out), dtype=np.uint8), moved


# Scores


@dataclass(frozen=True)
class Model:
    language: np.ndarray
    words: np.ndarray
    weights: np.ndarray
    bias: float


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def signs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(row, sign)`` of all words (A-Z as a-z), and of the stems of those with ``STEM`` characters or more."""
    starts, ends, first = spans(_WORD[data], offsets)
    lower, row = textbytes.LOWER[data], np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    chars = np.flatnonzero((data & 0xC0) != 0x80)
    stem = np.append(chars, np.full(STEM, len(data) + 1))[np.searchsorted(chars, starts) + STEM]
    stem[(stem > ends) & (np.searchsorted(chars, ends) - np.searchsorted(chars, starts) == STEM)] = 0
    stem = np.where(stem == 0, ends, stem)
    long = stem <= ends
    words = textbytes.span_hashes(lower, starts, ends)
    stems = textbytes.mixed(textbytes.span_hashes(lower, starts[long], stem[long]) + np.uint64(1))
    return np.concatenate((row, row[long])), np.concatenate((words, stems)) & _BASE


def _features(column: pa.Array, language: np.ndarray, known: dict[bytes, bytes], among: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """``(row, feature)`` of the restored texts; with ``among`` only features of these.

    A feature is a sign that a text has at least ``LEVELS[l]`` times: its hash, with l in the lowest bits.
    """
    rows, found, numbers = [], [], []
    bases = None if among is None else np.unique(among & _BASE)
    for lo, hi, data, offsets in stretches(column, _between):
        row, sign = signs(*restore(data, offsets, language, known))
        if bases is not None:
            place = np.searchsorted(bases, sign)
            place[place == len(bases)] = 0
            fits = bases[place] == sign if len(bases) else np.zeros(len(sign), dtype=bool)
            row, sign = row[fits], sign[fits]
        row, sign, number = _summed(row + lo, sign, np.ones(len(row), dtype=np.int64))
        rows.append(row)
        found.append(sign)
        numbers.append(number)
    if not rows:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    row, sign, number = _summed(np.concatenate(rows), np.concatenate(found), np.concatenate(numbers))
    row = np.concatenate([row[number >= least] for least in LEVELS])
    feature = np.concatenate([sign[number >= least] | np.uint64(level) for level, least in enumerate(LEVELS)])
    if among is not None and len(among):
        place = np.searchsorted(among, feature)
        place[place == len(among)] = 0
        fits = among[place] == feature
        row, feature = row[fits], feature[fits]
    order = np.lexsort((feature, row))
    return row[order], feature[order]


def _summed(row: np.ndarray, sign: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((sign, row))
    row, sign, number = row[order], sign[order], number[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (sign[1:] != sign[:-1])
    at = np.flatnonzero(new)
    return row[at], sign[at], np.add.reduceat(number, at) if len(at) else number


def train(row: np.ndarray, feature: np.ndarray, toxic: np.ndarray, features: int, rounds: int = 3000, decay: float = 0.01) -> tuple[np.ndarray, float]:
    """Weights and bias at the maximum of log likelihood less ``decay`` |weights|^2 / 2.

    Every round moves all of them by their slope over a bound of their curvature, which can only raise it.
    """
    weights, share = np.zeros(features), toxic.mean()
    bias = float(np.log(share / (1 - share)))
    size = np.bincount(row, minlength=len(toxic)) + 1.0
    bend = np.bincount(feature, size[row], features) / 4 + decay
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(bias + np.bincount(row, weights[feature], len(toxic)))))
        step = (np.bincount(feature, (toxic - p)[row], features) - decay * weights) / bend
        move = float((toxic - p).sum() / (size.sum() / 4))
        weights, bias = weights + step, bias + move
        if max(np.abs(step).max(initial=0.0), abs(move)) < 1e-6:
            break
    return weights, bias


def corpus_model(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The character language model of all texts."""
    rows = docs.select(F.col(text).alias("text")).mapInArrow(_gram_counts, "gram int, n long")
    counts = np.zeros(LETTERS**3, dtype=np.int64)
    for row in rows.groupBy("gram").agg(F.sum("n").alias("n")).collect():  # at most LETTERS ** 3 rows
        counts[row["gram"]] = row["n"]
    return language_model(counts)


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Language model of all of ``docs``, and weights from labelled rows that are not held out."""
    language = corpus_model(docs)
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("_toxic"))
    count = usable.count()
    h = F.xxhash64("doc_id", F.lit(17))
    drawn = F.pmod(h, F.lit(1 << 30)) < int(min(1.0, sample_rows / max(count, 1)) * (1 << 30))
    sample = F.broadcast(usable.filter(drawn).orderBy(h, "doc_id").limit(sample_rows))
    rows = docs.select("doc_id", "text").join(sample, "doc_id").select("doc_id", "_toxic", "text")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, bytes] = {}
        for batch in batches:
            row, found = _features(batch.column(2), language, known, None)
            bounds = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(found.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["doc_id", "toxic", "features"])

    known_rows = stored(rows.mapInArrow(extract, "doc_id long, toxic int, features array<long>"), "toxic-sample")
    sums = known_rows.agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")).first()
    n, toxic = sums["n"], sums["toxic"] or 0
    nothing = np.zeros(0, dtype=np.uint64)
    if not 0 < toxic < n:
        sure = 30.0 if toxic else -30.0
        return Model(language, nothing, np.zeros(0), sure)
    each = known_rows.select(F.explode("features").alias("feature"), "toxic").groupBy("feature")
    each = each.agg(F.count("*").alias("n"), F.sum("toxic").alias("t")).filter(F.col("n") >= LEAST_ROWS)
    chosen = each.filter(_likelihood_ratio(F.col("n"), F.col("t"), n, toxic) >= LEAST_RATIO).select("feature")
    words = np.sort(chosen.toArrow().column("feature").to_numpy().view(np.uint64))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [np.array(own, dtype=np.int64).view(np.uint64) for own in batch.column(2).to_pylist()]
            found = pa.array([np.flatnonzero(np.isin(words, own)).tolist() for own in lists], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), found], names=["doc_id", "toxic", "places"])

    rows = known_rows.mapInArrow(places, "doc_id long, toxic int, places array<int>").orderBy("doc_id", "places").collect()
    sizes = [len(r["places"]) for r in rows]
    feature = np.array([place for r in rows for place in r["places"]], dtype=np.int64)
    is_toxic = np.array([r["toxic"] for r in rows], dtype=float)
    weights, bias = train(np.repeat(np.arange(n), sizes), feature, is_toxic, len(words))
    return Model(language, words, weights, bias)


def _likelihood_ratio(n: Column, t: Column, rows: int, toxic: int) -> Column:
    """Twice the logarithm of how much better labels are told with the word than without."""

    def gain(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(F.lit(0.0))

    cells = [
        (t, n * toxic / rows),
        (n - t, n * (rows - toxic) / rows),
        (F.lit(toxic) - t, (F.lit(rows) - n) * toxic / rows),
        (F.lit(rows - toxic) - (n - t), (F.lit(rows) - n) * (rows - toxic) / rows),
    ]
    return 2 * sum((gain(seen.cast("double"), expected) for seen, expected in cells), F.lit(0.0))


def score(docs: DataFrame, model: Model, text: str = "text", restored: str | None = None) -> DataFrame:
    """``docs`` with ``score``, the chance that the restored text is toxic, and on demand the restored text as column ``restored``."""
    docs = docs.drop("score", *([restored] if restored else []))
    chunk = docs.sparkSession.sparkContext.broadcast(model)  # at most LETTERS ** 3 numbers and the words of a sample
    others = T.StructType(docs.schema.fields)
    added = [T.StructField("score", T.DoubleType())] + ([T.StructField(restored, T.StringType())] if restored else [])
    rows = docs.select(F.col(text).alias("_text"), F.struct(*docs.columns).alias("_row"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known = chunk.value, {}
        for batch in batches:
            row, found = _features(batch.column(0), own.language, known, own.words)
            total = own.bias + np.bincount(row, own.weights[np.searchsorted(own.words, found)], batch.num_rows)
            columns = [pa.array(1 / (1 + np.exp(-np.clip(total, -30, 30))))]
            if restored:
                columns.append(_restored(batch.column(0), own.language, known))
            yield pa.RecordBatch.from_arrays([batch.column(1), *columns], names=["_row", *[f.name for f in added]])

    shape = T.StructType([T.StructField("_row", others), *added])
    return rows.mapInArrow(judge, shape).select("_row.*", *[f.name for f in added])


def _restored(column: pa.Array, language: np.ndarray, known: dict[bytes, bytes]) -> pa.Array:
    parts: list[list[bytes]] = [[] for _ in range(len(column))]
    for lo, hi, data, offsets in stretches(column, _between):
        plain, moved = restore(data, offsets, language, known)
        raw = plain.tobytes()
        for i in range(hi - lo):
            parts[lo + i].append(raw[moved[i] : moved[i + 1]])
    return pa.array([b"".join(p) for p in parts], pa.string())
