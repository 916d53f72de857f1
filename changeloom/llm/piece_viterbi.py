"""Encoding into unigram pieces, and decoding, by Viterbi over a double-array trie.

A text is preceded by a space and spaces are the white-space marker. Among all ways to cut the text
into pieces of the vocabulary the one with the largest sum of log scores is taken. A character that no
piece covers costs more than any piece and becomes one piece per UTF-8 byte. Decoding joins the pieces,
turns markers into spaces and byte pieces into bytes, and drops the first space; every text comes back.

No piece holds a marker behind another character, so the best cut of a text is the best cuts of
its stretches (spaces and what follows up to the next space). Equal stretches of about a megabyte
of text are cut once, all of them together, position by position.

Log scores: those of the file where it is a unigram model. Merge-based files hold ranks; their piece
of rank r gets the log of Zipf's share 1 / ((r + 1) H). Pieces are ranked by score, then id.

Defined cases: a null or empty text has no pieces. The marker character itself, if a text has it,
is spelt in bytes, so it is not taken for a space. Of equally good cuts, the one whose last piece is longest is
taken, from the end backwards. Rows are independent; other columns pass through unless they are named
like the added ones; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, types as T

from . import textbytes
from .common import spread

MARKER = "▁"
FALLBACK_PENALTY = 10.0
#: Longer stretches are cut one by one.
LONG = 256


@dataclass(frozen=True)
class Pieces:
    """A vocabulary: pieces as bytes (space for the marker), scores, and the trie over them."""

    table: tuple[bytes, ...]  # what each id decodes to
    byte_ids: np.ndarray
    scores: np.ndarray  # by id
    fallback: float
    base: np.ndarray
    check: np.ndarray
    value: np.ndarray  # id of the piece that ends at a state, or -1


def double_array(keys: list[tuple[bytes, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``base, check, value``: from state s, byte b leads to ``t = base[s] + b`` if ``check[t] == s``."""
    keys = sorted(keys)
    size = 1 << 16
    base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    check[0] = 0  # the root; no byte leads to it, as bases are at least 1
    taken = np.zeros(size + 256, dtype=bool)
    taken[0] = True
    free_from = 1
    todo = [(0, 0, len(keys), 0)]
    while todo:
        state, lo, hi, depth = todo.pop()
        if len(keys[lo][0]) == depth:
            value[state] = keys[lo][1]
            lo += 1
        if lo == hi:
            continue
        first = [lo]
        for k in range(lo + 1, hi):
            if keys[k][0][depth] != keys[first[-1]][0][depth]:
                first.append(k)
        codes = np.array([keys[k][0][depth] for k in first])
        while taken[free_from]:
            free_from += 1
        at = free_from
        while True:
            if at + 4096 + 512 > size:
                grow = size
                base, check, value = np.append(base, np.zeros(grow, np.int32)), np.append(check, np.full(grow, -1, np.int32)), np.append(value, np.full(grow, -1, np.int32))
                taken = np.append(taken, np.zeros(grow, bool))
                size += grow
            slots = np.arange(at, at + 4096)
            slots = slots[~taken[at : at + 4096] & (slots > codes[0])] - codes[0]
            for c in codes[1:]:
                slots = slots[~taken[slots + c]]
            if len(slots):
                break
            at += 4096
        base[state] = slots[0]
        for k, c, end in zip(first, codes, [*first[1:], hi]):
            there = int(slots[0] + c)
            taken[there], check[there] = True, state
            todo.append((there, k, end, depth + 1))
    used = int(np.flatnonzero(taken)[-1]) + 257
    return tuple(np.append(x, np.full(257, fill, np.int32))[:used] for x, fill in ((base, 0), (check, -1), (value, -1)))


def vocabulary(table: list[bytes], scores: list[float], byte_ids: list[int], usable: list[int]) -> Pieces:
    """From what ids decode to, their log scores, the ids of the 256 bytes and those that text may be cut into."""
    base, check, value = double_array([(table[i], i) for i in usable])
    scores = np.asarray(scores, dtype=np.float64)
    fallback = float(scores[usable].min()) - FALLBACK_PENALTY
    return Pieces(tuple(table), np.asarray(byte_ids, dtype=np.int32), scores, fallback, base, check, value)


def load(path: str) -> Pieces:
    """Pieces and scores of a sentencepiece file."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    table, usable, byte_ids = [b""] * n, [], [-1] * 256
    for i in range(n):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
            table[i] = bytes([int(piece[3:5], 16)])
        elif not (model.is_control(i) or model.is_unknown(i)):
            if MARKER in piece.lstrip(MARKER):
                raise ValueError(f"piece {i} holds a marker behind another character")
            table[i] = piece.replace(MARKER, " ").encode()
            usable.append(i)
    scores = np.array([model.get_score(i) for i in range(n)])
    own = scores[usable]
    if np.all(own <= 0) and np.all(own == np.round(own)):
        order = np.lexsort((usable, -own))
        harmonic = np.sum(1.0 / np.arange(1, len(usable) + 1))
        scores = np.zeros(n)
        scores[np.asarray(usable)[order]] = -np.log(np.arange(1, len(usable) + 1) * harmonic)
    return vocabulary(table, scores, byte_ids, usable)


def _char_bytes(lead: np.ndarray) -> np.ndarray:
    return 1 + (lead >= 0xC0).astype(np.int64) + (lead >= 0xE0) + (lead >= 0xF0)


def _cut_together(text: np.ndarray, sizes: np.ndarray, p: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Best pieces of padded rows of bytes: ``(row, id)`` in order, id -1 - byte for a fallback byte."""
    rows, width = text.shape
    best = np.full((rows, width + 5), -np.inf)
    best[:, 0] = 0.0
    came = np.zeros((rows, width + 5), dtype=np.int32)  # bytes of the piece that ends here
    which = np.full((rows, width + 5), -1, dtype=np.int32)
    for i in range(width):
        own = np.flatnonzero((best[:, i] > -np.inf) & (i < sizes))
        if not len(own):
            continue
        score = best[own, i]
        at, state, so_far = own, np.zeros(len(own), dtype=np.int64), score
        for j in range(i, width):
            there = p.base[state] + text[at, j]
            ok = (p.check[there] == state) & (j < sizes[at]) & (there > 0)
            at, so_far, state = at[ok], so_far[ok], there[ok]
            if not len(at):
                break
            piece = p.value[state]
            ends = piece >= 0
            row, total = at[ends], so_far[ends] + p.scores[piece[ends]]
            better = total > best[row, j + 1]
            row = row[better]
            best[row, j + 1] = total[better]
            came[row, j + 1] = j + 1 - i
            which[row, j + 1] = piece[ends][better]
        step = np.minimum(_char_bytes(text[own, i]), sizes[own] - i)
        better = score + p.fallback > best[own, i + step]
        row, step = own[better], step[better]
        best[row, i + step] = score[better] + p.fallback
        came[row, i + step] = step
        which[row, i + step] = -1
    at, place = np.arange(rows), sizes.copy()
    out_row, out_place, out_id = [], [], []
    while len(at):
        keep = place[at] > 0
        at = at[keep]
        here = place[at]
        size, piece = came[at, here], which[at, here]
        whole = piece >= 0
        out_row.append(at[whole])
        out_place.append(here[whole])
        out_id.append(piece[whole])
        spelt, length = at[~whole], size[~whole].astype(np.int64)
        if len(spelt):
            row = np.repeat(spelt, length)
            at_byte = spread(here[~whole] - length, length)
            out_row.append(row)
            out_place.append(at_byte + 1)
            out_id.append(-1 - text[row, at_byte].astype(np.int32))
        place[at] -= size
    row, place, piece = np.concatenate(out_row), np.concatenate(out_place), np.concatenate(out_id)
    order = np.lexsort((place, row))
    return row[order], piece[order]


def _cut_one(text: bytes, p: Pieces) -> list[int]:
    """The same for one long stretch, over plain lists."""
    base, check, value, scores = p.base, p.check, p.value, p.scores
    n = len(text)
    best = [-np.inf] * (n + 1)
    best[0] = 0.0
    came, which = [0] * (n + 1), [-1] * (n + 1)
    steps: dict[tuple[int, int], int] = {}
    for i in range(n):
        score = best[i]
        if score == -np.inf:
            continue
        state = 0
        for j in range(i, n):
            key = (state, text[j])
            there = steps.get(key)
            if there is None:
                there = int(base[state]) + text[j]
                there = there if there > 0 and check[there] == state else -1
                steps[key] = there
            if there < 0:
                break
            state = there
            piece = value[state]
            if piece >= 0 and score + scores[piece] > best[j + 1]:
                best[j + 1], came[j + 1], which[j + 1] = score + scores[piece], j + 1 - i, int(piece)
        lead = text[i]
        end = min(n, i + 1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0))
        if score + p.fallback > best[end]:
            best[end], came[end], which[end] = score + p.fallback, end - i, -1
    out, at = [], n
    while at:
        if which[at] >= 0:
            out.append(which[at])
        else:
            out += [-1 - b for b in reversed(text[at - came[at] : at])]
        at -= came[at]
    return out[::-1]


def encode_flat(data: np.ndarray, offsets: np.ndarray, p: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(ids, offsets of the rows, fallback bytes of the rows)`` of rows of bytes."""
    filled = np.diff(offsets) > 0
    data = np.insert(data, offsets[:-1][filled], 0x20)
    offsets = offsets + np.concatenate(([0], np.cumsum(filled)))
    space = data == 0x20
    head = space.copy()
    head[1:] &= ~space[:-1]
    head[offsets[:-1][filled]] = True
    starts = np.flatnonzero(head)
    ends = np.append(starts[1:], len(data))[: len(starts)]
    row_of = np.searchsorted(starts, offsets)
    _, sample, kind = np.unique(textbytes.span_hashes(data, starts, ends), return_index=True, return_inverse=True)
    first, size = starts[sample], ends[sample] - starts[sample]
    lists_row, lists_id = [], []
    long = np.flatnonzero(size > LONG)
    for k in long:
        ids = _cut_one(data[first[k] : first[k] + size[k]].tobytes(), p)
        lists_row.append(np.full(len(ids), k))
        lists_id.append(np.array(ids, dtype=np.int32))
    short = np.flatnonzero(size <= LONG)
    short = short[np.argsort(size[short], kind="stable")]
    hi = 0
    for width in (6, 8, 10, 12, 16, 24, 32, 64, 128, LONG):
        lo, hi = hi, int(np.searchsorted(size[short], width, side="right"))
        for part in range(lo, hi, 65536):
            own = short[part : min(part + 65536, hi)]
            text = np.zeros((len(own), width), dtype=np.uint8)
            text[np.repeat(np.arange(len(own)), size[own]), spread(np.zeros(len(own), dtype=np.int64), size[own])] = data[spread(first[own], size[own])]
            row, ids = _cut_together(text, size[own], p)
            lists_row.append(own[row])
            lists_id.append(ids)
    if not lists_row:
        return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64), np.zeros(len(offsets) - 1, np.int64)
    row, ids = np.concatenate(lists_row), np.concatenate(lists_id)
    order = np.argsort(row, kind="stable")
    ids = ids[order]
    count = np.bincount(row, minlength=len(size))
    begin = np.cumsum(count) - count
    spelt = np.bincount(row, weights=np.concatenate(lists_id) < 0, minlength=len(size)).astype(np.int64)
    out = ids[spread(begin[kind], count[kind])]
    out = np.where(out < 0, p.byte_ids[np.where(out < 0, -1 - out, 0)], out)
    pieces = np.concatenate(([0], np.cumsum(count[kind])))
    fallback = np.concatenate(([0], np.cumsum(spelt[kind])))
    return out.astype(np.int32), pieces[row_of], np.diff(fallback[row_of])


def decode_ids(ids: np.ndarray, p: Pieces) -> bytes:
    """The text of a row of ids, as bytes."""
    table = p.table
    return b"".join([table[i] for i in ids.tolist()])[1:]


def encode(docs: DataFrame, pieces: Pieces, text: str = "text") -> DataFrame:
    """``docs`` with ``ids``, ``n_pieces`` and ``n_fallback``, the pieces that are single bytes for want of another."""
    added = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_pieces", T.LongType()), T.StructField("n_fallback", T.LongType())]
    docs = docs.drop(*[f.name for f in added])
    names = [*docs.columns, *[f.name for f in added]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in textbytes.pieces(batch.column(batch.schema.get_field_index(text))):
                ids, bounds, spelt = encode_flat(data, offsets, pieces)
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(lo, hi - lo).columns, lists, pa.array(np.diff(bounds), pa.int64()), pa.array(spelt, pa.int64())], names=names
                )

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *added]))


def decode(rows: DataFrame, pieces: Pieces, ids: str = "ids", text_out: str = "decoded") -> DataFrame:
    """``rows`` with the text of their ids; bytes that are no UTF-8 become the replacement character."""
    rows = rows.drop(text_out)
    names = [*rows.columns, text_out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            texts = [decode_ids(x.values.to_numpy(), pieces).decode("utf-8", "replace") if x.is_valid else None for x in column]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=names)

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(text_out, T.StringType())]))
