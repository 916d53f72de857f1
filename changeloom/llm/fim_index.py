"""Fill-in-middle transformation by a sparse index of multibyte characters.

A text is cut at two places, and its three parts are put in an order that lets a model learn to fill the middle:
psm is ``<P>`` prefix ``<S>`` suffix ``<M>`` middle, spm is ``<S>`` suffix ``<P>`` prefix ``<M>`` middle. Places count units:
tokens (white space with the word after it; white space at the end is a token) or characters (code points).

Texts stay UTF-8 bytes throughout. Of each block of bytes only the multibyte characters are recorded: their positions
and how many bytes more than one they take. ``searchsorted`` over these turns a place in code points into one in
bytes and back; between exceptions, and so in all of an ASCII text, that is plain arithmetic. Token ends are
found in bytes, as no byte of a multibyte character looks like white space.

Where the cuts fall, and which form a text takes, follows from a hash of seed and document id: h1 to h4 are the first four
32-bit numbers of sha256("seed:id"). The cuts are at h1 and h2 modulo units + 1. The text stays plain if
it is empty, holds a marker, or h3 % 100 >= ``rate``; it becomes spm if h4 % 100 < ``spm``, else psm.

One pass without a shuffle. A text is walked in blocks of ``BLOCK_BYTES``, of which only counts are kept, so memory beside the
text itself does not follow its length.

Defined cases: a null text counts as empty and comes out as an empty output; a null id hashes like an empty one; rows
with the same id are cut at places of the same hash. Columns that are named like added ones are replaced, the
others pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from . import textbytes

BLOCK_BYTES = 1 << 20
BATCH_BYTES = 4 << 20
MARKERS = ("<P>", "<S>", "<M>")
ADDED = T.StructType(
    [
        T.StructField("n", T.LongType()),
        T.StructField("form", T.StringType()),
        T.StructField("prefix_chars", T.LongType()),
        T.StructField("middle_chars", T.LongType()),
        T.StructField("prefix_bytes", T.LongType()),
        T.StructField("middle_bytes", T.LongType()),
        T.StructField("output", T.StringType()),
    ]
)
_TYPES = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())

_WORD = np.ones(256, dtype=bool)
_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
_EXCESS = np.zeros(256, dtype=np.int64)
_EXCESS[0xC0:0xE0], _EXCESS[0xE0:0xF0], _EXCESS[0xF0:] = 1, 2, 3


class Exceptions:
    """The multibyte characters of a stretch of bytes that starts at a character."""

    def __init__(self, data: np.ndarray):
        self.size = len(data)
        self.at = np.flatnonzero(data >= 0xC0)
        self.excess = np.concatenate(([0], np.cumsum(_EXCESS[data[self.at]])))

    @property
    def chars(self) -> int:
        return self.size - int(self.excess[-1])

    def char_of(self, byte: int) -> int:
        """Characters before a byte position that is the start of a character or the end."""
        return byte - int(self.excess[np.searchsorted(self.at, byte)])

    def byte_of(self, char: int) -> int:
        """Bytes before a character, or before the end."""
        return char + int(self.excess[np.searchsorted(self.at - self.excess[:-1], char)])


def _blocks(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of the blocks of a text; none starts inside a character."""
    at = 0
    while at < len(data):
        end = min(at + BLOCK_BYTES, len(data))
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end += 1
        yield at, end
        at = end


def _word_ends(data: np.ndarray, start: int, end: int) -> np.ndarray:
    """Ends of the words that end in a block; a word may go on from the block before."""
    inside = _WORD[data[start : end + 1]]
    ends = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    if end == len(data) and inside[-1]:
        ends = np.append(ends, len(inside))
    return start + ends


class Units:
    """Numbers and places of the units of one text."""

    def __init__(self, data: np.ndarray, unit: str):
        self.data, self.unit = data, unit
        self.blocks = list(_blocks(data))
        self.chars_before, self.units_before = [0], [0]
        for start, end in self.blocks:
            chars = Exceptions(data[start:end]).chars
            units = chars if unit == "char" else len(_word_ends(data, start, end))
            self.chars_before.append(self.chars_before[-1] + chars)
            self.units_before.append(self.units_before[-1] + units)
        self.n = self.units_before[-1]
        if unit == "token" and len(data) and not _WORD[data[-1]]:
            self.n += 1

    def cut(self, count: int) -> tuple[int, int]:
        """Bytes and characters that the first ``count`` units take."""
        if count == 0:
            return 0, 0
        if count >= self.n:
            return len(self.data), self.chars_before[-1]
        block = int(np.searchsorted(self.units_before, count)) - 1
        start, end = self.blocks[block]
        index = Exceptions(self.data[start:end])
        inside = count - self.units_before[block]
        if self.unit == "char":
            return start + index.byte_of(inside), count
        byte = int(_word_ends(self.data, start, end)[inside - 1])
        return byte, self.chars_before[block] + index.char_of(byte - start)


def _numbers(seed: int, doc_id: int | None) -> np.ndarray:
    name = "" if doc_id is None else doc_id
    return np.frombuffer(hashlib.sha256(f"{seed}:{name}".encode()).digest()[:16], dtype=">u4")


def _transformed(data: np.ndarray, doc_id: int | None, seed: int, rate: int, spm: int, unit: str, marks: tuple[bytes, ...]) -> tuple:
    raw, units = data.tobytes(), Units(data, unit)
    h1, h2, h3, h4 = (int(h) for h in _numbers(seed, doc_id))
    if not raw or h3 % 100 >= rate or any(mark in raw for mark in marks):
        return units.n, "plain", None, None, None, None, raw
    places = sorted((h1 % (units.n + 1), h2 % (units.n + 1)))
    (a, a_chars), (b, b_chars) = units.cut(places[0]), units.cut(places[1])
    prefix_mark, suffix_mark, middle_mark = marks
    if h4 % 100 < spm:
        form, parts = "spm", (suffix_mark, raw[b:], prefix_mark, raw[:a], middle_mark, raw[a:b])
    else:
        form, parts = "psm", (prefix_mark, raw[:a], suffix_mark, raw[b:], middle_mark, raw[a:b])
    return units.n, form, a_chars, b_chars - a_chars, a, b - a, b"".join(parts)


def fill_in_middle(
    docs: DataFrame,
    seed: int = 42,
    rate: int = 50,
    spm: int = 80,
    unit: str = "token",
    markers: tuple[str, str, str] = MARKERS,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``docs`` with units, form, lengths of prefix and middle, and ``output``; the text itself is left out."""
    if unit not in ("token", "char"):
        raise ValueError(f"unit must be 'token' or 'char', got {unit!r}")
    marks = tuple(m.encode() for m in markers)
    others = [f for f in docs.schema.fields if f.name not in (*ADDED.names, text)]
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"), F.struct(*[f.name for f in others]).alias("_row"))

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for lo, hi, data, offsets in textbytes.pieces(batch.column(1), BATCH_BYTES):
                found = [
                    _transformed(data[offsets[i] : offsets[i + 1]], ids[lo + i], seed, rate, spm, unit, marks)
                    for i in range(hi - lo)
                ]
                added = [pa.array(c, t) for c, t in zip(zip(*found), _TYPES)]
                kept = batch.column(2).slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([kept, *added], names=["_row", *ADDED.names])

    shape = T.StructType([T.StructField("_row", T.StructType(others)), *ADDED.fields])
    return rows.mapInArrow(transform, shape).select("_row.*", *ADDED.names)


def restored(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text, from output and form alone.

    A text that holds a marker is plain, and no marker can arise where two parts meet, as each begins with a
    character that is in none of them again; so the first place of a marker is its own.
    """
    prefix_mark, suffix_mark, middle_mark = markers
    first, second = (F.when(form == "psm", F.lit(x)).otherwise(F.lit(y)) for x, y in ((prefix_mark, suffix_mark), (suffix_mark, prefix_mark)))
    start, middle = F.instr(output, second), F.instr(output, F.lit(middle_mark))
    one = F.substring(output, F.length(first) + 1, start - F.length(first) - 1)
    two = F.substring(output, start + F.length(second), middle - start - F.length(second))
    last = F.substring(output, middle + len(middle_mark), F.length(output))
    psm, spm = F.concat(one, last, two), F.concat(two, last, one)
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
  FROM documents
), k AS (
  SELECT *, len(u) AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
         ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4
  FROM d
), c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM k
), p AS (
  SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:], '') AS suffix
  FROM c
)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""
