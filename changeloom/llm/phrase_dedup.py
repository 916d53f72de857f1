"""Removal of repeated byte strings by prefix-free parsing.

A byte is removed when a string of ``length`` bytes that covers it also starts in a document with a
smaller id. All such strings must be found, in a corpus too large for one suffix array:

1. *Parse.* A rolling hash of every ``GRAM`` bytes is taken; the smallest one within each string of
   ``length`` bytes is its trigger, so every string has one, and equal strings have equal ones. The
   starts that share a trigger, with the ``length - 1`` bytes that follow, are a phrase: phrases
   overlap by ``length - 1`` bytes, so each string of the text is inside exactly one of them.
2. *Which triggers matter.* Only triggers whose bytes occur in two documents can bring a repeat.
   Hashes of triggers are packed by bucket and compared there; a task sends a trigger once, however
   often it occurs, so a passage of a third of all documents is one row per task.
3. *Dictionary.* The phrases at those triggers are gathered by trigger hash. Equal phrases are one
   entry; where it occurs again, in a document with a larger id, the whole phrase is repeated (the
   order of the parse). Entries with the same trigger are compared in the order of their suffixes,
   cut at ``length``: equal neighbours in this order are the strings that two entries share. A trigger
   with more than ``HOT_PHRASES`` phrases, as at the edges of a passage that many documents share, would
   be one task's work; its phrases are sent as single strings instead, each to the bucket of its own
   hash, and each task sends a string once. The list of such triggers is at most the number of
   phrases divided by ``HOT_PHRASES``.
4. The repeated ranges are united by document and cut from the text.

Strings are compared as bytes in step 3; hashes only decide what is compared (phrases: 128 bits).

Defined cases: a null text is empty; texts shorter than ``length`` are kept whole. Repeated rows
with one id are one document's texts and never remove from each other. A row without id is kept
whole and removes nothing. Other columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T

from . import textbytes
from .common import BUCKETED_DDL, KEY_BYTES, KEYS_PER_BUCKET, bucketed, runs, spread, stored, text_bytes, unbucketed

GRAM = 24
#: A trigger comes once in about this many bytes.
TRIGGER_BYTES = 14
#: What a task holds before it packs: triggers, and phrases of about 70 bytes.
HELD_KEYS = 500_000
HELD_PHRASES = 100_000
DICTIONARY_PHRASES = 20_000
#: Phrases of a trigger that are compared in one place.
HOT_PHRASES = 20_000

_LUT = np.random.default_rng(977).integers(0, 1 << 63, 256, dtype=np.uint64)
_LOW = np.uint64((1 << 24) - 1)


def _grams(data: np.ndarray) -> np.ndarray:
    """Hashes of all ``GRAM``-byte strings."""
    part, width, place = _LUT[data], 1, GRAM
    found = None  # of the last bytes of the string, those from ``place`` on
    with np.errstate(over="ignore"):
        factor = np.uint64(0x100000001B3)
        power = np.uint64(1)  # factor to the number of bytes found so far
        base = factor
        while True:
            if GRAM & width:
                place -= width
                own = part[place : len(data) - GRAM + 1 + place]
                found = own if found is None else own * power + found
                power = power * base
            if width * 2 > GRAM:
                return textbytes.mixed(found)
            part = part[:-width] * base + part[width:]  # a string's hash from those of its halves
            base = base * base
            width *= 2


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    return np.minimum(values[: len(values) - (width - span)], values[width - span :]) if width > span else values


def parse(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """``(row, first start, last start, trigger's place, trigger hash)`` of the phrases of all rows, in order."""
    empty = np.zeros(0, dtype=np.int64)
    if len(data) < length:
        return empty, empty, empty, empty, empty.astype(np.uint64)
    found = []
    step = 1 << 22  # places within a stretch fit beside the hash
    for base in range(0, len(data) - length + 1, step):
        part = data[base : base + step + length - 1]
        h = _grams(part)
        place = np.arange(len(h), dtype=np.uint64)
        trigger = (_least((h & ~_LOW) | place, length - GRAM + 1) & _LOW).astype(np.int64)
        # Triggers are small hashes; stirred again, they fall evenly into buckets.
        found.append((trigger + base, textbytes.mixed(h[trigger] ^ np.uint64(0x2545F4914F6CDD1D))))
    trigger = np.concatenate([t for t, _ in found])
    h = np.concatenate([x for _, x in found])
    start = np.arange(len(trigger))
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(start)]
    inside = start + length <= offsets[row + 1]
    start, row, trigger, h = start[inside], row[inside], trigger[inside], h[inside]
    cuts = runs(row, trigger)
    last = np.append(cuts[1:], len(start)) - 1
    if not len(cuts):
        return empty, empty, empty, empty, empty.astype(np.uint64)
    return row[cuts], start[cuts], start[last], trigger[cuts], h[cuts]


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    return column.fill_null(0).to_numpy(), valid


KNOWN_DDL = "doc_id long, at array<int>"


def _live_rows(owners: np.ndarray, at: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows ``(doc_id, places)``, packed."""
    order = np.lexsort((at, owners))
    owners, at = owners[order], at[order]
    cuts = runs(owners)
    for lo in range(0, len(cuts), 20_000):
        own = cuts[lo : lo + 20_000]
        end = cuts[lo + 20_000] if lo + 20_000 < len(cuts) else len(owners)
        lists = pa.ListArray.from_arrays(pa.array(np.append(own, end) - own[0], pa.int32()), pa.array(at[own[0] : end].astype(np.int32), pa.int32()))
        yield pa.RecordBatch.from_arrays([pa.array(owners[own], pa.int64()), lists], names=["doc_id", "at"])


def _any_bucket(doc_id: np.ndarray, buckets: int) -> pa.Array:
    """Buckets for rows that only pass through."""
    return pa.array((textbytes.mixed(doc_id.view(np.uint64)) % np.uint64(buckets)).astype(np.int32))


def _triggers(docs: DataFrame, length: int, buckets: int) -> DataFrame:
    """Triggers packed by bucket. The extra is the place, or where the task knows of two documents, the count with the top bit set."""

    def flush(keys, owners, at) -> Iterator[pa.RecordBatch]:
        k, o, x = np.concatenate(keys), np.concatenate(owners), np.concatenate(at)
        order = np.lexsort((x, o, k))
        k, o, x = k[order], o[order], x[order]
        starts = runs(k)
        sizes = np.diff(np.append(starts, len(k)))
        low, high = np.minimum.reduceat(o, starts), np.maximum.reduceat(o, starts)
        shared = low != high
        rows = np.repeat(shared, sizes)
        # Known to be in two documents: one row tells the bucket so, the places stay here.
        tell = starts[shared]
        k_out = np.concatenate((k[~rows], k[tell]))
        o_out = np.concatenate((o[~rows], o[tell]))
        x_out = np.concatenate((x[~rows], sizes[shared].astype(np.uint32) | np.uint32(1 << 31)))
        for batch in bucketed(k_out, o_out, x_out, buckets):
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.nulls(batch.num_rows, pa.int64()), pa.nulls(batch.num_rows, pa.list_(pa.int32()))],
                names=["bucket", "blob", "doc_id", "at"],
            )
        for batch in _live_rows(o[rows], x[rows]):
            yield pa.RecordBatch.from_arrays(
                [_any_bucket(batch.column(0).to_numpy(), buckets), pa.nulls(batch.num_rows, pa.binary()), *batch.columns],
                names=["bucket", "blob", "doc_id", "at"],
            )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, owners, at, held = [], [], [], 0
        for batch in batches:
            ids, valid = _ids(batch.column(0))
            for first, _, data, offsets in textbytes.pieces(batch.column(1)):
                row, start, _, trigger, h = parse(data, offsets, length)
                ok = valid[first + row]
                row, trigger, h = row[ok], trigger[ok], h[ok]
                keys.append(h)
                owners.append(ids[first + row])
                at.append((trigger - offsets[row]).astype(np.uint32))
                held += len(h)
                if held > HELD_KEYS:
                    yield from flush(keys, owners, at)
                    keys, owners, at, held = [], [], [], 0
        if held:
            yield from flush(keys, owners, at)

    return docs.select("doc_id", "text").mapInArrow(scan, f"{BUCKETED_DDL}, {KNOWN_DDL}")


def _hot_ids(bucket: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Bucket and the low bytes of the hash, which are what a bucket knows of a trigger."""
    return ((bucket.astype(np.uint64) << np.uint64(8 * KEY_BYTES)) | (h & np.uint64((1 << 8 * KEY_BYTES) - 1))).view(np.int64)


def _live(triggers: DataFrame, most: int) -> DataFrame:
    """``(doc_id, at)``: places of triggers that occur in several documents. Rows that the tasks knew of pass through.

    Rows without ``doc_id`` name a trigger of more than ``most`` phrases in ``hot`` (``_hot_ids``).
    """

    def find(group: pa.Table) -> pa.Table:
        known = group.filter(pc.is_null(group.column("blob"))).select(["doc_id", "at"]).combine_chunks()
        at = known.column("at").combine_chunks()
        counts = pc.fill_null(pc.list_value_length(at), 0).to_numpy()
        ids, places = [np.repeat(known.column("doc_id").to_numpy(), counts)], [at.flatten().to_numpy()]
        blobs = group.column("blob").drop_null()
        hot = np.zeros(0, dtype=np.int64)
        if len(blobs):
            keys, owners, extra = unbucketed(blobs)
            order = np.lexsort((owners, keys))
            keys, owners, extra = keys[order], owners[order], extra[order]
            told = (extra >> np.uint32(31)).astype(bool)
            starts = runs(keys)
            sizes = np.diff(np.append(starts, len(keys)))
            shared = np.minimum.reduceat(owners, starts) != np.maximum.reduceat(owners, starts)
            shared |= np.logical_or.reduceat(told, starts)
            rows = np.repeat(shared, sizes) & ~told
            ids.append(owners[rows])
            places.append(extra[rows].astype(np.int32))
            phrases = np.add.reduceat(np.where(told, extra & np.uint32((1 << 31) - 1), 1).astype(np.int64), starts)
            many = keys[starts[shared & (phrases > most)]]
            hot = _hot_ids(np.full(len(many), group.column("bucket")[0].as_py()), many)
        ids, places = pa.array(np.concatenate(ids), pa.int64()), pa.array(np.concatenate(places), pa.int32())
        columns = ((ids, pa.nulls(len(hot), pa.int64())), (places, pa.nulls(len(hot), pa.int32())), (pa.nulls(len(ids), pa.int64()), pa.array(hot)))
        return pa.table([pa.chunked_array(c) for c in columns], names=["doc_id", "at", "hot"])

    return triggers.groupBy("bucket").applyInArrow(find, "doc_id long, at int, hot long")


def _packed(docs: DataFrame, *carry: str) -> DataFrame:
    """``doc_id, tag, packed``: texts compressed for the shuffles. ``tag`` tells rows of one id apart."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in textbytes.pieces(batch.column(1)):
                press = zstandard.ZstdCompressor(level=1)
                raw = data.tobytes()
                texts = [raw[a:b] for a, b in zip(offsets, offsets[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array([zlib.crc32(t) for t in texts], pa.int64()),
                        pa.array([press.compress(t) for t in texts], pa.binary()),
                        batch.column(2).slice(lo, hi - lo),
                    ],
                    names=["doc_id", "tag", "packed", "carried"],
                )

    rows = docs.select("doc_id", "text", F.struct(F.lit(0).alias("_"), *carry).alias("carried"))
    schema = T.StructType.fromDDL("doc_id long, tag long, packed binary").add("carried", rows.schema["carried"].dataType)
    return rows.mapInArrow(pack, schema)


def _unpacked(column: pa.Array) -> list[bytes]:
    press = zstandard.ZstdDecompressor()
    return [press.decompress(x.as_buffer()) for x in column]


RANGE_DDL = "doc_id long, tag long, first int, end int"


def _range_batch(owner, tag, first, end) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(owner, pa.int64()), pa.array(tag, pa.int64()), pa.array(first.astype(np.int32)), pa.array(end.astype(np.int32))],
        names=["doc_id", "tag", "first", "end"],
    )


def _entry_blob(h, owner, tag, first, count, data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join((
        np.uint64(len(h)).tobytes(), h.tobytes(), owner.tobytes(), tag.astype(np.uint32).tobytes(),
        first.astype(np.uint32).tobytes(), count.astype(np.uint8).tobytes(), data,
    )))


def _entries(blob: pa.Buffer) -> tuple[np.ndarray, ...]:
    blob = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(blob, np.uint64, 1)[0])
    at, out = 8, []
    for kind, width in ((np.uint64, 8), (np.int64, 8), (np.uint32, 4), (np.uint32, 4), (np.uint8, 1)):
        out.append(np.frombuffer(blob, kind, n, at))
        at += n * width
    return (*out, np.frombuffer(blob, np.uint8, offset=at))


def _strings(h, owner, tag, first, count, data, length: int) -> tuple[np.ndarray, ...]:
    """Phrases as entries of one string each, under a hash of the string's halves in place of the trigger's."""
    sizes = count.astype(np.int64) + (length - 1)
    own = np.repeat(np.arange(len(count)), count)
    inside = spread(np.zeros(len(count), dtype=np.int64), count.astype(np.int64))
    at = (np.cumsum(sizes) - sizes)[own] + inside
    half = length // 2
    left, right = textbytes.span_hashes(data, at, at + half), textbytes.span_hashes(data, at + half, at + length)
    key = textbytes.mixed(textbytes.mixed(left) ^ (right * np.uint64(0x9E3779B97F4A7C15)) ^ h[own])
    name = textbytes.span_hashes(data, at, at + length)
    return key, name, owner[own], tag[own], first[own] + inside, np.ones(len(own), dtype=count.dtype), data[spread(at, np.full(len(at), length))]


def _phrases(texts: DataFrame, length: int, buckets: int, hot: np.ndarray) -> DataFrame:
    """``(doc_id, tag, packed, carried, at)`` -> phrases at the places, packed by bucket, and ranges that are repeated for sure.

    Phrases of the triggers in ``hot`` (sorted) go as single strings.
    """

    def flush(*parts) -> Iterator[pa.RecordBatch]:
        yield from send(*[np.concatenate(x) for x in parts], hot)

    def send(h, name, owner, tag, first, count, data, hot) -> Iterator[pa.RecordBatch]:
        sizes = count + (length - 1)
        starts = np.cumsum(sizes) - sizes
        order = np.lexsort((owner, name, h))
        heads = runs(h[order], name[order])
        least = np.repeat(owner[order][heads], np.diff(np.append(heads, len(order))))
        later = order[owner[order] > least]  # the same phrase is in a smaller document of this task
        if len(later):
            batch = _range_batch(owner[later], tag[later], first[later], first[later] + sizes[later])
            yield pa.RecordBatch.from_arrays(
                [_any_bucket(owner[later], buckets), pa.nulls(len(later), pa.binary()), *batch.columns], names=["bucket", "blob", *batch.schema.names]
            )
        sent = order[owner[order] == least]
        bucket = ((h[sent] >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        if len(hot):
            many = np.isin(_hot_ids(bucket, h[sent]), hot)
            apart, sent, bucket = sent[many], sent[~many], bucket[~many]
            none = np.zeros(0, dtype=np.int64)
            for lo in range(0, len(apart), DICTIONARY_PHRASES):
                own = apart[lo : lo + DICTIONARY_PHRASES]
                text = data[spread(starts[own], sizes[own])]
                yield from send(*_strings(h[own], owner[own], tag[own], first[own], count[own], text, length), none)
            if not len(sent):
                return
        order = np.argsort(bucket, kind="stable")
        sent, bucket = sent[order], bucket[order]
        cuts = np.append(runs(bucket), len(sent))
        ids, blobs = [], []
        for lo, hi in zip(cuts, cuts[1:]):
            own = sent[lo:hi]
            ids.append(int(bucket[lo]))
            blobs.append(_entry_blob(h[own], owner[own], tag[own], first[own], count[own], data[spread(starts[own], sizes[own])].tobytes()))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int32()), pa.array(blobs, pa.binary()),
                pa.nulls(len(ids), pa.int64()), pa.nulls(len(ids), pa.int64()), pa.nulls(len(ids), pa.int32()), pa.nulls(len(ids), pa.int32()),
            ],
            names=["bucket", "blob", "doc_id", "tag", "first", "end"],
        )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, parts = 0, [[] for _ in range(7)]
        for batch in batches:
            ids, tags = _ids(batch.column(0))[0], batch.column(1).to_numpy()
            lo = 0
            while lo < batch.num_rows:
                texts, size, hi = [], 0, lo
                while hi < batch.num_rows and (hi == lo or size < textbytes.PIECE_BYTES // 4):
                    known = batch.column(4)[hi].is_valid
                    texts.append(_unpacked(batch.column(2).slice(hi, 1))[0] if known else b"")
                    size += len(texts[-1])
                    hi += 1
                offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
                data = np.frombuffer(b"".join(texts), np.uint8)
                row, first, last, trigger, h = parse(data, offsets, length)
                live = np.zeros(len(data) + 1, dtype=bool)
                at = batch.column(4).slice(lo, hi - lo)
                counts = pc.fill_null(pc.list_value_length(at), 0).to_numpy()
                places = at.flatten().to_numpy() + np.repeat(offsets[:-1], counts)
                live[places[places < len(data)]] = True
                keep = live[trigger]
                row, first, last, h = row[keep], first[keep], last[keep], h[keep]
                if len(row):
                    count = last - first + 1
                    sizes = count + (length - 1)
                    for part, value in zip(parts, (
                        h, textbytes.span_hashes(data, first, first + sizes), ids[lo + row], tags[lo + row],
                        first - offsets[row], count, data[spread(first, sizes)],
                    )):
                        part.append(value)
                    held += len(row)
                if held > HELD_PHRASES:
                    yield from flush(*parts)
                    held, parts = 0, [[] for _ in range(7)]
                lo = hi
        if held:
            yield from flush(*parts)

    return texts.select("doc_id", "tag", "packed", "carried", "at").mapInArrow(scan, f"{BUCKETED_DDL}, {RANGE_DDL}")


def repeats(h, name, owner, first, count, data, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Repeated ranges ``(entry, first, end)`` among phrases, by dictionary and order of suffixes."""
    sizes = count.astype(np.int64) + (length - 1)
    starts = np.cumsum(sizes) - sizes
    order = np.lexsort((owner, name, h))
    h, name, owner_ = h[order], name[order], owner[order]
    heads = runs(h, name)
    width = np.diff(np.append(heads, len(order)))
    least = np.repeat(owner_[heads], width)
    later = order[owner_ > least]
    found = [(later, first[later], first[later] + sizes[later])]
    # Dictionary: the first entry of each phrase; with others at its trigger, their suffixes are put in order.
    groups = runs(h[heads])
    several = np.repeat(np.diff(np.append(groups, len(heads))) > 1, np.diff(np.append(groups, len(heads))))
    low = np.minimum.reduceat(owner_[heads], groups) if len(groups) else groups
    several &= np.repeat(low, np.diff(np.append(groups, len(heads)))) < owner_[heads].max(initial=0)
    entry = np.flatnonzero(several)  # numbers in the dictionary
    if len(entry):
        at = order[heads[entry]]
        own = np.repeat(np.arange(len(entry)), count[at])
        suffix = spread(starts[at], count[at].astype(np.int64))
        strings = np.empty((len(suffix), length), dtype=np.uint8)
        for lo in range(0, len(suffix), 65536):
            strings[lo : lo + 65536] = data[suffix[lo : lo + 65536, None] + np.arange(length)]
        strings = strings.view(f"S{length}").ravel()
        ranked = np.argsort(strings, kind="stable")
        ordered = strings[ranked]
        same = np.concatenate(([0], np.flatnonzero(ordered[1:] != ordered[:-1]) + 1))
        smallest = np.minimum.reduceat(owner_[heads[entry]][own[ranked]], same)
        smallest = np.repeat(smallest, np.diff(np.append(same, len(ranked))))
        hit = ranked[smallest < owner_[heads[entry]][own[ranked]]]
        if len(hit):
            # Every row of the entry that is in its smallest document has the string at the same place.
            e, inside = own[hit], suffix[hit] - starts[at][own[hit]]
            equal = np.add.reduceat((owner_ == least).astype(np.int64), heads)[entry][e]
            rows = order[spread(heads[entry][e], equal)]
            begin = first[rows] + np.repeat(inside, equal)
            found.append((rows, begin, begin + length))
    return tuple(np.concatenate(x) for x in zip(*found))


def _dictionary(phrases: DataFrame, length: int) -> DataFrame:
    def find(group: pa.Table) -> pa.Table:
        known = group.filter(pc.is_null(group.column("blob"))).select(["doc_id", "tag", "first", "end"])
        blobs = group.column("blob").drop_null()
        if not len(blobs):
            return known
        parts = [_entries(x.as_buffer()) for x in blobs]
        h, owner, tag, first, count, data = (np.concatenate(x) for x in zip(*parts))
        first, count = first.astype(np.int64), count.astype(np.int64)
        sizes = count + (length - 1)
        starts = np.cumsum(sizes) - sizes
        # Triggers of about DICTIONARY_PHRASES phrases at a time, so that their suffixes stay few.
        order = np.argsort(h, kind="stable")
        heads = runs(h[order])
        cuts = heads[runs(heads // DICTIONARY_PHRASES)]
        out = []
        for lo, hi in zip(cuts, np.append(cuts[1:], len(order))):
            own = order[lo:hi]
            text = data[spread(starts[own], sizes[own])]
            begins = np.cumsum(sizes[own]) - sizes[own]
            name = textbytes.span_hashes(text, begins, begins + sizes[own])
            row, begin, end = repeats(h[own], name, owner[own], first[own], count[own], text, length)
            out.append(_range_batch(owner[own][row], tag[own][row].astype(np.int64), begin, end))
        return pa.Table.from_batches([*known.to_batches(), *[b.cast(known.schema) for b in out]], schema=known.schema)

    return phrases.groupBy("bucket").applyInArrow(find, RANGE_DDL)


def cut(docs: DataFrame, length: int = 50, carry: tuple[str, ...] = (), as_text: bool = False) -> DataFrame:
    """``doc_id, text_bytes, kept, spans, kept_text, carried``: the text, what is left of it, and the removed ranges in order.

    ``kept_text``, if asked for, leaves out characters that lost a byte. ``carried`` is a struct
    that holds the columns named in ``carry``.
    """
    buckets = max(1, text_bytes(docs) // (TRIGGER_BYTES * KEYS_PER_BUCKET) + 1)
    live = _live(_triggers(docs, length, buckets), HOT_PHRASES)
    live = stored(live.groupBy("doc_id").agg(F.collect_list("at").alias("at"), F.collect_list("hot").alias("hot")), "live")
    named = live.filter("doc_id is null").select("hot").first()
    hot = np.sort(np.array(named.hot if named else [], dtype=np.int64))
    live = live.filter("doc_id is not null").drop("hot")
    # Both joins take all columns of the packed texts by the same key, so that one shuffle serves both.
    packed = _packed(docs, *carry)
    places = packed.join(live, "doc_id", "left").select("doc_id", "tag", "packed", "carried", "at")
    ranges = _dictionary(_phrases(places, length, buckets, hot), length)
    ranges = ranges.groupBy("doc_id").agg(F.collect_list(F.struct("tag", "first", "end")).alias("ranges"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _unpacked(batch.column(1))
            kept, firsts, ends, bounds = [], [], [], [0]
            for text, tag, ranges in zip(texts, batch.column(4).to_numpy(), batch.column(2)):
                own = np.flatnonzero(ranges.values.field("tag").to_numpy() == tag) if ranges.is_valid else ()
                if not len(own):
                    kept.append(text)
                else:
                    first, end = (ranges.values.field(name).to_numpy()[own] for name in ("first", "end"))
                    order = np.argsort(first, kind="stable")
                    first, reach = first[order], np.maximum.accumulate(end[order])
                    heads = np.concatenate(([0], np.flatnonzero(first[1:] > reach[:-1]) + 1))
                    first, end = first[heads], reach[np.append(heads[1:], len(reach)) - 1]
                    edges = np.concatenate(([0], np.ravel((first, end), order="F"), [len(text)]))
                    kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
                    firsts.append(first)
                    ends.append(end)
                bounds.append(bounds[-1] + (len(firsts[-1]) if len(own) else 0))
            flat = pa.StructArray.from_arrays(
                [pa.array(np.concatenate(x) if x else np.zeros(0, np.int32), pa.int32()) for x in (firsts, ends)], names=["first", "end"]
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.binary()), pa.array(kept, pa.binary()), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), flat),
                 pa.array([k.decode("utf-8", "ignore") if as_text else None for k in kept], pa.string()), batch.column(3)],
                names=["doc_id", "text_bytes", "kept", "spans", "kept_text", "carried"],
            )

    joined = packed.join(ranges, "doc_id", "left").select("doc_id", "packed", "ranges", "carried", "tag")
    schema = T.StructType.fromDDL("doc_id long, text_bytes binary, kept binary, spans array<struct<first:int,end:int>>, kept_text string")
    return joined.mapInArrow(apply, schema.add("carried", joined.schema["carried"].dataType))


def removals(docs: DataFrame, length: int = 50) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of each row."""
    return cut(docs, length).select(
        "doc_id",
        F.octet_length("text_bytes").cast("long").alias("n_bytes"),
        (F.octet_length("text_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
