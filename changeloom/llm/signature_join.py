"""Similarity join of documents on word shingles by signature trees, and the groups it links.

Two documents link when the Jaccard similarity of their shingle sets is at least ``percent`` / 100.

1. *Sets.* Every text becomes a set of hashed shingles. Equal sets are one class from here on.
2. *Groups that cannot miss a link.* For a size class with at most ``U`` shingles, linked sets differ
   in at most ``H = 2U (100 - percent) / (100 + percent)`` shingles. Shingles are dealt by hash into
   ``H + 1 + slack`` parts, so at least ``1 + slack`` parts of two linked sets are equal, and one of
   them is not empty unless a set has more than ``slack`` empty parts; such sets are grouped by the
   prefix of their sorted shingles instead. A part that differs in one word of a shared passage is
   another part, so passages that many documents share do not make large groups.
3. *Stars.* The sets of a group are compared with one of them, then with another; linked ones merge. Most
   groups are settled by this: their members are all in one component.
4. *Trees.* A long document is in many groups, mostly with the same few others. So the groups that have the
   same centre are put together into a cell, if it fits a block or has fewer rows than they have; a document is then in few
   cells. Other groups are cells of their own. A cell is cut into blocks, and a document's bitmap moves once for each block that its
   own meets; blocks of one large component do not meet. A block is a tree
   whose nodes hold the OR of their members' bitmaps and their range of sizes. Two trees are walked together from their roots; a pair
   of nodes is left when it lies within one component, when its sizes are too far apart, or when the
   greatest overlap that its bitmaps allow is too small. Trees go by few bits; the pairs of leaves that remain are checked by many
   before they leave the cell, and then compared exactly.

Only links between different components are ever looked for, and a pair has to pass the bitmaps to leave its
cell, so no group's pairs are listed; a pair that several cells have in common leaves the first of them.

Defined cases: a null or blank text has no shingles and no links (``n_shingles`` 0). A row without id has
its own ``n_shingles`` and a null component. Rows that repeat an id are one document with several
texts: it links if any of them does. Ties do not arise; other columns are ignored; an empty table
gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from . import textbytes
from .common import BUCKETED_DDL, KEYS_PER_BUCKET, bucketed, components, runs, stored, text_bytes, unbucketed

#: Members of a tree.
BLOCK = 1024
#: Pairs of nodes that are looked at together.
PAIRS_AT_ONCE = 4096
#: Of its cells, a row tells the first so many at most.
TOLD_CELLS = 32
FANOUT = 8
STAR_ROUNDS = 2
#: Trees go by bitmaps this many times smaller than those that pairs are checked by: a bit or two for each shingle.
NARROW = 4
#: Keys that a task holds before it packs them.
HELD_KEYS = 500_000
#: Keys of a text are about a third of its words, and a word has at least two bytes.
KEYS_PER_BYTE = 0.06


class Bounds:
    """Size classes and what follows from the least similarity, in whole numbers."""

    def __init__(self, percent: int):
        self.percent = percent
        self.lows = [1]

    def class_of(self, n: int) -> int:
        """The class of a set of ``n``; linked sets are in the same or in neighbouring classes."""
        while self.lows[-1] <= n:
            self.lows.append(self.lows[-1] * 100 // self.percent + 1)
        return int(np.searchsorted(self.lows, n, side="right")) - 1

    def most_different(self, c: int) -> int:
        """Shingles in which linked sets differ at most, the larger one being in class ``c``."""
        while len(self.lows) <= c + 1:
            self.class_of(self.lows[-1])
        return 2 * (self.lows[c + 1] - 1) * (100 - self.percent) // (100 + self.percent)

    def linked(self, common: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return 100 * common >= self.percent * (a + b - common)

    def least_common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return -((-self.percent * (a + b)) // (100 + self.percent))


def _set_hash(sh: np.ndarray) -> tuple[int, int]:
    with np.errstate(over="ignore"):
        return (
            int(np.add.reduce(textbytes.mixed(sh)).view(np.int64)),
            int(np.add.reduce(textbytes.mixed(sh ^ np.uint64(0x5851F42D4C957F2D))).view(np.int64)),
        )


def bitmap_bits(n: int) -> int:
    """A power of two of at least four times the set's size: most shingles have a bit of their own."""
    return max(64, 1 << int(4 * n - 1).bit_length()) if n else 64


def bitmap(sh: np.ndarray) -> np.ndarray:
    bits = bitmap_bits(len(sh))
    out = np.zeros(bits, dtype=np.uint8)
    out[(sh >> np.uint64(7)) & np.uint64(bits - 1)] = 1
    return np.packbits(out, bitorder="little").view(np.uint64)


def folded(words: np.ndarray, width: int) -> np.ndarray:
    """A bitmap over fewer bits: halves are OR-combined."""
    while len(words) > width:
        words = words[: len(words) // 2] | words[len(words) // 2 :]
    return words


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, n_shingles, set_a, set_b``: the size of each row's set and two hashes of it."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, a, b = [], [], []
            for _, _, data, offsets in textbytes.pieces(batch.column(1)):
                sh, bounds = textbytes.shingles(data, offsets, width)
                for lo, hi in zip(bounds, bounds[1:]):
                    x, y = _set_hash(sh[lo:hi])
                    n.append(hi - lo)
                    a.append(x)
                    b.append(y)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                names=["doc_id", "n_shingles", "set_a", "set_b"],
            )

    return docs.select("doc_id", "text").mapInArrow(scan, "doc_id long, n_shingles long, set_a long, set_b long")


def set_keys(sh: np.ndarray, bounds: Bounds) -> np.ndarray:
    """Group keys of one set: two linked sets have one in common."""
    n = len(sh)
    own = bounds.class_of(n)
    keys = []
    for c in (own, own + 1):
        different = bounds.most_different(c)
        slack = different // 16 + 1 if different else 0
        parts = different + 1 + slack
        with np.errstate(over="ignore"):
            salt = np.uint64((c * 0x9E3779B97F4A7C15 + 0x1234567) & 0xFFFFFFFFFFFFFFFF)
            stirred = textbytes.mixed(sh + salt)
        part = ((sh >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)  # sorted, as the shingles are
        cuts = runs(part)
        with np.errstate(over="ignore"):
            sums = np.add.reduceat(stirred, cuts)
            keys.append(textbytes.mixed(sums ^ (part[cuts] * np.uint64(0xD1B54A32D192ED03) + salt)))
        if parts - len(cuts) > slack:
            prefix = n - -(-bounds.percent * n // 100) + 1
            with np.errstate(over="ignore"):
                keys.append(textbytes.mixed(sh[:prefix] * np.uint64(0xA0761D6478BD642F) + salt + np.uint64(1)))
    return np.concatenate(keys)


def _keys(docs: DataFrame, width: int, percent: int, buckets: int) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = Bounds(percent)
        seen: set[tuple[int, int]] = set()  # a set that this task has met before makes no keys again
        keys, owners, held = [], [], 0
        for batch in batches:
            ids = batch.column(0)
            for first, _, data, offsets in textbytes.pieces(batch.column(1)):
                sh, at = textbytes.shingles(data, offsets, width)
                for i, (lo, hi) in enumerate(zip(at, at[1:])):
                    if lo == hi or not ids[first + i].is_valid:
                        continue
                    own = sh[lo:hi]
                    if (name := _set_hash(own)) in seen:
                        continue
                    seen.add(name)
                    keys.append(set_keys(own, bounds))
                    owners.append(np.full(len(keys[-1]), ids[first + i].as_py(), dtype=np.int64))
                    held += len(keys[-1])
                if held > HELD_KEYS:
                    k = np.concatenate(keys)
                    yield from bucketed(k, np.concatenate(owners), np.zeros(len(k), dtype=np.uint32), buckets)
                    keys, owners, held = [], [], 0
                    if len(seen) > 500_000:
                        seen.clear()
        if keys:
            k = np.concatenate(keys)
            yield from bucketed(k, np.concatenate(owners), np.zeros(len(k), dtype=np.uint32), buckets)

    return docs.select("doc_id", "text").mapInArrow(scan, BUCKETED_DDL)


def _groups(blobs: DataFrame) -> DataFrame:
    """``grp, owner``: owners that share a key; groups of the same owners once. ``grp`` names the owners."""

    def find(group: pa.Table) -> pa.Table:
        keys, owners, _ = unbucketed(group.column("blob"))
        order = np.lexsort((owners, keys))
        keys, owners = keys[order], owners[order]
        distinct = runs(keys, owners)
        keys, owners = keys[distinct], owners[distinct]
        starts = runs(keys)
        sizes = np.diff(np.append(starts, len(keys)))
        with np.errstate(over="ignore"):
            name = np.add.reduceat(textbytes.mixed(owners.view(np.uint64) + np.uint64(0x632BE59BD9B4E019)), starts) if len(keys) else keys
            name = textbytes.mixed(name + sizes.astype(np.uint64)).view(np.int64)
        _, once = np.unique(name, return_index=True)
        keep = np.zeros(len(starts), dtype=bool)
        keep[once] = True
        keep &= sizes > 1
        rows = np.repeat(keep, sizes)
        return pa.table({"grp": np.repeat(name, sizes)[rows], "owner": owners[rows]})

    return blobs.groupBy("bucket").applyInArrow(find, "grp long, owner long").dropDuplicates(["grp", "owner"])


def _profiles(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """``doc_id, n, bits, set`` of the documents in ``ids``: size, bitmap, sorted shingles."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in textbytes.pieces(batch.column(1)):
                sh, at = textbytes.shingles(data, offsets, width)
                sets = [sh[a:b] for a, b in zip(at, at[1:])]
                bits = [bitmap(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([b.tobytes() for b in bits], pa.binary()),
                        pa.array([s.tobytes() for s in sets], pa.binary()),
                    ],
                    names=["doc_id", "n", "bits", "set"],
                )

    own = docs.select("doc_id", "text").join(ids.select(F.col("owner").alias("doc_id")).distinct(), "doc_id", "left_semi")
    return own.mapInArrow(scan, "doc_id long, n long, bits binary, set binary").filter("n > 0")


def _u64(value) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), dtype=np.uint64)


def may_link(a: np.ndarray, n_a: int, b: np.ndarray, n_b: int, bounds: Bounds) -> bool:
    """Whether two bitmaps allow the overlap that a link needs."""
    width = min(len(a), len(b))
    a, b = folded(a, width), folded(b, width)
    out_a = int(np.bitwise_count(a & ~b).sum())
    out_b = int(np.bitwise_count(b & ~a).sum())
    return min(n_a - out_a, n_b - out_b) >= int(bounds.least_common(np.int64(n_a), np.int64(n_b)))


def _linked(pairs: DataFrame, profiles: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` that link: first by sizes and bitmaps, which are small, then by the sets themselves."""

    def by_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = Bounds(percent)
        for batch in batches:
            n_a, x, n_b, y = (batch.column(k) for k in (2, 3, 4, 5))
            keep = [may_link(_u64(p), i.as_py(), _u64(q), j.as_py(), bounds) for i, p, j, q in zip(n_a, x, n_b, y)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def by_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = Bounds(percent)
        for batch in batches:
            keep = []
            for p, q in zip(batch.column(2), batch.column(3)):
                s, t = _u64(p), _u64(q)
                common = len(s) + len(t) - len(np.union1d(s, t))
                keep.append(bool(bounds.linked(common, len(s), len(t))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def side(name: str, *columns: str) -> DataFrame:
        return profiles.select(F.col("doc_id").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in columns])

    near = pairs.join(side("a", "n", "bits"), "a").join(side("b", "n", "bits"), "b")
    near = near.filter(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
    near = near.select("a", "b", "n_a", "bits_a", "n_b", "bits_b").mapInArrow(by_bits, "a long, b long").distinct()
    near = stored(near, "near")
    full = near.join(side("a", "set"), "a").join(side("b", "set"), "b").select("a", "b", "set_a", "set_b")
    return stored(full.mapInArrow(by_sets, "a long, b long").distinct(), "linked")


class Tree:
    """Levels of nodes over the sets of a block, from the leaves (level 0) up to few roots."""

    def __init__(self, bits: np.ndarray, sizes: np.ndarray, comps: np.ndarray):
        excess = sizes - np.bitwise_count(bits).sum(axis=1).astype(np.int64)
        self.levels = [(bits, sizes, sizes, excess, comps)]
        while len(self.levels[-1][1]) > FANOUT:
            bits, low, high, excess, comps = self.levels[-1]
            cuts = np.arange(0, len(low), FANOUT)
            first, last = np.minimum.reduceat(comps, cuts), np.maximum.reduceat(comps, cuts)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(bits, cuts, axis=0),
                    np.minimum.reduceat(low, cuts),
                    np.maximum.reduceat(high, cuts),
                    np.maximum.reduceat(excess, cuts),
                    np.where(first == last, first, np.iinfo(np.int64).min),
                )
            )


def walk(one: Tree, two: Tree, bounds: Bounds) -> tuple[np.ndarray, np.ndarray]:
    """Leaves of two trees of equal height that may link and lie in different components.

    Depth first, a bounded number of pairs at a time: what is held beyond the result does not grow with the trees.
    """
    mixed = np.iinfo(np.int64).min
    step = np.arange(FANOUT)
    top = min(len(one.levels), len(two.levels)) - 1
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(one.levels[top][1])), np.arange(len(two.levels[top][1])), indexing="ij"))
    todo, found = [(top, i[lo : lo + PAIRS_AT_ONCE], j[lo : lo + PAIRS_AT_ONCE]) for lo in range(0, len(i), PAIRS_AT_ONCE)], []
    while todo:
        level, i, j = todo.pop()
        (bits_a, low_a, high_a, exc_a, comp_a), (bits_b, low_b, high_b, exc_b, comp_b) = one.levels[level], two.levels[level]
        ok = (comp_a[i] != comp_b[j]) | (comp_a[i] == mixed)
        ok &= (100 * high_a[i] >= bounds.percent * low_b[j]) & (100 * high_b[j] >= bounds.percent * low_a[i])
        i, j = i[ok], j[ok]
        most = np.bitwise_count(bits_a[i] & bits_b[j]).sum(axis=1).astype(np.int64) + np.minimum(exc_a[i], exc_b[j])
        keep = most >= bounds.least_common(low_a[i], low_b[j])
        i, j = i[keep], j[keep]
        if not level:
            found.append((i, j))
            continue
        below_a, below_b = len(one.levels[level - 1][1]), len(two.levels[level - 1][1])
        i = (i[:, None, None] * FANOUT + step[None, :, None]).repeat(FANOUT, axis=2).ravel()
        j = (j[:, None, None] * FANOUT + step[None, None, :]).repeat(FANOUT, axis=1).ravel()
        there = (i < below_a) & (j < below_b)
        i, j = i[there], j[there]
        todo += [(level - 1, i[lo : lo + PAIRS_AT_ONCE], j[lo : lo + PAIRS_AT_ONCE]) for lo in range(0, len(i), PAIRS_AT_ONCE)]
    if not found:
        return i[:0], j[:0]
    return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


def _shared(before: pa.ChunkedArray) -> np.ndarray:
    """A bitmap for each list: two have a bit in common if the lists have an entry in common."""
    lists = before.combine_chunks()
    _, place, often = np.unique(lists.flatten().to_numpy(), return_inverse=True, return_counts=True)
    member = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    column = np.cumsum(often > 1) - 1
    used = often[place] > 1
    member, column = member[used], column[place[used]]
    out = np.zeros((len(lists), max(int((often > 1).sum() + 63) // 64, 1)), dtype=np.uint64)
    np.bitwise_or.at(out, (member, column // 64), np.uint64(1) << (column % 64).astype(np.uint64))
    return out


def _tree_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """``rows(grp, p, q, block, owner, comp, n, bits, before)`` -> pairs that the trees of two blocks leave, each once.

    Trees are walked by narrow bitmaps; what they leave is checked by the wide ones before it leaves the cell, ``grp``. ``before`` are
    cells of the owner that come before it: a pair that has one of them in common leaves another, as nothing comes before the first.
    """

    def join(group: pa.Table) -> pa.Table:
        bounds = Bounds(percent)
        p, q = group.column("p")[0].as_py(), group.column("q")[0].as_py()
        block = group.column("block").to_numpy()
        owner = group.column("owner").to_numpy()
        comp = group.column("comp").to_numpy()
        n = group.column("n").to_numpy()
        raw = [_u64(x) for x in group.column("bits")]
        width = min(len(x) for x in raw)
        wide = np.vstack([folded(x, width) for x in raw])
        bits = np.vstack([folded(x, max(width // NARROW, 1)) for x in wide])
        trees = []
        for b in (p, q):
            own = np.flatnonzero(block == b)
            own = own[np.lexsort((bits[own, 0], n[own], comp[own]))]
            trees.append((own, Tree(bits[own], n[own], comp[own])))
        (own_a, one), (own_b, two) = trees
        if not len(own_a) or not len(own_b):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        while len(one.levels) != len(two.levels):
            low = one if len(one.levels) < len(two.levels) else two
            bits_, lo_, hi_, exc_, comp_ = low.levels[-1]
            same = comp_.min() if comp_.min() == comp_.max() else np.iinfo(np.int64).min
            low.levels.append((np.bitwise_or.reduce(bits_, axis=0)[None], lo_.min()[None], hi_.max()[None], exc_.max()[None], np.array([same])))
        i, j = walk(one, two, bounds)
        a, b = own_a[i], own_b[j]
        keep = comp[a] != comp[b]
        if p == q:
            keep &= owner[a] < owner[b]
        a, b = a[keep], b[keep]
        earlier = _shared(group.column("before"))
        step = max(1, 500_000 // earlier.shape[1])
        keep = np.ones(len(a), dtype=bool)
        for lo in range(0, len(a), step):
            keep[lo : lo + step] = ~(earlier[a[lo : lo + step]] & earlier[b[lo : lo + step]]).any(axis=1)
        a, b = a[keep], b[keep]
        keep = np.zeros(len(a), dtype=bool)
        for lo in range(0, len(a), 4096):
            x, y = a[lo : lo + 4096], b[lo : lo + 4096]
            out_x = np.bitwise_count(wide[x] & ~wide[y]).sum(axis=1)
            out_y = np.bitwise_count(wide[y] & ~wide[x]).sum(axis=1)
            keep[lo : lo + 4096] = np.minimum(n[x] - out_x, n[y] - out_y) >= bounds.least_common(n[x], n[y])
        x, y = owner[a[keep]], owner[b[keep]]
        return pa.table({"a": np.minimum(x, y), "b": np.maximum(x, y)})

    return rows.groupBy("grp", "p", "q").applyInArrow(join, "a long, b long").distinct()


def _merged(comps: DataFrame, links: DataFrame) -> DataFrame:
    """``comps(node, comp)`` after more links: only the components that a link joins are worked on, and nothing is done if none are."""

    def known(name: str) -> DataFrame:
        return comps.select(F.col("node").alias(name), F.col("comp").alias(f"comp_{name}"))

    apart = links.join(known("a"), "a", "left").join(known("b"), "b", "left")
    apart = apart.select(F.coalesce("comp_a", "a").alias("a"), F.coalesce("comp_b", "b").alias("b")).filter("a <> b")
    apart = stored(apart.distinct(), "apart")
    if apart.isEmpty():
        return comps
    moved = stored(components(apart).select(F.col("node").alias("comp"), F.col("comp").alias("to")), "moved")
    grown = comps.join(moved, "comp", "left").select("node", F.coalesce("to", "comp").alias("comp"))
    alone = moved.join(comps.select(F.col("node").alias("comp")), "comp", "left_anti").select(F.col("comp").alias("node"), F.col("to").alias("comp"))
    return stored(grown.unionByName(alone), "comps")


def _cells(rows: DataFrame) -> DataFrame:
    """Groups ``rows(grp, owner, comp, members, centre)`` put together: ``grp, owner, comp, blocks``. Two that share a group share a cell.

    The groups of a centre share a cell if that fits a block, or if its rows, once for each block, are fewer than those of the groups.
    """
    blocks = lambda members: F.expr(f"({members} + {BLOCK} - 1) div {BLOCK}")
    groups = rows.select("grp", "members", "centre").distinct()
    wide = rows.groupBy("centre").agg(F.countDistinct("owner").alias("wide"))
    apart = groups.groupBy("centre").agg(F.sum(F.col("members") * blocks("members")).alias("apart"))
    whole = (F.col("wide") <= BLOCK) | (F.col("wide") * blocks("wide") < F.col("apart"))
    cells = groups.join(wide.join(apart, "centre"), "centre").select(
        "grp",
        F.when(whole, F.xxhash64("centre", F.lit("centre"))).otherwise(F.col("grp")).alias("cell"),
        F.when(whole, blocks("wide")).otherwise(blocks("members")).alias("blocks"),
    )
    return rows.select("grp", "owner", "comp").join(cells, "grp").select(F.col("cell").alias("grp"), "owner", "comp", "blocks").distinct()


def _block_pairs(rows: DataFrame) -> DataFrame:
    """``rows(grp, owner, comp, blocks)`` -> ``grp, p, q, block, owner, comp``: each member in its block, once for each pair of blocks to compare.

    A component that is larger than a block has blocks of its own, and no two of these are compared: only members outside it meet
    all of its blocks, so a large group of which most are linked moves few rows more than it has.
    """
    zero = F.lit(0).cast("long")
    small = rows.filter("blocks = 1").select("grp", zero.alias("p"), zero.alias("q"), zero.alias("block"), "owner", "comp")
    large = rows.filter("blocks > 1")
    sizes = large.groupBy("grp", "comp").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.withColumn("own", F.when(F.col("n") > BLOCK, F.col("comp")))  # null: blocks of several components
    slots = sizes.groupBy("grp", "own").agg(F.expr(f"(sum(n) + {BLOCK} - 1) div {BLOCK}").alias("slots"))
    number = F.row_number().over(Window.partitionBy("grp").orderBy("own", "slot")).cast("long")
    blocks = slots.withColumn("slot", F.explode(F.sequence(zero, F.col("slots") - 1))).withColumn("block", number)
    other = blocks.select("grp", F.col("own").alias("other_own"), F.col("block").alias("other"))
    pairs = blocks.join(other, "grp").filter("own IS NULL OR other_own IS NULL OR own <> other_own")
    pairs = pairs.select("grp", F.col("own").alias("its"), "slot", "block", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"))
    slots = slots.select("grp", F.col("own").alias("its"), "slots")
    dealt = large.join(sizes.select("grp", "comp", "own"), ["grp", "comp"]).join(slots, "grp").filter("own <=> its")
    dealt = dealt.withColumn("slot", F.pmod(F.xxhash64("owner"), "slots")).select("grp", "owner", "comp", "own", "slot")
    dealt = dealt.join(pairs, ["grp", "slot"]).filter("own <=> its")
    return small.unionByName(dealt.select("grp", "p", "q", "block", "owner", "comp"))


def similarity_components(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of each row: the smallest id reachable by links."""
    sets = stored(shingle_sets(docs, width), "sets")
    named = sets.filter("doc_id is not null and n_shingles > 0")
    first = named.groupBy("set_a", "set_b", "n_shingles").agg(F.min("doc_id").alias("b"))
    edges = named.join(first, ["set_a", "set_b", "n_shingles"]).select(F.col("doc_id").alias("a"), "b").filter("a <> b")
    edges = stored(edges, "copies")
    comps = edges.groupBy("a").agg(F.min("b").alias("comp")).select(F.col("a").alias("node"), "comp")

    buckets = max(1, int(text_bytes(docs) * KEYS_PER_BYTE / KEYS_PER_BUCKET) + 1)
    groups = stored(_groups(_keys(docs, width, percent, buckets)), "groups")
    profiles = stored(_profiles(docs, groups, width), "profiles")

    def with_comp(rows: DataFrame) -> DataFrame:
        known = comps.select(F.col("node").alias("owner"), "comp")
        return rows.join(known, "owner", "left").withColumn("comp", F.coalesce("comp", "owner"))

    for turn in range(STAR_ROUNDS):
        rows = with_comp(groups)
        centre = rows.groupBy("grp").agg(
            F.min_by(F.struct(F.col("owner").alias("id"), "comp"), F.xxhash64("owner", F.lit(turn))).alias("c"),
            F.min("comp").alias("low"), F.max("comp").alias("high"),
        ).filter("low <> high")
        pairs = rows.join(centre, "grp").filter("comp <> c.comp")
        pairs = pairs.select(F.least("owner", "c.id").alias("a"), F.greatest("owner", "c.id").alias("b")).distinct()
        links = _linked(pairs, profiles, percent)
        comps = _merged(comps, links) if turn else stored(components(edges.unionByName(links)), "comps")

    rows = with_comp(groups)
    size = rows.groupBy("grp").agg(
        F.count("*").alias("members"), F.min("comp").alias("low"), F.max("comp").alias("high"),
        F.min_by("owner", F.xxhash64("owner")).alias("centre"),
    )
    # Stars have compared the two of a pair.
    size = size.filter(f"low <> high and members > {2 if STAR_ROUNDS else 1}").select("grp", "members", "centre")
    rows = stored(_cells(stored(rows.join(size, "grp"), "open")), "cells")
    owners = profiles.select(F.col("doc_id").alias("owner"), "n", "bits")
    told = F.slice(F.sort_array(F.collect_list("grp")), 1, TOLD_CELLS)
    owners = owners.join(rows.groupBy("owner").agg(told.alias("told")), "owner")
    rows = _block_pairs(rows).join(owners, "owner").withColumn("before", F.expr("filter(told, g -> g < grp)")).drop("told")
    links = _linked(_tree_pairs(rows, percent), profiles, percent)
    comps = _merged(comps, links) if STAR_ROUNDS else components(edges.unionByName(links))

    known = comps.select(F.col("node").alias("doc_id"), F.col("comp").alias("component_id"))
    return sets.select("doc_id", "n_shingles").join(known, "doc_id", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
