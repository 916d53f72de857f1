"""What leaves the groups of the similarity join, and how links make components grow."""

import numpy as np
import pytest

from changeloom.llm import common, signature_join


SCHEMA = "grp long, p long, q long, block long, owner long, comp long, n long, bits binary, before array<long>"


@pytest.fixture
def group():
    """Sets of a hundred shingles that share most of them: two copies of each but for three, and many that are too far from all."""
    rng = np.random.default_rng(7)
    base = rng.integers(0, 1 << 63, 100, dtype=np.uint64)
    draw = lambda keep: np.unique(np.concatenate((rng.permutation(base)[:keep], rng.integers(0, 1 << 63, 100 - keep, dtype=np.uint64))))
    far = [draw(88) for _ in range(120)]
    near = [np.unique(np.concatenate((s[3:], rng.integers(0, 1 << 63, 3, dtype=np.uint64)))) for s in far[:20]]
    return far + near


def test_only_pairs_that_wide_bitmaps_allow_leave_a_group(spark, group):
    rows = [(1, 0, 0, 0, i, i, len(s), signature_join.bitmap(s).tobytes(), []) for i, s in enumerate(group)]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = {tuple(r) for r in signature_join._tree_pairs(frame, 85).collect()}
    bounds = signature_join.Bounds(85)
    linked = lambda s, t: bounds.linked(len(np.intersect1d(s, t)), len(s), len(t))
    allowed = lambda s, t: signature_join.may_link(signature_join.bitmap(s), len(s), signature_join.bitmap(t), len(t), bounds)
    pairs = [(i, j) for i in range(len(group)) for j in range(i + 1, len(group))]
    assert {(i, j) for i, j in pairs if linked(group[i], group[j])} <= got
    assert got == {(i, j) for i, j in pairs if allowed(group[i], group[j])}
    assert len(got) < len(group)


def test_a_pair_leaves_the_first_group_of_both_only(spark, group):
    """Groups 1 and 2 hold all sets but one each, group 3 all: only the pair of those two leaves it."""
    group = [group[0]] * 6
    of = {i: [g for g in (1, 2, 3) if (g, i) not in ((1, 0), (2, 1))] for i in range(6)}
    rows = [(g, 0, 0, 0, i, i, 100, signature_join.bitmap(group[i]).tobytes(), [x for x in of[i] if x < g]) for i in of for g in of[i]]
    left = {}
    for g in (1, 2, 3):
        frame = spark.createDataFrame([r for r in rows if r[0] == g], SCHEMA)
        left[g] = {tuple(r) for r in signature_join._tree_pairs(frame, 85).collect()}
    every = {(i, j) for i in range(6) for j in range(i + 1, 6)}
    assert left[1] == {p for p in every if 0 not in p}
    assert left[2] == {p for p in every if 0 in p and 1 not in p}
    assert left[3] == {(0, 1)}


def test_members_of_one_group_are_members_of_one_cell(spark, monkeypatch):
    """Groups of one centre share a cell while it fits a block; a large group stays as it is."""
    monkeypatch.setattr(signature_join, "BLOCK", 6)
    groups = {g: [1, 2, 3 + g % 3] for g in range(40)} | {g: [7, 10 * g, 10 * g + 1] for g in range(40, 50)} | {50: list(range(600, 620))}
    rows = [(g, o, o, len(own), own[0]) for g, own in groups.items() for o in own]
    got = signature_join._cells(spark.createDataFrame(rows, "grp long, owner long, comp long, members long, centre long")).collect()
    assert len({(r.grp, r.owner) for r in got}) == len(got) == 5 + 30 + 20
    cells = {}
    for r in got:
        cells.setdefault(r.grp, set()).add(r.owner)
    assert all(any(set(own) <= cell for cell in cells.values()) for own in groups.values())
    assert {r.blocks for r in got if r.grp == 50} == {4} and {r.blocks for r in got if r.grp != 50} == {1}


def test_a_long_text_goes_into_few_trees(spark, monkeypatch):
    """Eight long texts have dozens of parts in common but no link; each moves its bitmap a few times, not once for each part."""
    rng = np.random.default_rng(11)
    words = [f"w{k}" for k in range(400)]
    texts = []
    for i in range(8):
        own = list(words)
        for k in rng.choice(400, 9, replace=False):
            own[k] = f"x{i}"
        texts.append((i, " ".join(own)))
    seen = []
    pairs = signature_join._tree_pairs
    monkeypatch.setattr(signature_join, "_tree_pairs", lambda rows, percent: seen.extend(rows.collect()) or pairs(rows, percent))
    out = signature_join.similarity_components(spark.createDataFrame(texts, "doc_id long, text string"), 4, 85)
    assert {r.component_id for r in out.collect()} == set(range(8))
    assert 8 <= len(seen) <= 64
    assert len({(r.grp, r.owner) for r in seen}) == len(seen)
    assert all(len(r.before) <= signature_join.TOLD_CELLS for r in seen)


def test_components_grow_by_links_as_if_all_were_known_at_once(spark):
    rng = np.random.default_rng(3)
    first = [tuple(int(x) for x in rng.choice(60, 2, replace=False)) for _ in range(20)]
    later = [tuple(int(x) for x in rng.choice(90, 2, replace=False)) for _ in range(25)]
    frame = lambda rows: spark.createDataFrame(rows, "a long, b long")
    nodes = lambda rows: {r.node: r.comp for r in rows.collect()}
    comps = common.components(frame(first))
    assert nodes(signature_join._merged(comps, frame(later))) == nodes(common.components(frame(first + later)))
    assert signature_join._merged(comps, frame(first)) is comps
    grown = signature_join._merged(comps, frame(later))
    assert grown.count() == grown.select("node").distinct().count()


def test_groups_of_one_centre_share_a_cell_of_several_blocks_where_that_moves_fewer_rows(spark, monkeypatch):
    """A large family of copies that share many parts: its rows do not grow with the number of parts."""
    monkeypatch.setattr(signature_join, "BLOCK", 8)
    rng = np.random.default_rng(5)
    groups = {g: [0, *sorted(int(x) for x in rng.choice(range(1, 40), 24, replace=False))] for g in range(30)}
    rows = [(g, o, o, len(own), 0) for g, own in groups.items() for o in own]
    got = signature_join._cells(spark.createDataFrame(rows, "grp long, owner long, comp long, members long, centre long")).collect()
    every = {o for own in groups.values() for o in own}
    assert {r.owner for r in got} == every and len(got) == len(every)
    assert {r.blocks for r in got} == {-(-len(every) // 8)}


def test_blocks_of_one_component_do_not_meet(spark, monkeypatch):
    """All pairs of different components meet exactly once; rows of a group of which most are linked grow as the group does."""
    monkeypatch.setattr(signature_join, "BLOCK", 8)

    def rows_of(linked, other, apart):
        comp = {o: 0 for o in range(linked)} | {o: 10**6 for o in range(linked, linked + other)}
        comp |= {linked + other + k: linked + other + k for k in range(apart)}
        blocks = -(-len(comp) // 8)
        frame = spark.createDataFrame([(1, o, c, blocks) for o, c in comp.items()], "grp long, owner long, comp long, blocks long")
        return comp, signature_join._block_pairs(frame).collect()

    comp, rows = rows_of(40, 20, 15)
    met = {}
    for r in rows:
        met.setdefault((r.p, r.q), []).append(r)
    pairs = []
    for (p, q), own in met.items():
        left, right = ([r.owner for r in own if r.block == b] for b in (p, q))
        pairs += [(a, b) for a in left for b in right if a < b] if p == q else [tuple(sorted((a, b))) for a in left for b in right]
    wanted = {(a, b) for a in comp for b in comp if a < b and comp[a] != comp[b]}
    assert wanted <= set(pairs) and len(pairs) == len(set(pairs))
    few, many = (len(rows_of(n, 0, 4)[1]) for n in (80, 320))
    assert many <= 4 * few


def test_a_walk_of_trees_is_cut_into_pieces(monkeypatch, group):
    """The same leaves, whatever number of pairs is looked at together."""
    wide = np.vstack([signature_join.bitmap(s)[:8] for s in group])
    sizes = np.array([len(s) for s in group])
    tree, bounds = signature_join.Tree(wide, sizes, np.arange(len(group))), signature_join.Bounds(85)
    whole = set(zip(*(x.tolist() for x in signature_join.walk(tree, tree, bounds))))
    monkeypatch.setattr(signature_join, "PAIRS_AT_ONCE", 5)
    assert whole and whole == set(zip(*(x.tolist() for x in signature_join.walk(tree, tree, bounds))))
