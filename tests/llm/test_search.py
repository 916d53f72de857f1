"""Ranked search against a plain version in whole numbers."""

import collections
import math
import random
import re

import numpy as np
import pytest

from changeloom.llm import blas_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, k=20):
    own = [(i, terms(t)) for i, t in docs]
    count, total = sum(bool(t) for _, t in own), sum(len(t) for _, t in own)
    df = collections.Counter(x for _, t in own for x in set(t))
    out = []
    for item_id, text in set(items):
        scored = []
        for doc_id, words in own:
            tf = collections.Counter(words)
            score = 0
            for x in terms(text):
                if tf[x]:
                    m = 100 - 25 + 25 * len(words) * count // total
                    score += math.floor(1000 * math.log((2 * count + 2) / (2 * df[x] + 1))) * (10**9 * tf[x] // (1000 * tf[x] + 12 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        out += [(item_id, n + 1, None if null else d, -s) for n, (s, null, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def rows(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


def tables(seed=4, n=150):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice(["ba", "no", "Ti", "é", "x1", "日本", "Z"]) for _ in range(rng.randint(1, 3))) for _ in range(60)]
    docs = [(i, rng.choice([" ", "-", "\x00", "_"]).join(rng.choices(vocabulary, k=rng.choice([0, 1, 3, 30, 200])))) for i in range(n)]
    docs += [(7, "ba ba"), (7, "ba ba"), (None, "ba no"), (None, "x1"), (n, None), (n + 1, ""), (n + 2, " .,!\t")]
    docs += [(1000 + i, "same words here x1") for i in range(60)]  # ties beyond the 20
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 12)))) for i in range(30)]
    items += [(3, "another text of 3 ba"), (50, None), (51, "..."), (52, "x1 x1 x1"), (53, "same"), (None, "ba"), (53, "same")]
    return docs, items


def frames(spark, docs, items):
    return (
        spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, n int").repartition(5),
        spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, score int"),
    )


def test_search_equals_plain_scores(spark, monkeypatch):
    docs, items = tables()
    assert rows(blas_search.search(*frames(spark, docs, items))) == plain(docs, items)
    # The same in small tiles, blocks, chunks and stretches.
    for name in ("TILE_ITEMS", "TILE_DOCS", "TILE_TERMS"):
        monkeypatch.setattr(blas_search, name, 7)
    real = blas_search.stretches
    monkeypatch.setattr(blas_search, "stretches", lambda column, fits: real(column, fits, 40))
    assert rows(blas_search.search(*frames(spark, docs, items), k=3, chunk_bytes=400)) == plain(docs, items, 3)


def test_empty_tables(spark):
    docs, items = tables()
    d, i = frames(spark, docs, items)
    assert blas_search.search(d.limit(0), i).count() == 0
    assert blas_search.search(d, i.limit(0)).count() == 0


@pytest.mark.parametrize("top", [1, 10**4, 10**9, 10**12])
def test_products_are_exact_beyond_floats(top):
    rng = random.Random(top)
    left = np.array([[rng.randint(0, top) for _ in range(90)] for _ in range(5)])
    right = np.array([[rng.randint(0, 999_999) for _ in range(4)] for _ in range(90)])
    want = [[sum(int(a) * int(b) for a, b in zip(row, column)) for column in right.T] for row in left]
    got = blas_search.product(left, right)
    assert [[x % 2**64 for x in row] for row in want] == [[int(x) % 2**64 for x in row] for row in got]


def test_impacts_of_very_long_documents():
    n = np.array([10**9, 5])
    got = blas_search.impacts_of(np.array([3, 1]), n, 10**11, 10**12)
    m = [75 + 25 * int(x) * 10**11 // 10**12 for x in n]
    assert list(got) == [3 * 10**9 // (3000 + 12 * m[0]), 10**9 // (1000 + 12 * m[1])]


def test_best_keeps_ties_by_id():
    best = blas_search.Best(2, 2)
    best.add(0, np.array([[5, 5, 5], [0, 0, 1]]), np.array([9, 4, 6]), np.zeros(3, bool))
    best.add(0, np.array([[5, 5, 4], [1, 0, 0]]), np.array([5, 2, 1]), np.array([False, True, False]))
    assert list(zip(best.item, best.score, best.doc)) == [(0, 5, 4), (0, 5, 5), (1, 1, 5), (1, 1, 6)]
