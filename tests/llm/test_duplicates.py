"""Similarity join and phrase dedup against brute force."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from changeloom.llm import phrase_dedup, signature_join

from . import brute


@pytest.fixture(scope="module")
def rows():
    return brute.documents()


def test_components_equal_brute_force(spark, rows):
    docs = spark.createDataFrame(rows, brute.SCHEMA).repartition(3)
    got = {r[0]: tuple(r[1:]) for r in signature_join.similarity_components(docs, 4, 85).collect()}
    comps = brute.linked_components([(r[0], r[1]) for r in rows], 4, 85)
    assert len(set(comps.values())) < len(comps) - 20
    assert got == {i: (len(brute.shingle_set(t, 4)), comps[i]) for i, t, *_ in rows}


@pytest.mark.parametrize("block", [7, 512])
def test_trees_alone_find_all_links(spark, rows, monkeypatch, block):
    monkeypatch.setattr(signature_join, "STAR_ROUNDS", 0)
    monkeypatch.setattr(signature_join, "BLOCK", block)
    docs = spark.createDataFrame(rows, brute.SCHEMA)
    out = signature_join.similarity_components(docs, 4, 85)
    comps = brute.linked_components([(r[0], r[1]) for r in rows], 4, 85)
    assert {r["doc_id"]: r["component_id"] for r in out.collect()} == comps


def test_null_ids_repeated_rows_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, "a b c d e"), (5, "a b c d e"), (5, "a b c d e"), (2, "A B C D E"), (9, None)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in signature_join.similarity_components(docs, 4, 85).collect())
    assert got == [(0, 2, None), (2, 2, 2), (5, 2, 2), (5, 2, 2), (9, 0, 9)]
    empty = docs.filter("false")
    assert signature_join.similarity_components(empty, 4, 85).collect() == []
    assert phrase_dedup.removals(empty).collect() == []


@pytest.mark.parametrize("percent", [80, 85])
def test_linked_sets_share_a_key(percent):
    rng = np.random.default_rng(5)
    bounds = signature_join.Bounds(percent)
    for _ in range(600):
        n = int(rng.integers(1, 300))
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        drop = int(rng.integers(0, max(1, int(n * 0.2)) + 1))
        b = np.unique(np.concatenate((rng.permutation(a)[drop:], rng.integers(0, 1 << 63, int(rng.integers(0, drop + 1)), dtype=np.uint64))))
        if not len(b):
            continue
        common = len(np.intersect1d(a, b))
        if bounds.linked(common, len(a), len(b)):
            assert np.intersect1d(signature_join.set_keys(a, bounds), signature_join.set_keys(b, bounds)).size
            assert signature_join.may_link(signature_join.bitmap(a), len(a), signature_join.bitmap(b), len(b), bounds)


def test_removed_bytes_equal_brute_force(spark, rows):
    docs = spark.createDataFrame(rows, brute.SCHEMA).repartition(3)
    got = sorted(tuple(r) for r in phrase_dedup.removals(docs).collect())
    want = sorted(brute.removed([(r[0], r[1]) for r in rows], 50))
    assert sum(r[2] for r in want) > 1000
    assert got == want


def test_hot_triggers_are_spread_over_buckets(spark, monkeypatch):
    """A passage between words of their own in many documents: no group gets a trigger's phrases whole."""
    rng, passage = np.random.default_rng(11), "what all of these documents have in common is this sentence, " * 2
    own = lambda: "".join(chr(97 + x) for x in rng.integers(0, 26, 60))
    rows = [(i, own() + passage[: 100 + i % 7] + own()) for i in range(90)] + [(i, own()) for i in range(90, 100)]
    rows += [(40, passage + own()), (None, passage), (200, "\0" * 90), (201, "\0" * 70)]
    monkeypatch.setattr(phrase_dedup, "HOT_PHRASES", 20)
    monkeypatch.setattr(phrase_dedup, "KEYS_PER_BUCKET", 40)
    monkeypatch.setattr(phrase_dedup, "DICTIONARY_PHRASES", 150)
    sent, dictionary = [], phrase_dedup._dictionary

    def watched(phrases, length):
        blobs = phrases.filter("blob is not null").select("blob").collect()
        for h, owner, *_ in (phrase_dedup._entries(pa.py_buffer(bytes(b.blob))) for b in blobs):
            sent.extend(set(zip(h.tolist(), owner.tolist())))
        return dictionary(phrases, length)

    monkeypatch.setattr(phrase_dedup, "_dictionary", watched)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    key = lambda r: (r[0] is None, *[x or 0 for x in r[:1]], *r[1:])
    got = sorted((tuple(r) for r in phrase_dedup.removals(docs).collect()), key=key)
    assert got == sorted(brute.removed(rows, 50), key=key)
    assert sent and max(Counter(h for h, _ in sent).values()) <= 20


def test_removal_defined_cases(spark):
    long = "".join(chr(97 + i % 26) + str(i) for i in range(60))
    data = [(3, long), (1, long[10:90]), (3, "zz" + long), (None, long), (7, None), (8, ""), (9, "\0" * 120), (10, "\0" * 60)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    key = lambda r: (r[0] is None, *[x or 0 for x in r[:1]], *r[1:])
    got = sorted((tuple(r) for r in phrase_dedup.removals(docs).collect()), key=key)
    assert got == sorted(brute.removed(data, 50), key=key)
    assert phrase_dedup.cut(docs).filter("doc_id = 3").select("spans").first()[0]
