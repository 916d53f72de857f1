"""Mixture, archives and vector searches against plain versions; the registry and the pipeline."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from changeloom.llm import ann_postings, language_crf, queries, source_mix, stages, topk_histogram, warc
from changeloom.sources.workspace import workspace, written

from . import brute


# Mixture


def plain_targets(sizes: dict, weights=(5, 2, 1), most=3.0) -> dict:
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, still, out = float(sum(sizes.values())), set(names), {}
    while still:
        level = left / sum(weight[s] for s in still)
        full = {s for s in still if weight[s] * level > most * sizes[s]}
        if not full:
            return out | {s: weight[s] * level for s in still}
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
        still -= full
    return out


def test_mix_meets_its_targets(spark):
    rows = brute.documents()
    docs = spark.createDataFrame(rows, brute.SCHEMA).repartition(3)
    got = source_mix.mix(docs).collect()
    source = {r[0]: r[3] for r in rows}
    words = {r[0]: len(brute.WORD.findall(r[1] or "")) for r in rows}
    sizes = {s: sum(words[i] for i in words if source[i] == s) for s in set(source.values())}
    want = plain_targets(sizes)
    assert len(got) == len(rows)
    for r in got:
        s = source[r.doc_id]
        assert r.size == words[r.doc_id] and r.source_size == sizes[s] and 0 <= r.taken <= 3 * r.size
        assert math.isclose(r.target, want[s], rel_tol=1e-9, abs_tol=1e-9)
    for s in sizes:
        assert abs(sum(r.taken for r in got if source[r.doc_id] == s) - want[s]) <= 0.5
    again = source_mix.mix(docs.repartition(5)).collect()
    assert sorted(again) == sorted(got)


def test_schedule_keeps_to_the_weights_all_along(spark):
    sources = spark.createDataFrame([(0, 500.0), (1, 200.0), (2, 100.0), (3, 0.0), (4, 0.6)], "src long, target double")
    rows = source_mix.schedule(sources, 300).collect()
    assert sorted(r.slot for r in rows) == [*range(300), 304]
    by_slot = sorted((r.slot, r.src, r.turn) for r in rows)
    for n in (50, 150, 300):
        for src, target in ((0, 500), (1, 200), (2, 100)):
            assert abs(sum(s == src for _, s, _ in by_slot[:n]) - n * target / 800.6) < 6
    seen: dict[int, int] = {}
    for _, src, turn in by_slot:
        assert turn == seen.get(src, 0)
        seen[src] = turn + 1


def test_mixing_nothing(spark):
    docs = spark.createDataFrame([], brute.SCHEMA)
    assert source_mix.mix(docs).collect() == []
    blank = spark.createDataFrame([(1, None, None), (2, " ", "a")], "doc_id long, text string, source string")
    assert [(r.size, r.target, r.taken) for r in source_mix.mix(blank).collect()] == [(0, 0.0, 0)] * 2


# Archives


def test_pages_come_back_from_their_archives(spark):
    rng = random.Random(4)
    long = ["<p>" + "".join(rng.choice("abé日 \r\n") for _ in range(k)) + "</p>" for k in (120, 5000, 90_000)]
    rows = [(i, f"http://h{i % 3}/x", rng.choice(long)) for i in range(5, 60)]
    rows += [(1, None, None), (2, "a\r\nb", ""), (3, "u", "short"), (4, "u", "short"), (None, "n", long[0]), (5, "again", rows[0][2])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in warc.archive(pages).collect())
    first: dict[str, int] = {}
    for i, _, html in rows:
        if i is not None and len((html or "").encode()) >= 100:
            first[html] = min(first.get(html, i), i)
    want = []
    for i, _, html in rows:
        raw = (html or "").encode()
        refers = first.get(html or "") if i is not None and i > first.get(html or "", i) else None
        want.append((str(i), len(raw), hashlib.sha256(raw).hexdigest(), "response" if refers is None else "revisit", str(refers)))
    assert got == sorted(want)


def test_only_ranges_of_wanted_records_are_read(spark):
    pages = spark.range(200).selectExpr("id page_id", "'u' url", "repeat(cast(id as string), 300) html").coalesce(1)
    index = warc.write(pages, workspace(spark, "warc"))
    some = warc.read(index.filter("page_id % 7 = 0")).collect()
    assert sorted((r.page_id, r.payload.decode()) for r in some) == [(i, str(i) * 300) for i in range(0, 200, 7)]
    offset, length = np.array([0, 10, 500, 520]), np.array([10, 20, 20, 5])
    assert warc.ranges(offset, length, gap=50, most=100) == [(0, 2), (2, 4)]
    assert warc.archive(pages.filter("false")).count() == 0


# Vectors


def vectors(n=300, dim=6, seed=3):
    rng = np.random.default_rng(seed)
    values = rng.normal(size=(n, dim)).astype(np.float32)
    values[100:140] = values[100]  # many equal ones
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(values)]
    return rows + [(1000, None), (1001, []), (1002, [1.0, None] + [0.0] * 4), (1003, [float("nan")] * 6), (1050, [0.0] * 6), (None, [1.0] * 6)]


def test_top_k_is_exact(spark, monkeypatch):
    monkeypatch.setattr(topk_histogram, "CANDIDATES", 70)
    monkeypatch.setattr(topk_histogram, "QUERIES", 4)
    rows = vectors()
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk_histogram.top_k(table, 50, 5).collect())
    good = [(i, np.floor(256 * np.array(v, dtype=float)).astype(int)) for i, v in rows if i is not None and (i < 1000 or i == 1050)]
    want = []
    for q, a in good:
        if q % 50 == 0:
            best = sorted((-int(a @ b), i) for i, b in good if i != q)[:5]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert got == sorted(want)


def test_huge_components_and_few_candidates(spark):
    rows = [(0, [1e12, -1e12]), (1, [1e12, 1.0]), (3, [1e300, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r.vec_id, r.score) for r in topk_histogram.top_k(table, 50, 5).orderBy("rank").collect()]
    assert [i for i, _ in got] == [1, 3] and got[0][1] == got[1][1] == 2**63 - 1
    assert topk_histogram.top_k(table.filter("false"), 50, 5).collect() == []


def test_nearest_are_found_and_scores_exact(spark, monkeypatch):
    monkeypatch.setattr(ann_postings, "LIST_ROWS", 20)
    monkeypatch.setattr(ann_postings, "BLOCK_ROWS", 16)
    rows = vectors()
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = ann_postings.nearest(table, 20, 10).collect()
    good = [(i, np.array(v, dtype=np.float64)) for i, v in rows if i is not None and i < 1000]
    hits, queries_ = 0, [i for i, _ in good if i % 20 == 0]
    for q in queries_:
        own = sorted((r["rank"], r.vec_id, r.score) for r in got if r.query_id == q)
        a = good[q][1]
        true = sorted((float(np.sqrt(((b - a) ** 2).sum())), i) for i, b in good if i != q)[:10]
        assert [k for k, _, _ in own] == list(range(1, 11))
        assert all(s == float(np.sqrt(((good[i][1] - a) ** 2).sum())) for _, i, s in own)
        assert [(s, i) for _, i, s in own] == sorted((s, i) for _, i, s in own)
        hits += len({i for _, i in true} & {i for _, i, _ in own})
    assert len(got) == 10 * len(queries_) and hits >= 0.9 * len(got)
    assert ann_postings.nearest(table.filter("false"), 20, 10).collect() == []


# Pipeline


def test_stages_keep_the_columns_and_the_clean_documents(spark, monkeypatch):
    monkeypatch.setattr(language_crf, "train", lambda texts, langs, train=language_crf.train: train(texts, langs, epochs=2))
    docs = spark.createDataFrame(brute.documents(n=60), brute.SCHEMA)
    texts = {r.doc_id: r.text for r in docs.collect()}
    spoken = stages.language(spark, docs, "")
    assert spoken.columns == docs.columns
    kept = {r.doc_id for r in spoken.collect()}
    assert {i for i in texts if i not in kept} >= {i for i, t in texts.items() if not any(c.isalpha() for c in t or "")}
    assert len(kept) > 0.85 * len(texts)
    one = stages.near_duplicates(spark, docs, "")
    comps = brute.linked_components(list(texts.items()), 5, 80)
    assert one.columns == docs.columns and sorted(r.doc_id for r in one.collect()) == sorted(set(comps.values()))
    rest = stages.repeated_passages(spark, docs, "").collect()
    want = {i: n for i, _, n, _, _ in brute.removed(list(texts.items()), 50)}
    for r in rest:
        assert (r.text == texts[r.doc_id]) == (want[r.doc_id] == 0) and (want[r.doc_id] == 0 or r.n_chars == len(r.text))
    assert {i for i, n in want.items() if n == 0} <= {r.doc_id for r in rest}


def test_repeated_ids_leave_one_row(spark):
    rows = [(1, "a b c d e f", "x"), (1, "a b c d e f", "x"), (2, "g h i j k", None), (None, "a b c", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted((str(r.doc_id), r.text) for r in stages.near_duplicates(spark, docs, "").collect())
    assert got == [("1", "a b c d e f"), ("2", "g h i j k"), ("None", "a b c")]


def test_different_texts_of_one_id_stay(spark):
    first, second, third = ("one two three four five six", "seven eight nine ten eleven twelve", "red green blue white black grey")
    rows = [(1, first), (2, first), (2, second), (2, second), (3, third), (3, first), (None, first), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = sorted((str(r.doc_id), str(r.text)) for r in stages.near_duplicates(spark, docs, "").collect())
    assert got == [("1", first), ("2", second), ("3", third), ("5", "None"), ("None", first)]


def test_mixture_counts_rows_with_and_without_words_and_ids(spark):
    rows = [(None, f"w{k} " * (k + 1), "abc"[k % 3]) for k in range(30)]
    rows += [(k % 10, f"v{k} " * (30 - k), "abc"[k % 3]) for k in range(30)]
    rows += [(100, None, "a"), (101, "", "b"), (None, " \t\v\f ", "c"), (102, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("at", F.monotonically_increasing_id())
    docs = written(docs, "docs")
    got = stages.mixture(spark, docs, "")
    assert got.columns == docs.columns
    counts = {}
    for r in got.collect():
        counts[r.at] = counts.get(r.at, 0) + 1
    mixed = source_mix.mix(docs, stages.SOURCE_WEIGHTS, stages.MOST_REPEATS, key="at").collect()
    assert len(mixed) == len(rows) and sum(r["size"] == 0 for r in mixed) == 4
    want = {r.row: math.floor(r.taken / r["size"] + 0.5) for r in mixed if r["size"]}
    assert len({n for n in want.values()}) > 1
    assert counts == {row: n for row, n in want.items() if n}


def test_rests_of_form_feeds_are_blank(spark):
    passage = "a passage of more than fifty bytes that two documents have in common, to be cut"
    docs = spark.createDataFrame([(1, passage), (2, f"\f\v{passage}\v\f"), (3, None), (4, "\f")], "doc_id long, text string")
    assert sorted(r.doc_id for r in stages.repeated_passages(spark, docs, "").collect()) == [1, 3, 4]


def test_registry():
    names = set(queries.registered())
    assert {n.split("_")[0] for n in names} == {f"op{k}" for k in range(1, 11)}
    assert set(queries.oracle()) <= names
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "repeated_passages", "mixture", "pieces"]


@pytest.mark.parametrize("name", ["op5_warc", "op6_topk_histogram", "op8_source_mix"])
def test_query_equals_its_twin(spark, name):
    duckdb = pytest.importorskip("duckdb")
    import check

    folder = "/root/testdata/sf0.001"
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    result = queries.registered()[name](spark, folder)
    cursor = duck.execute(queries.oracle()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(result.columns)
    assert check.rows(result.columns, result.collect()) == check.rows(columns, cursor.fetchall())
