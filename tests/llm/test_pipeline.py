"""The whole pipeline against plain versions of the stages after the language."""

import hashlib
import math
from collections import Counter

import public_tokenizers

import corpus_pipeline
from changeloom.llm import language_crf, piece_viterbi, stages

from . import brute
from .test_tables import plain_targets


def plain_cut(texts: dict, length: int) -> dict:
    first: dict[bytes, int] = {}
    for i, t in sorted(texts.items()):
        t = t.encode()
        for k in range(len(t) - length + 1):
            first.setdefault(t[k : k + length], i)
    out = {}
    for i, t in texts.items():
        t = t.encode()
        gone = [False] * len(t)
        for k in range(len(t) - length + 1):
            if first[t[k : k + length]] < i:
                gone[k : k + length] = [True] * length
        rest = bytes(b for b, g in zip(t, gone) if not g).decode("utf-8", "ignore")
        if not any(gone) or rest.strip(" \t\n\v\f\r"):
            out[i] = rest
    return out


def plain_times(texts: dict, sources: dict) -> dict:
    size = {i: len(brute.WORD.findall(t)) for i, t in texts.items()}
    total = Counter()
    for i in texts:
        total[sources[i]] += size[i]
    target = plain_targets(dict(total), stages.SOURCE_WEIGHTS, stages.MOST_REPEATS)
    out, start = {}, Counter()
    for i in sorted(texts, key=lambda i: (hashlib.md5(f"7:{i}".encode()).hexdigest(), i)):
        source, n = sources[i], size[i]
        if n:
            rounds, rest = divmod(math.floor(target[source] + 0.5), total[source])
            taken = rounds * n + max(0, min(start[source] + n, rest) - start[source])
            out[i] = math.floor(taken / n + 0.5)
        start[source] += n
    return out


def test_the_pipeline_equals_plain_stages(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(language_crf, "train", lambda texts, langs, train=language_crf.train: train(texts, langs, epochs=2))
    rows = brute.documents(n=36)
    spark.createDataFrame(rows, brute.SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    sources = {r[0]: r[3] for r in rows}
    spoken = {r.doc_id: r.text for r in stages.language(spark, docs, "").collect()}
    comps = brute.linked_components(list(spoken.items()), stages.SHINGLE_WORDS, stages.LEAST_SIMILARITY_PERCENT)
    texts = plain_cut({i: t for i, t in spoken.items() if comps[i] == i}, stages.REPEATED_BYTES)
    times = plain_times(texts, sources)
    assert len(set(times.values())) > 2
    pieces = piece_viterbi.load(public_tokenizers.path(stages.PIECES_FILE))
    got = Counter((r.doc_id, r.text, r.decoded) for r in piece_viterbi.decode(corpus_pipeline.run(spark, str(tmp_path)), pieces).collect())
    assert got == {(i, texts[i], texts[i]): n for i, n in times.items() if n}


def test_columns_with_names_of_the_stages_go_through(spark):
    rows = [r[:5] for r in brute.documents(n=30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    names = ["_row", "_time", "_times", "_null", "_", "_lang", "_score", "extra_columns", "carried", "spans", "a.b"]
    clashing = docs.selectExpr("*", *[f"concat('{n}', doc_id) AS `{n}`" for n in names])
    for stage in (stages.language, stages.near_duplicates, stages.repeated_passages, stages.mixture):
        out = stage(spark, clashing, "")
        assert out.columns == clashing.columns
        got = sorted(map(str, (tuple(r) for r in out.collect())))
        plain = sorted(map(str, (tuple(r) for r in stage(spark, docs, "").selectExpr("*", *[f"concat('{n}', doc_id) AS `{n}`" for n in names]).collect())))
        assert got == plain and got
    out = stages.pieces(spark, clashing.withColumn("ids", clashing.doc_id), "")
    assert dict(out.dtypes)["ids"] == "array<int>" and set(names) <= set(out.columns) and out.count() == len(rows)


def test_language_without_labels_keeps_what_has_letters(spark):
    docs = spark.createDataFrame(
        [(1, "some words", None), (2, "12 !", None), (3, None, None), (4, "日本", None)], "doc_id long, text string, lang string"
    )
    assert sorted(r.doc_id for r in stages.language(spark, docs, "").collect()) == [1, 4]
