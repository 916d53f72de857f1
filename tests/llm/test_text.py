"""Language, quality, pieces and token counts against plain versions and held-out labels."""

import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from changeloom.llm import language_crf, ordinal_quality, piece_viterbi, textbytes, token_counts

from . import brute

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "  two  spaces ", "日本\n\t▁x", "x" * 700, "é" * 300 + "ﬁ𝒳", "a\0b", "aaaa" * 900, "12 !!"]


# Words and hashes


def test_words_and_shingles_equal_plain_ones():
    texts = [t for _, t, *_ in brute.documents(n=40)] + ODD
    data, offsets = textbytes.flat(pa.array(texts, pa.string()))
    starts, ends, first = textbytes.words(data, offsets)
    raw = data.tobytes()
    for i, text in enumerate(texts):
        own = [raw[s:e].decode() for s, e in zip(starts[first[i] : first[i + 1]], ends[first[i] : first[i + 1]])]
        assert own == brute.WORD.findall(text or "")
    sh, at = textbytes.shingles(data, offsets, 4)
    assert [b - a for a, b in zip(at, at[1:])] == [len(brute.shingle_set(t, 4)) for t in texts]


# Language


def languages(n=400, seed=1):
    rng = random.Random(seed)
    sounds = {"aa": ["ka", "ro", "mi", "tu"], "bb": ["sch", "ein", "ung", "ber"], "cc": ["eau", "ois", "ille", "qué"]}
    rows = []
    for i in range(n):
        lang = rng.choice(list(sounds))
        rows.append((i, " ".join("".join(rng.choices(sounds[lang], k=rng.randint(1, 4))) for _ in range(rng.randint(3, 60))), lang))
    return rows


def test_languages_of_held_out_rows(spark):
    rows = languages()
    docs = spark.createDataFrame(rows + [(1000, None, "aa"), (1001, "123 ²!", "bb"), (None, "karo mitu", None)], "doc_id long, text string, lang string")
    model = language_crf.fit(docs)
    out = {r.doc_id: r for r in language_crf.identify(docs, model).withColumn("held", language_crf.held_out(F.col("doc_id"))).collect()}
    held = [i for i, _, _ in rows if out[i].held]
    assert 40 < len(held) < 130
    assert np.mean([out[i].lang_pred == lang for i, _, lang in rows if out[i].held]) > 0.98
    assert all(0 <= r.score <= 1 for r in out.values())
    assert [out[i].lang_pred for i in (1000, 1001)] == ["und", "und"] and out[None].lang_pred == "aa"


def test_segments_are_the_unsegmented_chain():
    rng = np.random.default_rng(0)
    model = language_crf.Model(("a", "b", "c"), np.zeros((2, 3)), rng.normal(size=(3, 3)), rng.normal(size=3), frozenset())
    emission = rng.normal(size=(50, 3)) * 3
    docs = [rng.integers(0, 50, n) for n in (1, 2, 130, 300, 128, 129, 5)]
    doc = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    got = language_crf.posteriors(np.concatenate(docs), doc, emission, model)
    move, start, at = np.exp(model.transitions), np.exp(model.start), 0
    for words in docs:
        e, n = np.exp(emission[words]), len(words)
        alpha, beta = np.zeros((n, 3)), np.ones((n, 3))
        for t in range(n):
            a = start * e[t] if t == 0 else (alpha[t - 1] @ move) * e[t]
            alpha[t] = a / a.sum()
        for t in range(n - 2, -1, -1):
            b = move @ (e[t + 1] * beta[t + 1])
            beta[t] = b / b.sum()
        post = alpha * beta
        assert np.allclose(post / post.sum(axis=1, keepdims=True), got[at : at + n])
        at += n


def test_code_switched_words_get_their_own_language():
    rows = languages()
    model = language_crf.train([t for _, t, _ in rows], [k for _, _, k in rows])
    types = np.array(["karo", "mitu", "roka", "einung", "berein", "ungsch"], dtype=object)
    post = language_crf.posteriors(np.arange(6), np.zeros(6, dtype=int), language_crf.emissions(types, model), model)
    assert [model.languages[k] for k in post.argmax(axis=1)] == ["aa"] * 3 + ["bb"] * 3


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some words", None)], "doc_id long, text string, lang string")
    assert language_crf.identify(docs, language_crf.fit(docs)).first().lang_pred == "und"
    assert language_crf.identify(docs.filter("false"), language_crf.fit(docs)).count() == 0


# Quality


def test_grades_of_rows_that_were_not_learned_from(spark):
    rng = random.Random(2)
    common = ["the", "of", "stone", "river", "light", "house", "walk", "green"]
    rows, rated = [], []
    for i in range(600):
        words = rng.choices(common, k=rng.randint(20, 80))
        kind = i % 3
        if kind == 0:
            words[rng.randrange(len(words))] = rng.choice(["vile", "scum"])
        elif kind == 1:
            words = [w + "%%%" for w in words]
        rows.append((i, " ".join(words), "x"))
        rated.append((i, int(kind != 1), int(kind == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, grade string")
    labels = spark.createDataFrame(rated, "doc_id long, quality int, toxic int")
    model = ordinal_quality.fit(docs, labels.filter("doc_id < 400"))
    assert np.all(np.diff(model.thresholds) > 0)
    out = ordinal_quality.rate(docs.filter("doc_id >= 400"), model).collect()
    assert np.mean([r.grade == [0, 1, 2][r.doc_id % 3] for r in out]) > 0.97
    assert all(abs(r.expected_grade - (r.p_acceptable + r.p_good)) < 1e-9 for r in out)
    assert {r.doc_id % 3 for r in ordinal_quality.select(ordinal_quality.rate(docs, model)).collect()} >= {1, 2}


def test_quality_of_odd_rows(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = ordinal_quality.rate(docs, ordinal_quality.fit(docs, none)).collect()
    assert len(out) == len(ODD) and all(abs(r.p_good - 1 / 3) < 1e-9 for r in out)


# Pieces


@pytest.fixture(scope="module")
def pieces():
    return piece_viterbi.load(PATH)


def best_score(text: str, vocabulary: dict, p) -> float:
    text = " " + text
    best = [0.0] + [-1e18] * len(text)
    for j in range(1, len(text) + 1):
        for i in range(max(0, j - 20), j):
            piece = vocabulary.get(text[i:j].encode())
            if piece is not None:
                best[j] = max(best[j], best[i] + p.scores[piece])
        best[j] = max(best[j], best[j - 1] + p.fallback)
    return best[-1]


def test_pieces_are_the_best_and_come_back(spark, pieces):
    single = set(pieces.byte_ids.tolist())
    vocabulary = {t: i for i, t in enumerate(pieces.table) if t and i not in single}
    texts = ODD + [t for _, t, *_ in brute.documents(n=12) if len(t or "") < 3000]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    out = piece_viterbi.decode(piece_viterbi.encode(docs, pieces), pieces).collect()
    assert len(out) == len(texts)
    for row in out:
        text = texts[row.doc_id] or ""
        assert row.decoded == text and row.n_pieces == len(row.ids)
        spelt = b"".join(pieces.table[i] for i in row.ids if i in single)
        chars = sum((b & 0xC0) != 0x80 for b in spelt)
        assert row.n_fallback == len(spelt)
        score = sum(pieces.scores[i] for i in row.ids if i not in single) + chars * pieces.fallback
        assert not text or abs(score - best_score(text, vocabulary, pieces)) < 1e-6


def test_long_stretches_are_cut_as_short_ones(pieces, monkeypatch):
    texts = ["abcde" * 30, "日本" * 40 + "x", "the" * 50]
    data, offsets = textbytes.flat(pa.array(texts))
    one = piece_viterbi.encode_flat(data, offsets, pieces)
    monkeypatch.setattr(piece_viterbi, "LONG", 8)
    monkeypatch.setattr(piece_viterbi, "_cut_together", None)
    assert all(np.array_equal(x, y) for x, y in zip(one, piece_viterbi.encode_flat(data, offsets, pieces)))


def test_double_array_finds_what_it_holds():
    rng = random.Random(5)
    keys = sorted({bytes(rng.choices(range(1, 256), k=rng.randint(1, 5))) for _ in range(800)})
    base, check, value = piece_viterbi.double_array([(k, i) for i, k in enumerate(keys)])
    known = {k: i for i, k in enumerate(keys)}
    for key in [*keys, *(bytes(rng.choices(range(256), k=3)) for _ in range(800))]:
        state = 0
        for b in key:
            there = base[state] + b
            state = there if there > 0 and check[there] == state else -1
            if state < 0:
                break
        assert (value[state] if state >= 0 else -1) == known.get(key, -1)


# Token counts


@pytest.mark.parametrize("stretch, overlap", [(1000, 64), (300, 8)])
def test_token_counts_equal_the_library(spark, stretch, overlap):
    rng = random.Random(1)
    texts = [*ODD, "aaaa" * 3000, "日本語🎉é " * 300, "=" * 3000, "a" * 700 + " b" * 500]
    texts.append(" ".join(rng.choice(["the", "of", "ation", "  ", "\n", "ß", "😀", "|"]) for _ in range(4000)))
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, "one two")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    got = sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(docs, PATH, stretch, overlap).collect())
    assert got == sorted((i or -1, len((t or "").encode()), len(model.encode(t or ""))) for i, t in rows)


def test_overlaps_widen_before_stretches_join(spark, monkeypatch):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["international", "straightforward", "the", "日本語", "of"]) for _ in range(900)), "=" * 2500]
    widths, widened = [], token_counts._widened

    def watched(stretches, failed):
        out = widened(stretches, failed)
        sizes = lambda df: {(r.row, r.part): len(r.text) for r in df.collect()}
        widths.append((sizes(stretches), sizes(out)))
        return out

    monkeypatch.setattr(token_counts, "_widened", watched)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    got = sorted((r.doc_id, r.n_tokens) for r in token_counts.count_tokens(docs, PATH, 200, 2).collect())
    assert got == [(i, len(model.encode(t))) for i, t in enumerate(texts)]
    before, after = widths[0]
    assert before.keys() == after.keys() and {after[k] - before[k] for k in after} == {0, 2}
    assert len(widths) > 2 and len(widths[-1][1]) < len(before)
