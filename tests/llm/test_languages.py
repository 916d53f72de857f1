"""Many languages, long labelled texts and rows that cannot be learned from."""

import tracemalloc

import numpy as np
import pytest

from changeloom.llm import language_crf


def chain(words, emission, model):
    """Plain forward-backward of one document."""
    move, start, table = np.exp(model.transitions), np.exp(model.start), np.exp(emission)
    a, b = [start * table[words[0]]], [np.ones(len(start))]
    for w in words[1:]:
        x = (a[-1] / a[-1].sum() @ move) * table[w]
        a.append(x)
    for w in words[:0:-1]:
        x = move @ (table[w] * b[-1])
        b.append(x / x.sum())
    out = np.array(a) * np.array(b[::-1])
    return out / out.sum(axis=1, keepdims=True)


def invented(size, rng):
    names = tuple(f"l{k}" for k in range(size))
    return language_crf.Model(names, np.zeros((2, size)), rng.normal(size=(size, size)), rng.normal(size=size), frozenset())


@pytest.mark.parametrize("held", [1, 1 << 21])
@pytest.mark.parametrize("size", [2, 7, 40])
def test_documents_of_all_lengths_in_one_batch(size, held, monkeypatch):
    monkeypatch.setattr(language_crf, "HELD_PRODUCTS", held)
    rng = np.random.default_rng(size)
    model, emission = invented(size, rng), rng.normal(size=(60, size))
    lengths = [1, 2, 127, 128, 129, 256, 257, 384, 900, 3, 1300]
    docs = [rng.integers(0, 60, n) for n in lengths]
    got = language_crf.posteriors(np.concatenate(docs), np.repeat(np.arange(len(docs)), lengths), emission, model)
    np.testing.assert_allclose(got, np.concatenate([chain(d, emission, model) for d in docs]), atol=1e-9)


def test_memory_is_linear_in_languages():
    rng = np.random.default_rng(5)
    peaks = []
    words, doc = rng.integers(0, 500, 17_000), np.repeat(np.arange(100), 170)
    for size in (30, 120):
        model, emission = invented(size, rng), rng.normal(size=(500, size))
        tracemalloc.start()
        language_crf.posteriors(words, doc, emission, model)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 6 * peaks[0] and peaks[1] < 100_000_000, peaks


def test_120_languages_are_learned_and_told_apart(spark):
    """Each language has its own words; some have only texts longer than what is learned from one row."""
    rng = np.random.default_rng(8)
    own = [["".join(chr(97 + x) for x in rng.integers(0, 26, 7)) for _ in range(6)] for _ in range(120)]
    text = lambda k, n: " ".join(own[k][x] for x in rng.integers(0, 6, n))
    rows = [(i, text(i % 120, 400 if i % 120 > 110 else 25), f"l{i % 120:03}") for i in range(120 * 8)]
    # What cannot be learned from takes no share of its language's rows.
    rows += [(5000 + i, None if i % 2 else "12 -- 34", "l000") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_crf.fit(docs, sample_chars=300)
    assert len(model.languages) == 120
    out = language_crf.identify(docs.filter("doc_id < 5000"), model).collect()
    assert np.mean([r.lang == r.lang_pred for r in out]) > 0.97


def test_languages_beyond_the_sample_are_the_rarest(spark):
    rows = [(i, "ein schöner tag", "de") for i in range(40)] + [(50 + i, "un beau jour", "fr") for i in range(30)] + [(90, "dia bonito", "pt"), (91, "dia", "pt")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert set(language_crf.fit(docs, sample_rows=2).languages) <= {"de", "fr"}
