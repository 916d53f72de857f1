"""Restoring disguised text and scoring it: all readings of small lattices, planted disguises, held-out labels."""

import itertools
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from changeloom.llm import noisy_channel as nc, textbytes

BAD = ["idiot", "moron", "scum", "worthless", "stupid", "trash"]
SOUNDS = ["er", "th", "on", "an", "ing", "re", "ti", "es", "st", "ed"]


def corpus(n=600, seed=2):
    """``doc_id, text, toxic, disguised``: a third of the toxic rows have their words disguised."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = ["".join(rng.choices(SOUNDS, k=rng.randint(1, 4))) for _ in range(rng.randint(4, 80))]
        toxic, disguised = rng.random() < 0.3, False
        if toxic:
            disguised = rng.random() < 0.33
            for _ in range(2):
                bad = rng.choice(BAD)
                words.insert(rng.randrange(len(words)), disguise(bad, rng) if disguised else bad)
        rows.append((i, " ".join(words), int(toxic), disguised))
    return rows


def disguise(word, rng):
    kind = rng.randrange(3)
    if kind == 0:
        return word.translate(str.maketrans({"i": "1", "o": "0", "a": "@", "s": "$", "u": "u", "e": "3"})).replace("scum", "5cum")
    if kind == 1:
        return rng.choice([" ", ".", "-"]).join(word)
    at = rng.randrange(len(word))
    return word[:at] + word[at] * 3 + word[at:]


def model_of(texts):
    data, offsets = textbytes.flat(pa.array(texts, pa.string()))
    return nc.language_model(nc.grams(data, offsets))


def test_grams_are_counted_within_words():
    data, offsets = textbytes.flat(pa.array(["Ab a", None, "é9b", ""], pa.string()))
    counts = nc.grams(data, offsets)
    got = {tuple(int(x) for x in np.unravel_index(i, (28, 28, 28))): int(counts[i]) for i in np.flatnonzero(counts)}
    gap, other, a, b = 27, 26, 0, 1
    want = {}
    for word in ([a, b], [a], [other, other], [b]):  # the accent takes two bytes
        chain = [gap, gap, *word, gap]
        for three in zip(chain, chain[1:], chain[2:]):
            want[three] = want.get(three, 0) + 1
    assert got == want


def test_best_path_is_the_best_of_all_readings():
    texts = [t for _, t, _, _ in corpus(80)]
    model = model_of(texts)

    def value(lattice, path):
        a = b = 27
        total = 0.0
        for options, k in zip(lattice, path):
            _, seen, cost = options[k]
            total -= cost
            for c in nc._symbols(seen):
                total += float(model[a, b, c])
                a, b = b, c
        return total + float(model[a, b, 27])

    stretches = ["1d10t", "i d i o t", "m00r0n", "5cuuum", "$t.u", "11", "a1a", "ööö1", "x", "T r @", "st--up", "00b", "n9-6"]
    lattices = [nc.lattice(s) for s in stretches]
    for lattice, path in zip(lattices, nc.viterbi(lattices, model)):
        best = max(value(lattice, p) for p in itertools.product(*[range(len(o)) for o in lattice]))
        assert abs(value(lattice, path) - best) < 1e-3


def test_suspects_and_what_stays():
    def found(text):
        data, offsets = textbytes.flat(pa.array([text], pa.string()))
        return [data.tobytes()[a:b].decode() for a, b in zip(*nc.suspects(data, offsets))]

    assert found('The 1d10t, "m0r0n" and $cum! f.o.o') == ["1d10t", "m0r0n", "$cum", "f.o.o"]
    assert found("so i d i o t s") == ["i d i o t s"]
    assert found("nooo way") == ["nooo"]
    assert found("hello! well-known 1995 (plain) words%%% more$$$ I a b") == ["I a b"]
    assert found("été 12 . , \n") == []


def test_long_stretches_in_windows_are_the_whole(monkeypatch):
    model = model_of([t for _, t, _, _ in corpus(80)])
    text = "1d10t m0r0n " * 60
    text = "-".join(text)
    whole = nc.decode([text], model)
    monkeypatch.setattr(nc, "WINDOW", 64)
    assert nc.decode([text], model) == whole


def test_texts_are_restored_in_place_and_in_stretches(spark, monkeypatch):
    rows = [(1, "An 1d10t here\nm.o.r.o.n t h e r e"), (2, "plain words"), (3, None), (4, ""), (5, ("st0p here now " * 400))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = nc.Model(model_of(["an idiot here moron there stop now plain words"] * 50), np.zeros(0, np.uint64), np.zeros(0), -1.0)
    out = {r.doc_id: r for r in nc.score(docs, model, restored="plain").collect()}
    assert out[1].plain == "An idiot here\nmoron there"
    assert (out[2].plain, out[3].plain, out[4].plain) == ("plain words", "", "")
    assert out[5].plain == "stop here now " * 400
    assert {round(r.score, 6) for r in out.values()} == {round(1 / (1 + np.e), 6)}
    column = pa.array([t for _, t in rows], pa.string())
    whole = nc._features(column, model.language, {}, None)
    real = nc.stretches
    monkeypatch.setattr(nc, "stretches", lambda column, fits: real(column, fits, 64))
    assert all(np.array_equal(a, b) for a, b in zip(nc._features(column, model.language, {}, None), whole))


def test_disguised_words_of_held_out_rows(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "x") for i, t, _, _ in rows], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, 1, x) for i, _, x, _ in rows] + [(3, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model = nc.fit(docs, labels)
    out = {r.doc_id: r for r in nc.score(docs, model).withColumn("held", nc.held_out(F.col("doc_id"))).collect()}
    held = [r for r in rows if out[r[0]].held]
    hidden = [r for r in held if r[3]]
    assert len(held) > 150 and len(hidden) >= 10
    assert all(out[i].score < 0.5 for i, _, toxic, _ in held if not toxic)
    assert np.mean([out[i].score >= 0.7 for i, _, toxic, _ in held if toxic]) > 0.95
    assert np.mean([out[i].score >= 0.7 for i, *_ in hidden]) > 0.85


def test_odd_rows_and_labels(spark):
    docs = spark.createDataFrame(
        [(1, None, 9), (2, "", 9), (2, "1 2 3", 9), (None, "word", 9), (4, "aaaa" * 500, 9)], "doc_id long, text string, _text int"
    )
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = nc.score(docs, nc.fit(docs, labels))
    assert out.columns == ["doc_id", "text", "_text", "score"] and out.count() == 5
    assert out.filter("score > 1e-6").count() == 0
    empty = docs.limit(0)
    assert nc.score(empty, nc.fit(empty, labels)).count() == 0
    all_toxic = spark.createDataFrame([(2, 0, 1), (2, 1, 0), (4, 0, 1)], "doc_id long, quality int, toxic int")
    assert nc.score(docs, nc.fit(docs, all_toxic)).filter("score > 0.999").count() in (0, 5)


def test_signs_are_words_and_stems():
    texts = ["Réeuxment réeux abc", "", "abcdef abcde 日本日本日本"]
    data, offsets = textbytes.flat(pa.array(texts, pa.string()))
    row, sign = nc.signs(data, offsets)

    def named(text, stem):
        raw = np.frombuffer(text.encode(), dtype=np.uint8)
        h = textbytes.span_hashes(raw, np.array([0]), np.array([len(raw)]))
        return int((textbytes.mixed(h + np.uint64(1)) if stem else h)[0]) & (2**64 - 4)

    want = [(0, named(w, False)) for w in ("réeuxment", "réeux", "abc")] + [(0, named("réeux", True))] * 2
    want += [(2, named(w, False)) for w in ("abcdef", "abcde", "日本日本日本")] + [(2, named("abcde", True))] * 2 + [(2, named("日本日本日", True))]
    assert sorted(zip(row.tolist(), map(int, sign))) == sorted(want)


def test_weights_are_at_the_maximum():
    rng = np.random.default_rng(5)
    x = rng.random((200, 6)) < 0.3
    y = (rng.random(200) < 1 / (1 + np.exp(-(x @ np.array([2.0, -1, 0, 1, 0, 3]) - 1)))).astype(float)
    row, feature = np.nonzero(x)
    weights, bias = nc.train(row, feature, y, 6, rounds=20_000, decay=0.1)
    p = 1 / (1 + np.exp(-(x @ weights + bias)))
    assert np.abs(x.T @ (y - p) - 0.1 * weights).max() < 1e-3 and abs((y - p).sum()) < 1e-3
