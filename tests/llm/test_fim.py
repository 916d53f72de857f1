"""Fill-in-middle against a plain version over code points."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from changeloom.llm import fim_index

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def texts(seed=6):
    rng = random.Random(seed)
    alphabet = ["a", "é", "日", "𝒳", " ", "\n", "\t", "<", "P>", "\x0b", " ", "z"]
    found = ["".join(rng.choices(alphabet, k=rng.choice([1, 2, 5, 40, 300]))) for _ in range(200)]
    return [None, "", " ", "one", "<P>", "a <S> b", "x<M>", "日本 é " * 3000, "plain text " * 3000, "<<P", *found]


def plain(doc_id, text, seed, rate, spm, unit):
    text = text or ""
    units = TOKEN.findall(text) if unit == "token" else list(text)
    n = len(units)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    if not text or any(m in text for m in fim_index.MARKERS) or h3 % 100 >= rate:
        return n, "plain", None, None, None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h4 % 100 < spm else "psm"
    output = f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return n, form, len(prefix), len(middle), len(prefix.encode()), len(middle.encode()), output


@pytest.mark.parametrize("unit, block", [("token", 1 << 20), ("token", 50), ("char", 1 << 20), ("char", 50)])
def test_cuts_equal_plain_ones(spark, monkeypatch, unit, block):
    monkeypatch.setattr(fim_index, "BLOCK_BYTES", block)
    for rate, spm in ((50, 80), (100, 50)):
        for doc_id, text in [*enumerate(texts()), (None, "no id here")]:
            data = np.frombuffer((text or "").encode(), dtype=np.uint8)
            got = fim_index._transformed(data, doc_id, 42, rate, spm, unit, tuple(m.encode() for m in fim_index.MARKERS))
            assert (*got[:6], got[6].decode()) == plain(doc_id, text, 42, rate, spm, unit)


def test_table_and_round_trip(spark):
    rows = [(i, t, 5, "kept") for i, t in enumerate(texts())] + [(None, "no id here", 5, "kept"), (3, "again again", 5, "kept")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int, _row string")
    out = fim_index.fill_in_middle(docs, rate=100, spm=50)
    out = out.withColumn("back", fim_index.restored(F.col("output"), F.col("form")))
    got = sorted(map(str, ((r.doc_id, r.n, r.form, r.prefix_chars, r.output, r.back, r._row) for r in out.collect())))
    want = []
    for doc_id, text, _, kept in rows:
        p = plain(doc_id, text, 42, 100, 50, "token")
        want.append(str((doc_id, p[0], p[1], p[2], p[6], text or "", kept)))
    assert got == sorted(want)
    assert {"psm", "spm", "plain"} == {r.form for r in out.select("form").distinct().collect()}
    assert fim_index.fill_in_middle(docs.limit(0)).count() == 0


def test_places_in_characters_and_bytes():
    text = "aé日𝒳b" * 40
    index = fim_index.Exceptions(np.frombuffer(text.encode(), dtype=np.uint8))
    assert index.chars == len(text)
    for char in range(len(text) + 1):
        byte = len(text[:char].encode())
        assert index.byte_of(char) == byte and index.char_of(byte) == char
