"""Small tables with hard cases, and plain versions of the operators to compare with."""

from __future__ import annotations

import hashlib
import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def documents(seed: int = 3, n: int = 120) -> list[tuple]:
    """``(doc_id, text, lang, source, n_chars, component_id)``: copies, near copies, passages, odd texts, a hot source."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice(["ba", "no", "ti", "Re", "é", "ß", "x1", "日本"]) for _ in range(rng.randint(1, 4))) for _ in range(300)]

    def prose(k: int) -> str:
        return " ".join(rng.choice(vocabulary) for _ in range(k))

    passage, base = prose(60), prose(90)
    texts: list[str | None] = [None, "", " \t\n ", "one", "two words", "Two Words", "a b c d", "a b c d", "12 34 !! 56", "x" * 200, "x" * 200]
    for i in range(n):
        kind = i % 6
        if kind == 0:
            texts.append(prose(rng.randint(1, 120)))
        elif kind == 1:
            words = base.split()
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            texts.append(" ".join(words))
        elif kind == 2:
            texts.append(prose(rng.randint(0, 30)) + " " + passage + " " + prose(rng.randint(0, 80)))
        elif kind == 3:
            texts.append(texts[rng.randrange(len(texts))])
        elif kind == 4:
            texts.append("the same short line\n" + prose(12))
        else:
            texts.append(base.upper())
    texts.append(prose(9000))
    texts.append(texts[-1][:-40] + " end")
    rng.shuffle(texts)
    rows = []
    for i, text in enumerate(texts):
        lang = rng.choice(["en", "de", None]) if i % 7 else "en"
        source = "hot" if i % 3 == 0 else rng.choice(["s1", "s2", "S3", "é", None])
        rows.append((i * 3 + 1, text, lang, source, len(text or ""), i))
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, component_id int"


def shingle_set(text: str | None, width: int) -> frozenset:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def linked_components(rows: list[tuple], width: int, percent: int) -> dict:
    sets = [(i, s) for i, t in rows if i is not None and (s := shingle_set(t, width))]
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, s) in enumerate(sets):
        for j, t in sets[:k]:
            common = len(s & t)
            if 100 * common >= percent * (len(s) + len(t) - common):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: root(i) for i, _ in rows}


def removed(rows: list[tuple], length: int) -> list[tuple]:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` of each row."""
    first: dict[bytes, int] = {}
    texts = [(i, (t or "").encode()) for i, t in rows]
    for i, t in texts:
        if i is not None:
            for k in range(len(t) - length + 1):
                s = t[k : k + length]
                first[s] = min(first.get(s, i), i)
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        if i is not None:
            for k in range(len(t) - length + 1):
                if first[t[k : k + length]] < i:
                    gone[k : k + length] = b"\1" * length
        spans = len(re.findall(b"\1+", bytes(gone)))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out
