"""Small tables with awkward rows, and brute-force versions."""

from __future__ import annotations

import random

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, kept string, spans string, n_words string"


def frame(spark, texts, langs=None, first=0, parts=3):
    """A documents table with columns whose names clash with results."""
    rows = [
        (first + i, t, (langs[i] if langs else "en"), f"s{i % 3}" if i % 5 else None, len(t) if t else None, "x", "x", "x", "x")
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def sentences(seed, n, words=400):
    """n texts of made-up words; no two alike by chance."""
    r = random.Random(seed)
    parts = ["ka", "lo", "mi", "ren", "sta", "vu", "zo", "the", "ing", "or", "An", "del"]
    return [
        " ".join("".join(r.choice(parts) for _ in range(r.randint(1, 4))) for _ in range(r.randint(words // 2, words))) + "."
        for _ in range(n)
    ]


def awkward(seed=1):
    """Nulls, empty and blank texts, ties, repeats, shared passages, a very long text."""
    a = sentences(seed, 8)
    r = random.Random(seed)
    near = a[0].split()
    for _ in range(6):
        near[r.randrange(len(near))] = "changed"
    passage = a[1][:700]
    return [
        *a, None, "", "  \n\t ", a[2], a[2], a[3].upper(), " ".join(near), a[4] + " " + passage, passage + " " + a[5],
        "x" * 5000, "ab" * 900, "Ünïcode ñandú çedilla — “quoted” 漢字かな交じり文 🙂 " * 40, "\x1c\x1f odd\x0b\x0cspaces\r\n\xa0here there",
        " ".join(sentences(seed + 1, 60)), "one", "one two", "one two three", "ONE two three", "a<|endoftext|>b", "12345 !!!",
    ]
