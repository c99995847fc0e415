"""Repeated windows of bytes and words against brute force."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowproof.llm import repeats, suffixes, superkmers
from tests.llm.helpers import awkward, frame

SCHEMES = [(suffixes, False, 60, 16), (superkmers, True, 7, 3)]


def brute(texts, words, window):
    items = [(t or "").encode().split() if words else (t or "").encode() for t in texts]
    seen = Counter(tuple(x[i : i + window]) for x in items for i in range(len(x) - window + 1))
    out = []
    for x in items:
        covered = bytearray(len(x))
        for i in range(len(x) - window + 1):
            if seen[tuple(x[i : i + window])] > 1:
                covered[i : i + window] = b"\x01" * window
        left = [v for v, c in zip(x, covered, strict=True) if not c]
        kept = b" ".join(left) if words else bytes(left)
        row = (len(x), sum(covered), *(() if words else (len(re.findall(rb"\x01+", bytes(covered))),)))
        out.append((*row, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("module, words, window, gram", SCHEMES)
@pytest.mark.parametrize("hot", [repeats.HOT_WINDOWS, 1])
def test_equals_brute_force(spark, module, words, window, gram, hot):
    texts = awkward()
    got = {r[0]: tuple(r[1:]) for r in module.removed(frame(spark, texts), window, gram, hot).collect()}
    assert got == dict(enumerate(brute(texts, words, window)))


@pytest.mark.parametrize("module, words, window, gram", SCHEMES)
def test_repeated_rows_null_ids_and_empty_table(spark, module, words, window, gram):
    text = awkward()[0]
    rows = spark.createDataFrame([(1, text), (1, text), (1, "other " * 20), (None, text[:300])], "doc_id long, text string")
    got = sorted((tuple(r) for r in module.removed(rows, window, gram).collect()), key=str)
    want = brute([text, text, "other " * 20, text[:300]], words, window)
    assert got == sorted([(1, *want[0]), (1, *want[1]), (1, *want[2]), (None, *want[3])], key=str)
    assert module.removed(rows.limit(0), window, gram).count() == 0


@pytest.mark.parametrize("module, words, window, gram", SCHEMES)
def test_long_texts_are_marked_in_stretches(monkeypatch, module, words, window, gram):
    scheme = repeats.Scheme(words, window, gram)
    r = np.random.default_rng(3)
    values = r.integers(0, 50, 4000).astype(np.uint64)
    whole = repeats.runs(values, np.array([0, 4000]), scheme)
    monkeypatch.setattr(repeats, "LONGEST", 500)
    symbols = repeats.Symbols(values, values, values, np.array([0, 4000]))
    covered = np.zeros(4000, int)
    for _, _, low, first in repeats._stretches(symbols, window):
        _, start, count, _ = repeats.runs(values[low : first[-1]], first - low, scheme)
        for a, n in zip(start + low, count, strict=True):
            covered[a : a + n] += 1
    assert covered[: 4000 - window + 1].tolist() == [1] * (4000 - window + 1)
    assert whole[2].sum() == 4000 - window + 1


@pytest.mark.parametrize("module, words, window, gram", SCHEMES)
def test_more_hot_minimisers_than_a_task_may_hold_are_joined(spark, module, words, window, gram):
    texts = awkward()
    scheme = repeats.Scheme(words, window, gram)
    for most_hot in (repeats.MOST_HOT, 3):
        found = repeats.with_spans(frame(spark, texts), scheme, module.equal_windows, 1, most_hot)
        for doc_id, _, spans in found.collect():
            symbols = (texts[doc_id] or "").encode().split() if words else (texts[doc_id] or "").encode()
            marked = bytearray(len(symbols))
            for a, b in spans or []:
                marked[a:b] = b"\x01" * (b - a)
            assert sum(marked) == brute(texts, words, window)[doc_id][1]


def test_rows_without_id_whose_texts_share_a_short_hash(spark):
    passage = "one passage that the rows of this test have in common, long enough to be a window of either kind "
    long = passage + "and much more of it than that, in the second text only " * 3
    texts = spark.range(150_000).select(F.when(F.col("id") % 2 == 0, passage).otherwise(long).alias("p"), "id").select(
        F.concat("p", F.col("id").cast("string")).alias("text")
    )
    clash = texts.groupBy(F.hash("text").alias("h")).agg(F.collect_list("text").alias("same")).filter("size(same) > 1").first().same
    rows = [(None, x) for x in clash] + [(7, x) for x in clash]
    for module, words, window, gram in SCHEMES:
        for hot in (repeats.HOT_WINDOWS, 1):
            got = module.removed(spark.createDataFrame(rows, "doc_id long, text string"), window, gram, hot).collect()
            want = brute([x for _, x in rows], words, window)
            assert sorted(map(tuple, got), key=str) == sorted([(r[0], *w) for r, w in zip(rows, want, strict=True)], key=str)


def test_windows_of_one_hash_are_told_apart_by_their_words(monkeypatch):
    monkeypatch.setattr(superkmers, "span_hash", lambda h, a, b: np.zeros(len(a), np.uint64))
    pieces = [b"a b c d", b"a b c e", b"q a b c"]
    again = superkmers.equal_windows(np.zeros(3, np.int64), pieces, np.array([2, 2, 2]), repeats.Scheme(True, 3, 1))
    assert again.tolist() == [True, False, True, False, False, True]
