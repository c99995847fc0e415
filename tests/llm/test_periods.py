import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from rowproof.llm import periods
from rowproof.llm.periods import op11_periodic_runs, periodic_runs, runs
from tests.llm.helpers import awkward, frame

WORDS = re.compile("[^\x20\x09-\x0d]+")


def brute(words, least=6, exponent=4):
    """Every period tried at every place."""
    ids = np.unique(words, return_inverse=True)[1] if len(words) else np.zeros(0, int)
    found = {}
    for p in range(1, len(words) // exponent + 1):
        differ = np.flatnonzero(np.append(ids[p:] != ids[:-p], True))
        begin = np.append(0, differ[:-1] + 1)
        for a, b in zip(begin.tolist(), differ.tolist()):
            if b > a and b + p - a >= max(least, exponent * p):
                found.setdefault((a, b + p), p)
    return sorted((a, b - a, p) for (a, b), p in found.items())


def collapsed(words, found):
    gone = {i for a, n, p in found for i in range(a + p, a + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def periodic(r, n, letters):
    """Words in which runs of many periods follow, overlap and hold one another."""
    words = []
    while len(words) < n:
        unit = [r.choice(letters) for _ in range(r.choice([1, 2, 3, 5, 6, 7, 11, 12, 17, 23, 40, 75]))]
        if r.random() < 0.3:
            unit = unit * r.randint(2, 6) + [r.choice(letters)]
        words += unit * r.randint(1, 7) + unit[: r.randrange(len(unit))]
        if r.random() < 0.3:
            words[r.randrange(len(words))] = r.choice(letters)
    return words


@pytest.mark.parametrize("seed", range(12))
def test_runs_equal_brute_force(seed):
    r = random.Random(seed)
    docs = [periodic(r, r.randint(0, 700), "abcdefgh"[: r.randint(1, 8)]) for _ in range(8)] + [[], ["a"] * 300, ["a", "b"] * 90]
    first = np.cumsum([0] + [len(d) for d in docs])
    ids = np.array([ord(w) for d in docs for w in d])
    got = runs(ids, first)
    for k, d in enumerate(docs):
        mine = got[(got[:, 0] >= first[k]) & (got[:, 0] < first[k + 1])]
        mine = sorted((a - first[k], b - a, p) for a, b, p in mine.tolist() if b - a >= 6)
        assert mine == brute(d)


def test_misleading_hashes_change_nothing(monkeypatch):
    monkeypatch.setattr(periods, "mix", lambda x, seed=0: x & np.uint64(1))
    r = random.Random(5)
    d = periodic(r, 400, "abcd")
    ids = np.array([ord(w) for w in d])
    got = [(a, b - a, p) for a, b, p in runs(ids, np.array([0, len(d)])).tolist()]
    assert set(got) <= set(brute(d, least=0))


def test_rows(spark):
    r = random.Random(3)
    texts = awkward() + [" ".join(periodic(r, 900, ["ka", "lo", "mi"])) + "\n" for _ in range(12)] + ["so " * 6, " so so so so so", "a b " * 3000]
    rows = periodic_runs(frame(spark, texts), carry=("doc_id", "kept")).collect()
    assert len(rows) == len(texts)
    for row in rows:
        words = WORDS.findall(texts[row.carried.doc_id] or "")
        expected = brute(words)
        assert row.n_words == len(words) and row.carried.kept == "x"
        assert [tuple(x) for x in row.runs] == expected
        assert row.collapsed == " ".join(collapsed(words, expected))
    with pytest.raises(ValueError):
        periodic_runs(frame(spark, texts), exponent=3)


def planted(doc_id, words):
    h, n = zlib.crc32(("" if doc_id is None else str(doc_id)).encode()), len(words)
    g = h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]


def test_query(spark, tmp_path):
    texts = awkward(2) * 6
    docs = frame(spark, texts)
    extra = spark.createDataFrame([(None, "so it goes " * 9, "en", None, None, "x", "x", "x", "x"), (7, None, None, None, None, "x", "x", "x", "x")], docs.schema)
    docs.unionByName(extra).unionByName(extra).write.parquet(f"{tmp_path}/documents.parquet")
    rows = [(row.doc_id, row.text) for row in spark.read.parquet(f"{tmp_path}/documents.parquet").collect()]
    expected = []
    for doc_id, text in rows:
        words = planted(doc_id, WORDS.findall(text or ""))
        found = brute(words)
        best = min(found, key=lambda x: (-x[1], x[0], x[2])) if found else None
        expected.append(
            (
                doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                hashlib.sha256("".join(f"{a},{n},{p}\n" for a, n, p in found).encode()).hexdigest(),
                hashlib.sha256(" ".join(collapsed(words, found)).encode()).hexdigest(),
            )
        )
    got = op11_periodic_runs(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str)
    assert sum(x[1] for x in expected) > 10


def test_empty_table(spark, tmp_path):
    frame(spark, ["a"]).limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert op11_periodic_runs(spark, str(tmp_path)).count() == 0
