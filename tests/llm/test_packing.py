import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
from tokenizers import Tokenizer

from rowproof.llm import packing
from tests.llm.helpers import awkward, frame


def brute(cost, size, power_of_two=True):
    n = len(cost) - 1
    best = [0] + [10**9] * n
    for i in range(1, n + 1):
        for j in range(max(0, i - size), i):
            length = i - j
            padding = 0 if power_of_two and i == n and not length & (length - 1) else size - length
            best[i] = min(best[i], best[j] + padding + (cost[i] if i < n else 0))
    return best[n]


def price(cost, cuts, size):
    total = low = 0
    for c in cuts:
        length, last = c - low, c == len(cost) - 1
        assert 0 < length <= size
        total += (0 if last and not length & (length - 1) else size - length) + (0 if last else cost[c])
        low = c
    return total


def test_cuts_are_the_best():
    r = np.random.default_rng(1)
    for _ in range(400):
        size, n = int(r.choice([4, 8, 16])), int(r.integers(1, 80))
        cost = r.choice([0, 2, 5, 9], n + 1, p=[0.05, 0.2, 0.1, 0.65])
        got = price(cost, packing.best_cuts(cost, size, size), size)
        assert brute(cost, size) <= got <= brute(cost, size, False)


def check(rows, texts, size=1024):
    exact = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        windows[r.sequence_id].append(r)
    assert set(pieces) == set(range(len(texts)))
    for i, text in enumerate(texts):
        ids = np.array([*exact.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids)) and r.length > 0
            assert zlib.crc32(ids[at : at + r.length].tobytes()) == r.ids_crc32
            at += r.length
        assert at == len(ids)
    for rows in windows.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size


def test_every_id_is_in_one_piece(spark):
    texts = awkward()
    check(packing.packed(frame(spark, texts)).collect(), texts)
    assert packing.packed(frame(spark, texts).limit(0)).count() == 0


def test_repeated_rows_are_packed_twice(spark):
    rows = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, None)], "doc_id long, text string")
    assert packing.packed(rows).groupBy("doc_id").sum("length").collect() != []
    assert packing.packed(rows).count() == 3


def test_both_libraries_give_the_same_ids():
    encode = packing.Encoder()
    for text in pq.read_table("/root/testdata/sf0.01/documents.parquet").column("text").to_pylist():
        assert encode(text).tolist() == encode.exact.encode(text, add_special_tokens=False).ids


def test_little_padding(spark):
    rows = packing.op8_packing(spark, "/root/testdata/sf0.01").groupBy("sequence_id").sum("length").collect()
    used = sum(r[1] for r in rows)
    assert sum(1024 - r[1] for r in rows if r[1] & (r[1] - 1)) < 0.01 * used
