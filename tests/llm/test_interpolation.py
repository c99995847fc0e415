import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from rowproof.llm import counts, interpolation
from tests.llm.helpers import LOWER, awkward, frame


def tokens(text):
    return [*(text or "").encode().translate(LOWER).split(), None]


def brute(rows, kinds, steps):
    """The whole model in plain Python: shares held as in the operator, weights by the same steps."""
    docs = [tokens(t) for t in rows]

    def count(which):
        one, two = Counter(), Counter()
        for d, k in zip(docs, kinds, strict=True):
            if k in which:
                one.update(d)
                two.update(zip(["start", *d[:-1]], d, strict=True))
        return one, two

    def shares(d, one, two, n):
        for v, w in zip(["start", *d[:-1]], d, strict=True):
            context = one[None] if v == "start" else one[v]
            bucket = min(int(np.frexp(float(context))[1]), interpolation.BUCKETS - 1)
            yield bucket, two[v, w] / max(context, 1), one[w] / max(n, 1)

    one, two = count({0})
    n, uniform = sum(one.values()), 1 / (len(one) + 1)
    held = lambda p: 10 ** (-round(-100 * math.log10(p)) / 100) if p else 0.0
    seen = Counter(
        (b, held(p2), held(p1)) for d, k in zip(docs, kinds, strict=True) if k == 1 for b, p2, p1 in shares(d, one, two, n)
    )
    weights = {b: np.array(interpolation.BEGIN) for b in range(interpolation.BUCKETS)}
    for _ in range(steps):
        sums = {}
        for (b, p2, p1), c in seen.items():
            p = weights[b] * [p2, p1, uniform]
            sums[b] = sums.get(b, 0) + c * p / p.sum()
        for b, s in sums.items():
            s = s / s.sum()
            s[2] = max(s[2], interpolation.LEAST)
            weights[b] = s / s.sum()
    one, two = count({0, 1})
    n, v = sum(one.values()), len(one)
    out = []
    for d in docs:
        base = sum(math.log10((one[w] + 1) / (n + v + 1)) for w in d)
        score = sum(math.log10(weights[b] @ [p2, p1, 1 / (v + 1)]) for b, p2, p1 in shares(d, one, two, n))
        out.append((len(d), sum(one[w] > 0 for w in d), n, base, score))
    return out


def test_equals_brute_force(spark):
    texts = awkward()
    kinds = [(0, 1, 0, 2, 0)[i % 5] for i in range(len(texts))]
    kind = F.element_at(F.array(*map(F.lit, (0, 1, 0, 2, 0))), (F.col("doc_id") % 5 + 1).cast("int"))
    rows = interpolation.scored(frame(spark, texts), kind, block_text=3000, steps=4).collect()
    assert len(rows) == len(texts)
    want = brute(texts, kinds, 4)
    for r in rows:
        n_tokens, n_known, train_tokens, base, score = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n_tokens, n_known, train_tokens)
        assert r.held_out == (kinds[r.doc_id] == 2)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and math.isclose(r.score, score, rel_tol=1e-6)


def test_no_training_rows_repeats_and_empty_table(spark):
    rows = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None)], "doc_id long, text string")
    got = sorted(tuple(r)[2:] for r in interpolation.scored(rows, F.lit(2), steps=1).collect())
    assert got == [(1, 0, 0, 0.0, 0.0), (3, 0, 0, 0.0, 0.0), (3, 0, 0, 0.0, 0.0)]
    assert interpolation.scored(rows.limit(0), steps=1).count() == 0


def test_packed_numbers_come_back():
    r = np.random.default_rng(0)
    for n in (0, 1, 1000):
        keys = np.sort(r.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2))
        assert (counts.unpack_sorted(counts.pack_sorted(keys)) == keys).all()
        assert (counts.unpack_counts(counts.pack_counts(np.arange(n))) == np.arange(n)).all()


def test_model_beats_the_base_on_held_out_documents(spark):
    rows = interpolation.op5_lm_scoring(spark, "/root/testdata/sf0.01").toPandas()
    held = rows[rows.held_out]
    assert len(rows) == 1000 and held.score.sum() > held.base_score.sum()
