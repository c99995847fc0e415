"""The limits of the near-duplicate stage: five words and 80 hundredths, not those of operator 6."""

import random

import corpus_pipeline as pipeline
from tests.llm.helpers import LOWER, awkward, frame, sentences


def brute(rows, similar=80, size=5):
    """Ids that stay: the smallest of each group of linked sets."""
    words = [(i, (t or "").encode().translate(LOWER).split()) for i, t in rows]
    sets = [(i, {tuple(w[k : k + size]) for k in range(max(len(w) - size + 1, min(len(w), 1)))}) for i, w in words]
    group = {i: i for i, _ in rows}

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for n, (i, x) in enumerate(sets):
        for j, y in sets[:n]:
            if x and y and 100 * len(x & y) >= similar * len(x | y):
                a, b = find(i), find(j)
                group[max(a, b)] = min(a, b)
    return {i for i in group if find(i) == i}


def kept(spark, texts):
    made = pipeline.without_near_copies(spark, frame(spark, texts).select(*pipeline.COLUMNS), "")
    return {r.doc_id for r in made.collect()}


def edited(words, places, mark):
    return " ".join(f"{mark}{k}" if k in places else w for k, w in enumerate(words))


def test_copies_between_the_two_limits_go(spark):
    one, two = [f"a{k}" for k in range(200)], [f"b{k}" for k in range(200)]
    texts = [
        " ".join(one), edited(one, {30, 70, 110, 150}, "new"),  # 176 of 216 sets of five words, 181 of 213 of four
        " ".join(two), " ".join(two + [f"more{k}" for k in range(40)]),  # 196 of 236, and 197 of 237
        edited(two, {20, 60, 90, 120, 160}, "far"),  # 171 of 221: under the limit, stays
    ]
    assert kept(spark, texts) == brute(list(enumerate(texts))) == {0, 2, 4}


def test_stage_equals_brute_force_at_its_own_limits(spark):
    texts, r = awkward(), random.Random(3)
    for seed in range(2):
        family = [sentences(30 + seed, 1, 200)[0]]
        for _ in range(12):
            words = r.choice(family).split()
            for _ in range(r.choice([1, 2, 3, 4, 6])):
                words[r.randrange(len(words))] = f"new{r.randrange(10**6)}"
            family.append(" ".join(words))
        texts += family
    assert kept(spark, texts) == brute(list(enumerate(texts)))
