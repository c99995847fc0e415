import random

import numpy as np

from rowproof.llm import jaccard
from tests.llm.helpers import LOWER, awkward, frame, sentences


def shingles(text):
    w = (text or "").encode().translate(LOWER).split()
    return frozenset(tuple(w[k : k + 4]) for k in range(len(w) - 3)) if len(w) > 3 else frozenset([tuple(w)] if w else [])


def brute(rows, similar=85):
    group = {i: i for i, _ in rows}

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    sets = [(i, shingles(t)) for i, t in rows]
    for n, (i, x) in enumerate(sets):
        for j, y in sets[:n]:
            if x and y and 100 * len(x & y) >= similar * len(x | y):
                a, b = find(i), find(j)
                group[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets}


def test_equals_brute_force(spark):
    texts = awkward()
    r = random.Random(9)
    for seed in range(3):  # families of edits of edits, near the threshold
        family = [sentences(20 + seed, 1, 200)[0]]
        for _ in range(14):
            words = r.choice(family).split()
            for _ in range(r.choice([1, 2, 3, 4, 6])):
                words[r.randrange(len(words))] = f"new{r.randrange(10**6)}"
            family.append(" ".join(words))
        texts += family
    shared = sentences(50, 1, 160)[0]  # a passage that many texts share
    texts += [shared + " " + t for t in sentences(51, 12, 120)]
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard.joined(frame(spark, texts), block_text=4000).collect()}
    assert got == brute(list(enumerate(texts)))


def test_repeated_rows_null_ids_and_empty_table(spark):
    text = sentences(60, 1)[0]
    rows = spark.createDataFrame([(5, text), (5, text), (3, text.upper()), (None, text), (None, text[:90]), (9, "a b c d e")], "doc_id long, text string")
    got = sorted(((x.doc_id, x.component_id) for x in jaccard.joined(rows).collect()), key=str)
    assert got == sorted([(5, 3), (5, 3), (3, 3), (None, 3), (None, None), (9, 9)], key=str)
    assert jaccard.joined(rows.limit(0)).count() == 0


def test_rows_that_share_an_id_are_one_node(spark):
    x, u, v = sentences(70, 3)
    rows = [(3, x), (5, x), (5, u), (5, v), (8, v), (9, "a b"), (9, u), (7, "a b c"), (7, None)]
    r = random.Random(3)
    for seed in range(6):  # edits of one text under ids that other families use too
        text = sentences(80 + seed, 1, 120)[0]
        for _ in range(8):
            words = text.split()
            words[r.randrange(len(words))] = f"new{r.randrange(10**6)}"
            rows.append((r.randrange(20, 60), " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = {i: component for i, (_, component) in brute(rows).items()}
    got = jaccard.joined(docs, block_text=2000).collect()
    assert len(got) == len(rows)
    assert {(x.doc_id, x.component_id) for x in got} == set(want.items())
    assert want[8] == want[9] == 3


def test_the_second_order_does_not_follow_the_counts():
    n = np.array([50, 50])
    h = np.concatenate([np.arange(50), np.arange(50)]).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h[58:] += np.uint64(1)  # the documents share the eight rarest tokens and no other
    doc, rank = np.repeat([0, 1], 50), np.tile(np.arange(2, 52), 2)
    both = []
    for seed in range(2):
        at, place = jaccard._prefixes(doc, h, rank, n, seed, 85)
        assert np.bincount(doc[at]).tolist() == [8, 8] == jaccard.prefix_length(n).tolist()
        assert place.tolist() == [*range(8)] * 2
        both.append([set(h[at[doc[at] == d]].tolist()) for d in range(2)])
    assert both[0][0] == both[0][1] and len(both[1][0] & both[1][1]) < 4
