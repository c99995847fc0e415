import random

import numpy as np

from rowproof.llm import toxicity
from tests.llm.helpers import awkward, frame, sentences


def auc(scores, labels):
    good, bad = scores[labels == 1], scores[labels == 0]
    return (good[:, None] > bad[None, :]).mean()


def test_held_out_documents_are_told_apart(spark):
    r = random.Random(5)
    texts, labels = sentences(5, 160, 120), [int(r.random() < 0.3) for _ in range(160)]
    for i, toxic in enumerate(labels):
        if toxic:
            words = texts[i].split()
            for _ in range(4):
                words.insert(r.randrange(len(words)), r.choice(["Foulword,", "nasty", "vile!"]))
            texts[i] = " ".join(words)
    docs = frame(spark, texts)
    known = spark.createDataFrame([(i, t) for i, t in enumerate(labels) if i % 3], "doc_id long, toxic int")
    weights = toxicity.learn(docs, known)
    assert 0 < len(weights[0]) < 2000  # sparse
    scores = {x.doc_id: x.score for x in toxicity.score(docs, weights).collect()}
    held = [i for i in range(160) if i % 3 == 0]
    assert auc(np.array([scores[i] for i in held]), np.array([labels[i] for i in held])) > 0.95


def test_awkward_rows_and_no_labels(spark):
    texts = awkward()
    docs = frame(spark, texts)
    none = spark.createDataFrame([(0, None), (None, 1)], "doc_id long, toxic int")
    scores = [r.score for r in toxicity.score(docs, toxicity.learn(docs, none)).collect()]
    assert scores == [0.5] * len(texts)
    some = spark.createDataFrame([(0, 1), (0, 0), (1, 0), (8, 0), (9, 1)], "doc_id long, toxic int")
    scores = [r.score for r in toxicity.score(docs, toxicity.learn(docs, some, sample=3)).collect()]
    assert len(scores) == len(texts) and all(0 <= s <= 1 for s in scores)
    assert toxicity.score(docs.limit(0), toxicity.learn(docs.limit(0), some)).count() == 0


def test_skip_grams_span_two_words_and_stay_in_their_text():
    data = np.frombuffer(b"a b c da b", np.uint8)
    of, ids = toxicity.distinct_features(data, np.array([0, 7, 10]), 1 << 20)
    # four words, three pairs, two and one with words between; then two words and a pair
    assert np.bincount(of).tolist() == [10, 3]
    assert set(ids[of == 1]) & set(ids[of == 0])


def test_query_learns_from_the_given_tables(spark):
    rows = toxicity.op1_toxicity(spark, "/root/testdata/sf0.01").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas()
    both = rows.merge(labels, on="doc_id")
    held = both[both.held_out]
    assert len(rows) == 1000 and auc(held.score.to_numpy(), held.toxic.to_numpy()) > 0.9
    assert (rows.predicted == (rows.score >= 0.7)).all()
