from pyspark.sql import functions as F

from checks.compare import differences, duck
from rowproof.llm import mixing
from tests.llm.helpers import awkward, frame


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert differences(mixing.op7_mixing(spark, folder), duck(folder), mixing.ORACLE) == []


def test_raked_marginals_meet_their_targets(spark):
    rows = [("a", "x", "p", 50), ("a", "y", "q", 20), ("b", "x", "q", 10), ("b", "y", "p", 15), (None, "x", "p", 5)]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, n_tokens long")
    want = {"source": {"a": 0.3, "b": 0.6, None: 0.1}, "lang": {"x": 0.5, "y": 0.5}, "topic": {"p": 0.4, "q": 0.6}}
    targets = {d: spark.createDataFrame(list(t.items()), "value string, share double") for d, t in want.items()}
    fitted = mixing.rake(cells, targets, 20).withColumn("w", F.col("factor") * F.col("n_tokens")).collect()
    whole = sum(r.w for r in fitted)
    for d, shares in want.items():
        for value, share in shares.items():
            assert abs(sum(r.w for r in fitted if r[d] == value) / whole - share) < 1e-3


def test_awkward_rows(spark):
    texts = awkward()
    rows = mixing.mixed(frame(spark, texts), rounds=2).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    assert all(0 < r.rate <= 1 and r.kept is not None for r in rows)
    assert mixing.mixed(frame(spark, texts).limit(0), rounds=1).count() == 0
    again = {r.doc_id: r.kept for r in mixing.mixed(frame(spark, texts, parts=7), rounds=2).collect()}
    assert again == {r.doc_id: r.kept for r in rows}
    repeated = spark.createDataFrame([(1, "a b", "en", "s"), (1, "a b", "en", "s"), (None, None, None, None)], "doc_id long, text string, lang string, source string")
    assert mixing.mixed(repeated, rounds=1).count() == 3


def test_an_empty_text_with_labels_of_its_own_changes_no_other_rate(spark):
    schema = "doc_id long, text string, lang string, source string"
    rows = [(i, "some words here " * (1 + i % 7), "en" if i % 3 else "de", f"s{i % 4}") for i in range(120)]
    for empty in ("", None, " \n"):
        more = [*rows, (999, empty, "en", "alone")]
        before = {r.doc_id: (r.rate, r.kept) for r in mixing.mixed(spark.createDataFrame(rows, schema)).collect()}
        after = {r.doc_id: (r.rate, r.kept) for r in mixing.mixed(spark.createDataFrame(more, schema)).collect()}
        assert 0 < after.pop(999)[0] <= 1
        assert after == before
        assert max(rate for rate, _ in after.values()) == 1


def test_raking_stops_at_its_tolerance_and_says_so(spark):
    rows = [("a", "x", "p", 50), ("a", "y", "q", 20), ("b", "x", "q", 10), ("b", "y", "p", 15)]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, n_tokens long")
    want = {"source": {"a": 0.3, "b": 0.7}, "lang": {"x": 0.5, "y": 0.5}}
    targets = {d: spark.createDataFrame(list(t.items()), "value string, share double") for d, t in want.items()}
    fitted = mixing.rake(cells, targets, 40, 1e-9).collect()
    assert 1 < fitted[0].rounds < 40 and fitted[0].gap <= 1e-9
    short = mixing.rake(cells, targets, 2, 1e-9).first()
    assert short.rounds == 2 and short.gap > 1e-9
