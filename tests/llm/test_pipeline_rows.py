"""Decisions of the stages hold for rows: ids may be null or shared."""

import corpus_pipeline as pipeline
from rowproof.llm import mixing
from tests.llm.helpers import sentences

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(spark, made):
    return sorted(((r.doc_id, r.text) for r in made.collect()), key=str)


def test_exact_dedup_keeps_one_row_of_each_text(spark):
    a, b, c = "alpha beta", "gamma delta", "none of these"
    rows = [
        (1, a, "en", "s", 1), (1, a, "en", "s", 1), (1, "alphabeta", "en", "s", 1), (1, b, "en", "s", 1), (0, b, "en", "s", 1),
        (None, c, "en", "s", 1), (None, c, "en", "s", 1), (None, a, "en", "s", 1), (None, "unlike", "en", "s", 1),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = rows_of(spark, pipeline.without_copies(spark, docs, ""))
    assert got == sorted([(1, a), (0, b), (None, c), (None, "unlike")], key=str)
    assert pipeline.without_copies(spark, docs, "").columns == list(pipeline.COLUMNS)


def test_near_copies_with_null_or_shared_ids_go(spark):
    x, y, z = (" ".join(f"{p}{k}" for k in range(60)) for p in "xyz")
    unlike = sentences(70, 2)
    rows = [
        (7, x, "en", "s", 1), (None, x + " end", "en", "s", 1), (None, unlike[0], "en", "s", 1),
        (None, y, "en", "s", 1), (None, y + " end", "en", "s", 1),
        (5, z, "en", "s", 1), (9, z + " end", "en", "s", 1), (9, unlike[1], "en", "s", 1),
    ]
    got = rows_of(spark, pipeline.without_near_copies(spark, spark.createDataFrame(rows, SCHEMA), ""))
    ys = [r for r in got if r[1].startswith("y0 ")]
    assert len(ys) == 1 and ys[0][0] is None
    assert [r for r in got if r not in ys] == sorted([(7, x), (None, unlike[0]), (5, z), (9, unlike[1])], key=str)


def test_mix_decides_for_rows_of_a_shared_id(spark):
    rows = [(i % 7 if i % 3 else None, f"words of row {i} " * (1 + i % 4), "en", f"s{min(i % 5, 2)}", i) for i in range(80)]
    docs = spark.createDataFrame(rows, SCHEMA)
    decided = mixing.mixed(docs, carry=pipeline.COLUMNS).collect()
    assert {r.carried.n_chars: r.kept for r in decided}.keys() == set(range(80))
    got = sorted(r.n_chars for r in pipeline.mixed(spark, docs, "").collect())
    assert got == sorted(r.carried.n_chars for r in decided if r.kept) and len(got) < 80
