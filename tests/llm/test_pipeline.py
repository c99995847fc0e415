"""The stages, each held against a brute-force version on its own input."""

import duckdb
import pytest
from pyspark.sql import Row

import __spark_entry__ as contract
import corpus_pipeline as pipeline
from rowproof.llm import mixing
from tests.llm import test_exactdedup, test_jaccard, test_packing
from tests.llm.helpers import awkward, frame, sentences


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    texts = awkward() + sentences(70, 10)
    texts += [texts[0], texts[1] + " \n", texts[-1].replace("the", "The")]
    frame(spark, texts).select(*pipeline.COLUMNS).write.parquet(f"{path}/documents.parquet")
    return path


def test_every_stage_equals_brute_force(spark, folder, tmp_path):
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for k, (name, stage) in enumerate(pipeline.STAGES):
        made = stage(spark, docs, folder)
        made.write.parquet(f"{tmp_path}/{k}.parquet")
        made, before = spark.read.parquet(f"{tmp_path}/{k}.parquet"), docs.collect()
        rows = made.collect()
        if k < len(pipeline.STAGES) - 1:
            assert made.columns == list(pipeline.COLUMNS)
            assert {tuple(r) for r in rows} <= {tuple(r) for r in before}, name
            kept[name] = {r.doc_id for r in rows}
        pairs = [(r.doc_id, r.text) for r in before]
        if name == "language ID":
            letters = {i for i, t in pairs if any(c.isalpha() for c in t or "")}
            assert kept[name] <= letters and len(kept[name]) >= 0.9 * len(letters)
        elif name == "exact dedup":
            assert kept[name] == {r[0] for r in test_exactdedup.brute(pairs) if r[3]}
        elif name == "n-gram Jaccard join":
            assert kept[name] == {i for i, (_, c) in test_jaccard.brute(pairs).items() if i == c}
        elif name == "mixing to target weights":
            sql = duckdb.connect()
            sql.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/{k - 1}.parquet/*.parquet'")
            wanted = sql.sql(f"SELECT doc_id FROM ({mixing.ORACLE}) WHERE kept").fetchall()
            assert kept[name] == {r[0] for r in wanted}
        else:
            number = {i: n for n, (i, _) in enumerate(pairs)}
            order = [t for _, t in pairs]
            test_packing.check([Row(**{**r.asDict(), "doc_id": number[r.doc_id]}) for r in rows], order)
        docs = made


def test_run_is_registered_and_gives_the_last_stage(spark, folder):
    assert contract.queries()["pipeline"] is pipeline.run
    rows = pipeline.run(spark, folder)
    assert "sequence_id" in rows.columns and rows.count() > 0


def test_an_empty_table_goes_through(spark, folder, tmp_path):
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0


def test_all_numbered_queries_are_registered():
    names = contract.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
