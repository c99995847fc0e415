import hashlib

from pyspark.sql import functions as F

from checks.compare import differences, duck
from rowproof.llm import exactdedup
from tests.llm.helpers import awkward, frame


def brute(rows):
    groups = {}
    for doc_id, text in rows:
        text = text or ""
        body = text.translate({ord(c): None for c in exactdedup.IGNORED})
        groups.setdefault(body, []).append((-len(text), doc_id))
    out = []
    for body, members in groups.items():
        keep = min(members)[1]
        digest = hashlib.sha256(body.encode()).hexdigest()
        out += [(d, keep, len(members), d == keep, digest) for _, d in members]
    return sorted(out)


def test_equals_brute_force(spark):
    texts = [*awkward(), "a b", "ab ", "a\tb", "ab", "AB"]
    got = sorted(tuple(r) for r in exactdedup.exact_duplicates(frame(spark, texts)).collect())
    assert got == brute(list(enumerate(texts)))


def test_a_collision_joins_nothing(spark):
    texts = ["one", "two", "on e", "two", "three", None, ""]
    got = exactdedup.exact_duplicates(frame(spark, texts), digest=lambda body: F.lit("same"))
    assert sorted(tuple(r) for r in got.collect()) == brute(list(enumerate(texts)))


def test_repeated_rows_null_ids_and_empty_table(spark):
    rows = spark.createDataFrame([(4, "x y"), (4, "x y"), (None, "xy"), (7, "z")], "doc_id long, text string")
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exactdedup.exact_duplicates(rows).collect()}
    assert got == {(4, 4, 3, True), (None, 4, 3, False), (7, 7, 1, True)}
    assert exactdedup.exact_duplicates(rows.limit(0)).count() == 0


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert differences(exactdedup.op9_exact_dedup(spark, folder), duck(folder), exactdedup.ORACLE) == []


def test_text_ids(spark):
    rows = spark.createDataFrame([("b", "x y"), ("a", "x\ty"), ("c", "xy"), (None, "x y"), ("d", "z")], "doc_id string, text string")
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exactdedup.exact_duplicates(rows).collect()}
    assert got == {("a", "a", 4, True), ("b", "a", 4, False), ("c", "a", 4, False), (None, "a", 4, False), ("d", "d", 1, True)}
