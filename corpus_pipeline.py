"""Language ID, exact dedup, near-duplicate join, mixing and packing, one after another.

Every stage takes what its predecessor kept, is written as Parquet in the shared folder and read again.
All but the last return the columns of `documents`. A document goes when its language cannot be told
(no letters, no text, or two languages alike), when an equal text stays instead, when an earlier document
of its near-duplicate group stays instead, or when the mix does not draw it; every other one stays whole.
Decisions hold for rows, not ids: rows that share an id, or have none, come and go on their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowproof.llm import exactdedup, jaccard, language, mixing, packing
from rowproof.llm.texts import table, text_or_empty
from rowproof.sources.staging import staged

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Near copies are told by sets of so many words, from this share of their union on, in hundredths.
NEAR_WORDS = 5
NEAR_SIMILAR = 80


def _same(left: list[Column], right: list[Column]) -> Column:
    condition = F.lit(True)
    for a, b in zip(left, right, strict=True):
        condition &= a.eqNullSafe(b)
    return condition


def known_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    codes = language.learn(docs.filter(~language.held_out()))
    told = language.predict(docs, codes, carry=COLUMNS)
    return told.filter((told["lang_pred"] != language.UNKNOWN) & ~told["ambiguous"]).select(*COLUMNS)


def without_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One row stays of each group of equal texts, also where several of its rows have the id that stays."""
    decided = exactdedup.exact_duplicates(docs).filter("kept")
    chosen = staged(
        decided.groupBy(F.col("doc_id").alias("chosen_id"), F.col("text_sha256").alias("chosen_text"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    own = F.sha2(exactdedup.normalised(text_or_empty()).cast("binary"), 256)
    rows = docs.select(*COLUMNS, own.alias("own"))
    same = _same([rows["doc_id"], rows["own"]], [F.col("chosen_id"), F.col("chosen_text")])
    single = rows.join(chosen.filter("rows = 1"), same, "left_semi").select(*COLUMNS)
    # Rows that repeat an id and its text: the longest original stays, as operator 9 has it.
    repeated = staged(chosen.filter("rows > 1").select("chosen_id", "chosen_text"))
    one = F.max(F.struct(F.char_length(text_or_empty()).alias("points"), *COLUMNS)).alias("one")
    several = rows.join(repeated, same, "left_semi").groupBy("doc_id", "own").agg(one)
    return single.unionByName(several.select(*(F.col(f"one.{c}") for c in COLUMNS)))


def without_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The document of the smallest id stays of each group.

    Rows are the nodes, by a 64-bit hash of all their columns: an id may be null or repeated.
    """
    rows = docs.select(*COLUMNS, F.xxhash64(*COLUMNS).alias("row"))
    found = jaccard.joined(rows.select(F.col("row").alias("doc_id"), "text"), similar=NEAR_SIMILAR, size=NEAR_WORDS)
    found = found.select(F.col("doc_id").alias("node"), "component_id")
    ids = rows.select("doc_id", "row")
    stays = (
        found.join(ids, F.col("node") == F.col("row")).groupBy("component_id")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first"))
        .select(F.col("first.row").alias("stays"))
    )
    return rows.join(stays, F.col("row") == F.col("stays"), "left_semi").select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return mixing.mixed(docs, carry=COLUMNS).filter("kept").select("carried.*")


def packed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return packing.packed(docs)


STAGES = [
    ("language ID", known_language),
    ("exact dedup", without_copies),
    ("n-gram Jaccard join", without_near_copies),
    ("mixing to target weights", mixed),
    ("packing", packed),
]

#: Language models and token ids are not SQL: tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, folder))
    return STAGES[-1][1](spark, docs, folder)
