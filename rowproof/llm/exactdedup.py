"""Exact duplicates by a 128-bit content hash, with a byte comparison inside every group.

Native: only DataFrame functions. Two texts are equal when they are identical after deleting all
characters of a fixed set. The hash (MD5) only proposes groups; texts of one hash are compared, and a
group whose texts differ is divided by the texts themselves, so that a collision joins nothing.

How it is laid out: hashes are counted first (partial counts before the shuffle). A text is carried
once, to the count of its hash, and dropped there unless the hash occurs again. The texts of repeated
hashes are compared with one representative each; both sides of that join are rows, never lists, so
adaptive execution can divide a hot group.

Defined cases: a null text is an empty one, and all empty texts are one group. Rows that share a
doc_id share its decision, so repeated rows of the id that stays are all `kept`. A null doc_id loses
against any other. Ids may be of any type that has an order. Other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowproof.llm.texts import table, text_or_empty
from rowproof.sources.staging import staged

#: Characters that do not count when texts are compared: blank, tab, line ends, form feeds.
IGNORED = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    return F.translate(text, IGNORED, "")


def exact_duplicates(docs: DataFrame, digest=F.md5) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, one row per row of `docs`.

    The row with the most code points in its original text stays, ties to the smaller doc_id.
    `digest` makes the group hash from the normalised text.
    """
    rows = docs.select("doc_id", text_or_empty().alias("original")).select(
        "doc_id",
        F.char_length("original").cast("long").alias("points"),
        normalised(F.col("original")).alias("body"),
    )
    rows = rows.withColumns({"h": digest(F.col("body")), "text_sha256": F.sha2(F.col("body").cast("binary"), 256)})
    counted = rows.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("example"))
    again = F.col("n") > 1
    sized = staged(
        rows.join(counted.withColumnRenamed("h", "h2"), F.col("h") == F.col("h2")).select(
            "doc_id", "points", "h", "text_sha256", again.alias("again"),
            F.when(again, F.col("body")).alias("body"),
            F.when(again, F.col("doc_id").eqNullSafe(F.col("example"))).alias("stands"),
        )
    )
    single = sized.filter(~F.col("again")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256",
    )
    many = sized.filter("again")
    sample = many.filter("stands").groupBy(F.col("h").alias("h2")).agg(F.min("body").alias("sample"))
    compared = many.join(sample, F.col("h") == F.col("h2")).select(
        "doc_id", "points", "h", "text_sha256",
        F.when(F.col("body") != F.col("sample"), F.col("body")).alias("other"),
    )
    # More code points first, then the smaller id, null last: the least of each task moves, whatever type an id has.
    longest = compared.groupBy("h", "other").agg(
        F.count(F.lit(1)).alias("group_size"),
        F.min(F.struct((-F.col("points")).alias("fewer"), F.col("doc_id").isNull().alias("none"), "doc_id")).alias("best"),
    )
    classes = longest.select(
        F.col("h").alias("h2"), F.col("other").alias("other2"), "group_size", F.col("best.doc_id").alias("keep_id")
    )
    several = compared.join(
        classes, (F.col("h") == F.col("h2")) & F.col("other").eqNullSafe(F.col("other2"))
    ).select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256",
    )
    return single.unionByName(several)


def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_duplicates(table(spark, folder, "documents"))


ORACLE = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
  FROM documents
)
SELECT doc_id,
  first_value(doc_id) OVER (PARTITION BY body ORDER BY points DESC, doc_id) AS keep_id,
  count(*) OVER (PARTITION BY body) AS group_size,
  doc_id = first_value(doc_id) OVER (PARTITION BY body ORDER BY points DESC, doc_id) AS kept,
  sha256(body) AS text_sha256
FROM n
"""
