"""Source divergence audit: how far the sources of a language are apart in their use of terms.

Every language keeps the terms of at least `DOCUMENTS` of its documents. A group (language, source) gives
each kept term a smoothed share p of a thousand million. Reported are, for every group, the distance to each
other source of its language (absolute differences summed over all kept terms), and the terms that the group
uses most above its language.

A term row is the list of a term's shares in those sources that have it, in the order of sources. With
b the share of a term that a source lacks, the distance of sources s and r is

    V |b_s - b_r|                                                 all terms as if both lacked them
    + sum over rows with s of |p_s - b_r| - |b_s - b_r|           and likewise with r
    + sum over rows with both of |p_s - p_r| - |p_s - b_r| - |b_s - p_r| + |b_s - b_r|

The last line comes from a frequent-pattern tree. Rows are inserted with their multiplicities, so rows that
begin alike share a path; a node and an ancestor give their correction once, times the node's multiplicity.
Corrections only add, so Spark may divide the rows over tasks by range: each task walks its sorted rows as
the tree they are, and a path cut at a border counts in two parts. The second line needs only how often
a source has which share: a running sum over the shares answers all other sources.

How it is laid out: texts are counted where they are read, summed per task before the shuffle by
(language, term), so neither a hot source nor a hot term gathers rows. After that only kept terms are moved.
What grows with the square of the sources of a language is the report itself. All arithmetic is on whole numbers.

Defined cases: null text, language and source count as empty; a group without terms, or a language that
keeps none, still has its rows of part `pair`; a repeated row counts again; very long texts are counted in
whole; other columns and doc_id are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowproof.llm.periods import numbered_words
from rowproof.llm.texts import LOWER, blocks, byte_view, table, text_or_empty, word_bounds
from rowproof.sources.staging import staged

#: Documents of a language that a kept term occurs in, at least.
DOCUMENTS = 30
#: Added to every count; shares are parts of `WHOLE`.
SMOOTHING, WHOLE = 5, 1_000_000_000
#: Ranks reported of part `term`.
TERMS = 50
#: Counts held by a task before they are passed on.
HELD = 1 << 20
#: Corrections added up at once.
CORRECTIONS = 1 << 21

#: ASCII letters and all bytes of longer characters make terms.
GAP = np.ones(256, bool)
GAP[128:] = False
for first, last in ("az", "AZ"):
    GAP[ord(first) : ord(last) + 1] = False

COUNTED = "lang string, source string, term string, n long, documents long"
KEYS = ["lang", "source", "term"]


def _distinct_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, number: np.ndarray) -> pa.Array:
    """The words by their numbers."""
    _, where = np.unique(number, return_index=True)
    return pa.array([data[a:b].tobytes() for a, b in zip(starts[where].tolist(), ends[where].tolist(), strict=True)], pa.binary())


def _block_counts(lang: pa.Array, source: pa.Array, data: np.ndarray, at: np.ndarray) -> pa.Table:
    """Of some documents the occurrences and documents of every term of every group."""
    data = LOWER[data]
    starts, ends, first = word_bounds(data, at, GAP)
    number = numbered_words(data, starts, ends).astype(np.int64)
    terms = _distinct_words(data, starts, ends, number).cast(pa.string())
    lang, source = lang.dictionary_encode(), source.dictionary_encode()
    group = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
    size = max(1, len(terms))
    doc = np.repeat(np.arange(len(at) - 1), np.diff(first))
    pair, n = np.unique(doc * size + number, return_counts=True)
    key, place, documents = np.unique(group[pair // size] * size + pair % size, return_inverse=True, return_counts=True)
    n = np.bincount(place, n, len(key)).astype(np.int64)
    which = key // size
    return pa.table(
        {
            "lang": lang.dictionary.take(pa.array(which // len(source.dictionary))),
            "source": source.dictionary.take(pa.array(which % len(source.dictionary))),
            "term": terms.take(pa.array(key % size)),
            "n": n,
            "documents": documents,
        }
    )


def _added(parts: list[pa.Table]) -> pa.Table:
    sums = pa.concat_tables(parts).group_by(KEYS, use_threads=False).aggregate([("n", "sum"), ("documents", "sum")])
    return sums.select([*KEYS, "n_sum", "documents_sum"]).rename_columns([*KEYS, "n", "documents"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []
    rows = 0
    for batch in batches:
        data, at = byte_view(batch.column("text"))
        for a, b in blocks(at):
            lang, source = batch.column("lang").slice(a, b - a), batch.column("source").slice(a, b - a)
            held.append(_block_counts(lang, source, data[at[a] : at[b]], at[a : b + 1] - at[a]))
            rows += held[-1].num_rows
            if rows > HELD:
                held = [_added(held)]
                rows = held[0].num_rows
                if rows > HELD // 2:
                    yield from held[0].to_batches()
                    held, rows = [], 0
    if held:
        yield from _added(held).to_batches()


def _or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("")).alias(column)


def _share(count: str, total: str, kept: str) -> Column:
    """1 + floor(WHOLE * (count + SMOOTHING) / (total + SMOOTHING * kept)), exact for counts of any size."""
    return F.expr(
        f"1 + ({WHOLE}BD * cast({count} + {SMOOTHING} as decimal(20,0))) div cast({total} + {SMOOTHING} * {kept} as decimal(25,0))"
    )


def term_rows(docs: DataFrame, documents: int = DOCUMENTS) -> DataFrame:
    """lang, term, n (in the language) and counts (source, n) of every kept term."""
    texts = docs.select(_or_empty("lang"), _or_empty("source"), text_or_empty().alias("text"))
    counted = texts.mapInArrow(_counted, COUNTED).repartition("lang", "term")
    by_source = counted.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))
    rows = by_source.groupBy("lang", "term").agg(
        F.sum("n").alias("n"), F.sum("documents").alias("documents"), F.collect_list(F.struct("source", "n")).alias("counts")
    )
    return rows.filter(F.col("documents") >= documents).drop("documents")


def groups_of(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """lang, source, total, kept (terms of the language), base (share of a term the group lacks), lang_total."""
    groups = docs.select(_or_empty("lang"), _or_empty("source")).distinct()
    totals = rows.select("lang", F.inline("counts")).groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("n").alias("lang_total"))
    found = groups.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left").fillna(0)
    base = F.when(F.col("kept") > 0, _share("0L", "total", "kept")).otherwise(0)
    return found.withColumn("base", base.cast("long"))


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Corrections of the rows' tree, from rows sorted by language and path."""
    for batch in batches:
        paths = batch.column("path")
        at = paths.offsets.to_numpy().astype(np.int64)
        entries = paths.values.slice(at[0], at[-1] - at[0])
        at = at - at[0]
        source = entries.field("source").dictionary_encode()
        who, p, base = source.indices.to_numpy().astype(np.int64), entries.field("p").to_numpy(), entries.field("base").to_numpy()
        lang = batch.column("lang").dictionary_encode()
        tongue = lang.indices.to_numpy().astype(np.int64)
        size = np.diff(at)
        row = np.repeat(np.arange(len(size)), size)
        depth = np.arange(len(who)) - at[row]
        before = np.where((row > 0) & (depth < size[row - 1]), at[row - 1] + depth, -1)
        same = (before >= 0) & (who == who[before]) & (p == p[before]) & (tongue[row] == tongue[row - 1])
        shared = np.minimum.reduceat(np.where(same, size[row], depth), at[:-1])  # nodes that a row shares with the row before
        sums = np.append(0, np.cumsum(batch.column("m").to_numpy()))
        node, times = [], []
        for d in range(1, int(size.max())):  # a node of depth 0 has no ancestors
            new = np.append(np.flatnonzero(shared <= d), len(size))
            times.append((sums[new[1:]] - sums[new[:-1]])[size[new[:-1]] > d])
            node.append((at[new[:-1]] + d)[size[new[:-1]] > d])
        if not node:
            continue
        node, times = np.concatenate(node), np.concatenate(times)
        ends = np.cumsum(depth[node])
        low = 0
        while low < len(node):
            done = ends[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(ends, done + CORRECTIONS)))
            n = depth[node[low:high]]
            r = np.repeat(node[low:high], n)
            s = np.repeat(at[row[node[low:high]]], n) + np.arange(len(r)) - np.repeat(np.cumsum(n) - n, n)
            correction = np.abs(p[s] - p[r]) - np.abs(p[s] - base[r]) - np.abs(base[s] - p[r]) + np.abs(base[s] - base[r])
            key, place = np.unique((tongue[row[r]] * len(source.dictionary) + who[s]) * len(source.dictionary) + who[r], return_inverse=True)
            order = np.argsort(place, kind="stable")
            firsts = np.searchsorted(place[order], np.arange(len(key)))
            value = np.add.reduceat((correction * np.repeat(times[low:high], n))[order], firsts)
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": lang.dictionary.take(pa.array(key // len(source.dictionary) ** 2)),
                    "source": source.dictionary.take(pa.array(key // len(source.dictionary) % len(source.dictionary))),
                    "item": source.dictionary.take(pa.array(key % len(source.dictionary))),
                    "value": value,
                }
            )
            low = high


def tree_corrections(entries: DataFrame) -> DataFrame:
    """lang, source, item, value: the third line of the module's formula, for sources in ascending order."""
    path = F.array_sort(F.collect_list(F.struct("source", "p", "base"))).alias("path")
    rows = entries.groupBy("lang", "term").agg(path).groupBy("lang", "path").agg(F.count(F.lit(1)).alias("m"))
    # By the first nodes, so that shared paths meet; the hash divides a beginning that many rows share.
    dealt = rows.repartitionByRange("lang", F.slice("path", 1, 3), F.xxhash64("path")).sortWithinPartitions("lang", "path")
    return dealt.mapInArrow(_walked, "lang string, source string, item string, value long")


def lone_corrections(entries: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value: the second line of the formula, both ways, together with the first."""
    often = entries.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("m"))
    sums = often.groupBy("lang", "source").agg(F.sum("m").alias("all_m"), F.sum(F.col("m") * F.col("p")).alias("all_mp"))
    one = groups.join(sums, ["lang", "source"], "left").fillna(0).select("lang", "source", "base", "kept", "all_m", "all_mp")
    other = groups.select("lang", F.col("source").alias("item"), F.col("base").alias("x"))
    asked = one.join(other, "lang").filter("source != item")
    none = F.lit(None)
    points = often.select(
        "lang", "source", F.col("p").alias("x"), "m", (F.col("m") * F.col("p")).alias("mp"),
        none.cast("string").alias("item"), *(none.cast("long").alias(c) for c in ("base", "kept", "all_m", "all_mp")),
    ).unionByName(asked.select("*", F.lit(0).cast("long").alias("m"), F.lit(0).cast("long").alias("mp")))
    up_to = Window.partitionBy("lang", "source").orderBy("x")
    found = points.select("*", F.sum("m").over(up_to).alias("low_m"), F.sum("mp").over(up_to).alias("low_mp")).filter("item is not null")
    apart = "abs(base - x)"
    alone = F.expr(f"x * low_m - low_mp + (all_mp - low_mp) - x * (all_m - low_m) - all_m * {apart}")
    both = found.select("lang", "source", "item", alone.alias("alone"), F.expr(f"kept * {apart}").alias("none"))
    # `none` is the same both ways and counts once in each.
    way = F.struct("source", "item", (F.col("alone") + F.col("none")).alias("value"))
    back = F.struct(F.col("item").alias("source"), F.col("source").alias("item"), F.col("alone").alias("value"))
    return both.select("lang", F.inline(F.array(way, back)))


def divergence(docs: DataFrame, documents: int = DOCUMENTS, terms: int = TERMS) -> DataFrame:
    """lang, source, part, item, value and rank: all other sources of each group, and its `terms` first terms."""
    rows = staged(term_rows(docs, documents))
    groups = staged(groups_of(docs, rows))
    by_source = rows.select("lang", "term", F.col("n").alias("lang_n"), F.inline("counts"))
    entries = by_source.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "base",
        _share("n", "total", "kept").alias("p"), _share("lang_n", "lang_total", "kept").alias("q"),
    )
    pairs = (
        lone_corrections(entries, groups).unionByName(_both_ways(tree_corrections(entries)))
        .groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    )
    above = entries.filter("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    first = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")

    def ranked(found: DataFrame, part: str) -> DataFrame:
        return found.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(first).alias("rank"))

    return ranked(pairs, "pair").unionByName(ranked(above, "term").filter(F.col("rank") <= terms))


def _both_ways(pairs: DataFrame) -> DataFrame:
    ways = F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))
    return pairs.select("lang", "value", F.inline(ways))


def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence(table(spark, folder, "documents"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
  w AS (SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
  kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY ALL HAVING count(DISTINCT id) >= 30),
  c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
  v AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
  g AS (SELECT DISTINCT lang, source FROM d),
  t AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
  full_rows AS (SELECT lang, g.source, kept.term, coalesce(c.n, 0) AS n, coalesce(t.total, 0) AS total, v.v,
      1 + (1000000000 * CAST(kept.n + 5 AS HUGEINT)) // (v.total + 5 * v.v) AS q
    FROM g JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN t USING (lang, source)
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
  s AS (SELECT *, 1 + (1000000000 * CAST(n + 5 AS HUGEINT)) // (total + 5 * v) AS p FROM full_rows),
  pairs AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM s a JOIN s b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
  every AS (SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value FROM g a JOIN g b
    ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source),
  r AS (SELECT lang, source, 'pair' AS part, item, value FROM every
    UNION ALL SELECT lang, source, 'term', term, p - q FROM s WHERE n > 0 AND p > q),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 50
"""
