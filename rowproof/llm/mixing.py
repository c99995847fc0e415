"""Mixing to target weights: iterative proportional fitting, then sampling by calibrated rates.

Native: only DataFrame functions. Documents are summed to cells (one per combination of source,
language and topic); the cells' token weights are raked, one dimension after another, until a round
changes no marginal by more than `TOLERANCE` of itself. Targets that contradict each other are never met;
raking then ends after `rounds`. The factor of a cell over the largest factor of any cell with tokens is the
rate at which its documents are kept, so the expected tokens of the sample have the raked proportions.

Raking moves one short row per cell; texts are read once, for labels and token counts, which are written
so that the rows can be given the rate of their cell (rows that carry texts are read twice instead). Cells
are few (combinations of labels), yet nothing relies on that: sums are partial aggregates and the rate comes
by an equi-join that Spark broadcasts only under its own size threshold. Long texts are counted like others.

Defined cases: a null source or language is a value of its own. A null text has no tokens. A cell
without tokens changes no rate of another cell; its own is the factor of its labels, at most 1 (and 1 if no
cell has tokens). Rows that share a doc_id draw the same number. Marginal values that no target names keep
their present share.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowproof.llm.texts import table, text_or_empty
from rowproof.sources.staging import staged

DIMENSIONS = ("source", "lang", "topic")
#: Target share of a value: its share of tokens to this power, scaled to one (1 keeps, 0 levels).
TEMPER = 0.9
#: Largest relative change of a marginal in the last round, and rounds at most (for targets that contradict).
TOLERANCE = 1e-7
ROUNDS = 30

#: Topics by plain marks in the text, the first that holds; fixed patterns, same in Java and RE2.
TOPICS = (
    ("legal", "(?i)licen[cs]e|copyright|warrant"),
    ("contact", "[A-Za-z0-9._]@[A-Za-z0-9]|[0-9]{3}[-. ][0-9]{4}"),
    ("marked", "[#$%&*]{3}"),
)


def topic_of(text: Column) -> Column:
    topic = F.lit("prose")
    for name, pattern in reversed(TOPICS):
        topic = F.when(text.rlike(pattern), F.lit(name)).otherwise(topic)
    return topic


def token_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def labelled(docs: DataFrame, topic: Column | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens of every row; `carried` holds the columns to carry, if any."""
    text = text_or_empty()
    return docs.select(
        "doc_id", F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
        (topic_of(text) if topic is None else topic).alias("topic"), token_count(text).alias("n_tokens"),
        *([F.struct(*carry).alias("carried")] if carry else []),
    )


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    condition = F.lit(True)
    for a, b in zip(left, right, strict=True):
        condition &= F.col(a).eqNullSafe(F.col(b))
    return condition


def tempered_targets(cells: DataFrame, dimension: str, temper: float = TEMPER) -> DataFrame:
    """value, share: target shares from the present ones."""
    sums = cells.groupBy(F.col(dimension).alias("value")).agg(F.sum("n_tokens").cast("double").alias("w"))
    total = sums.agg(F.sum(F.pow("w", F.lit(temper)))).scalar()
    return sums.select("value", (F.pow("w", F.lit(temper)) / total).alias("share"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """The cells with `factor`: how much of each token, relative to the others, the targets want.

    `cells` has the dimensions and n_tokens; a target has value and share. Every round rakes each
    dimension once, until none of its steps is farther from 1 than `tolerance`; `rounds` and `gap` tell
    how many rounds it took and the farthest step of the last. The cells are written after each round,
    so that no plan grows with the rounds.
    """
    fitted = cells.withColumn("factor", F.lit(1.0))
    whole = cells.agg(F.sum("n_tokens").cast("double")).scalar()
    wanted = (F.col("w") > 0) & (F.col("share") > 0)
    gap, taken = 0.0, 0
    while taken < rounds:
        fitted = fitted.withColumn("gap", F.lit(0.0))
        for dimension, target in targets.items():
            sums = fitted.groupBy(F.col(dimension).alias("value2")).agg(
                F.sum(F.col("factor") * F.col("n_tokens")).alias("w")
            )
            steps = sums.join(target, F.col("value2").eqNullSafe(F.col("value")), "left").select(
                "value2", F.when(wanted, F.col("share") * whole / F.col("w")).otherwise(F.lit(1.0)).alias("step")
            )
            fitted = (
                fitted.join(steps, F.col(dimension).eqNullSafe(F.col("value2")))
                .withColumns({"factor": F.col("factor") * F.col("step"), "gap": F.greatest("gap", F.abs(F.col("step") - 1))})
                .drop("value2", "step")
            )
        written = staged(fitted)
        fitted = written.drop("gap")
        gap, taken = written.agg(F.max("gap").alias("gap")).first().gap or 0.0, taken + 1
        if gap <= tolerance:
            break
    return fitted.withColumns({"rounds": F.lit(taken), "gap": F.lit(gap)})


def draw(doc_id: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the id and the seed only."""
    key = F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def mixed(
    docs: DataFrame, temper: float = TEMPER, rounds: int = ROUNDS, seed: str = "mix-", carry: Sequence[str] = ()
) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens, rate, kept, rounds of every row, and `carried` as in `labelled`."""
    rows = labelled(docs, carry=carry)
    if not carry:
        rows = staged(rows)
    cells = staged(rows.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("n_tokens")))
    targets = {d: staged(tempered_targets(cells, d, temper)) for d in DIMENSIONS}
    fitted = rake(cells, targets, rounds)
    top = fitted.filter("n_tokens > 0").agg(F.max("factor")).scalar()
    rate = F.round(F.least(F.coalesce(F.col("factor") / top, F.lit(1.0)), F.lit(1.0)), 6)
    rates = staged(fitted.select(*(F.col(d).alias(f"{d}2") for d in DIMENSIONS), rate.alias("rate"), "rounds"))
    return rows.join(rates, _same(DIMENSIONS, [f"{d}2" for d in DIMENSIONS]), "left").select(
        "doc_id", *DIMENSIONS, "n_tokens", "rate", (draw(F.col("doc_id"), seed) < F.col("rate")).alias("kept"),
        "rounds", *(["carried"] if carry else []),
    )


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixed(table(spark, folder, "documents"))


def _oracle(temper: float = TEMPER, rounds: int = ROUNDS, tolerance: float = TOLERANCE, seed: str = "mix-") -> str:
    """The same steps written out for DuckDB; a round after one within the tolerance changes nothing."""
    topic = " ".join(f"WHEN regexp_matches(t, '{pattern}') THEN '{name}'" for name, pattern in TOPICS)
    parts = [
        "d AS (SELECT doc_id, source, lang, coalesce(text, '') AS t FROM documents)",
        f"""r AS MATERIALIZED (SELECT doc_id, source, lang, CASE {topic} ELSE 'prose' END AS topic,
          CAST(len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_tokens FROM d)""",
        """f0 AS MATERIALIZED (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS n, 1.0::DOUBLE AS factor,
          0 AS taken, 1.0::DOUBLE AS last, 0.0::DOUBLE AS gap FROM r GROUP BY ALL)""",
        "whole AS MATERIALIZED (SELECT sum(n) AS w FROM f0)",
    ]
    for x in DIMENSIONS:
        parts.append(
            f"""t_{x} AS MATERIALIZED (SELECT {x} AS v, pow(sum(n), {temper}) / sum(pow(sum(n), {temper})) OVER () AS share
              FROM f0 GROUP BY {x})"""
        )
    step = 0
    for _ in range(rounds):
        for x in DIMENSIONS:
            parts.append(
                f"""f{step + 1} AS MATERIALIZED (SELECT source, lang, topic, n, factor * step AS factor, taken, last,
                  greatest(gap, abs(step - 1)) AS gap
                  FROM (SELECT f.*, CASE WHEN f.last > {tolerance} AND s.w > 0 AND t.share > 0
                      THEN t.share * (SELECT w FROM whole) / s.w ELSE 1.0 END AS step
                    FROM f{step} f
                    JOIN (SELECT {x} AS v, sum(factor * n) AS w FROM f{step} GROUP BY {x}) s ON s.v IS NOT DISTINCT FROM f.{x}
                    LEFT JOIN t_{x} t ON t.v IS NOT DISTINCT FROM f.{x}))"""
            )
            step += 1
        parts.append(
            f"""f{step + 1} AS MATERIALIZED (SELECT source, lang, topic, n, factor, CASE WHEN last > {tolerance} THEN taken + 1 ELSE taken END AS taken,
              max(gap) OVER () AS last, 0.0::DOUBLE AS gap FROM f{step})"""
        )
        step += 1
    return "WITH " + ",\n".join(parts) + f""",
        rated AS (SELECT source, lang, topic, taken,
          round(least(coalesce(factor / (SELECT max(factor) FROM f{step} WHERE n > 0), 1.0), 1.0), 6) AS rate FROM f{step})
        SELECT r.doc_id, r.source, r.lang, r.topic, r.n_tokens, f.rate,
          CAST('0x' || substr(md5('{seed}' || coalesce(CAST(r.doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) / 4294967296.0 < f.rate AS kept,
          f.taken AS rounds
        FROM r JOIN rated f ON f.source IS NOT DISTINCT FROM r.source AND f.lang IS NOT DISTINCT FROM r.lang
          AND f.topic IS NOT DISTINCT FROM r.topic"""


ORACLE = _oracle()
