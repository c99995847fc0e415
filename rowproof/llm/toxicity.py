"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A document's features are the distinct hashes of its words, word pairs and pairs with one or two words
between them. FTRL-proximal keeps per coordinate the sum of gradients and of their squares: rare
features learn fast, frequent ones slowly, and the L1 term leaves most weights at exactly zero.

How it is laid out: the labelled sample is bounded by `SAMPLE` rows (those with the smallest hash of
their id), so the ids are broadcast, features are made where the texts are read, and one task passes
over the sample's features in order. The weights that are not zero, at most `WIDTH` of them, go to the
scan that scores every whole text. No text is shuffled.

Defined cases: a null text counts as empty and gets the score of the bias alone. Documents without a
label, with a null label or held out are not learned from; several labels of one document count as
toxic if any is. Without labelled rows every score is 0.5. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowproof.llm.texts import (
    LOWER, blocks, byte_view, fold, list_column, mix, prefix_hash, span_hash, table, text_or_empty, word_bounds,
)

#: Labelled documents learned from, at most.
SAMPLE = 20_000
#: Hashed features, a power of two.
WIDTH = 1 << 20
EPOCHS, ALPHA, BETA, L1, L2 = 3, 2.0, 1.0, 4.0, 0.0
THRESHOLD = 0.7

#: Letters, digits and all bytes of longer characters make words.
GAP = np.ones(256, bool)
GAP[128:] = False
for first, last in ("az", "AZ", "09"):
    GAP[ord(first) : ord(last) + 1] = False


def features(data: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Text and hashed feature of every occurrence."""
    data = LOWER[data]
    starts, ends, first = word_bounds(data, at, GAP)
    words = span_hash(prefix_hash(data), starts, ends)
    text = np.repeat(np.arange(len(at) - 1), np.diff(first))
    of, ids = [text], [words]
    for apart in (1, 2, 3):
        same = text[apart:] == text[:-apart]
        of.append(text[apart:][same])
        ids.append(mix(words[:-apart][same] * np.uint64(0x9FB21C651E98DF25) + words[apart:][same], apart))
    return np.concatenate(of), (np.concatenate(ids) & np.uint64(width - 1)).astype(np.int64)


def distinct_features(data: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    of, ids = features(data, at, width)
    both = np.unique(of * width + ids)
    return both // width, both % width


def _featured(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = byte_view(batch.column("text"))
            for first, last in blocks(at):
                of, ids = distinct_features(data[at[first] : at[last]], at[first : last + 1] - at[first], width)
                sizes = np.bincount(of, minlength=last - first)
                yield pa.RecordBatch.from_pydict(
                    {
                        "rank": batch.column("rank").slice(first, last - first),
                        "toxic": batch.column("toxic").slice(first, last - first),
                        "ids": list_column(pa.array(ids.astype(np.int32)), sizes),
                    }
                )

    return run


def _ftrl(width: int, epochs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [
            (batch.column("ids")[i].values.to_numpy(), float(batch.column("toxic")[i].as_py()))
            for batch in batches
            for i in range(batch.num_rows)
        ]
        z, n = np.zeros(width + 1), np.zeros(width + 1)

        def weights(zi: np.ndarray, ni: np.ndarray) -> np.ndarray:
            return np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2))

        for _ in range(epochs):
            for ids, label in rows:
                ids = np.append(ids, width)  # the bias
                zi, ni = z[ids], n[ids]
                w = weights(zi, ni)
                g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
                z[ids] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * w
                n[ids] = ni + g * g
        w = weights(z, n)
        some = np.flatnonzero(w)
        yield pa.RecordBatch.from_pydict({"feature": pa.array(some), "weight": pa.array(w[some])})

    return run


def learn(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, width: int = WIDTH, epochs: int = EPOCHS
) -> tuple[np.ndarray, np.ndarray]:
    """Features with a weight other than zero, and the weights; `width` stands for the bias.

    `labels` has doc_id and toxic; at most `sample` labelled rows of `docs` are learned from.
    """
    chosen = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias("label_id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .withColumn("rank", F.xxhash64("label_id"))
        .orderBy("rank", "label_id")
        .limit(sample)
    )
    rows = docs.select("doc_id", text_or_empty().alias("text")).join(
        F.broadcast(chosen), F.col("doc_id") == F.col("label_id")
    )
    made = rows.select("rank", "toxic", "text").mapInArrow(_featured(width), "rank long, toxic int, ids array<int>")
    weights = made.repartition(1).sortWithinPartitions("rank", "toxic").mapInArrow(
        _ftrl(width, epochs), "feature long, weight double"
    ).toArrow()
    return weights.column("feature").to_numpy(), weights.column("weight").to_numpy()


def score(docs: DataFrame, weights: tuple[np.ndarray, np.ndarray], width: int = WIDTH) -> DataFrame:
    """doc_id and score of every row of `docs`."""
    feature, weight = weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = np.zeros(width + 1)
        dense[feature] = weight
        for batch in batches:
            data, at = byte_view(batch.column("text"))
            total = np.full(batch.num_rows, dense[width])
            for first, last in blocks(at):
                of, ids = features(data[at[first] : at[last]], at[first : last + 1] - at[first], width)
                heavy = np.flatnonzero(dense[ids])
                both = np.unique(of[heavy] * width + ids[heavy])
                total[first:last] += np.bincount(both // width, dense[both % width], last - first)
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "score": 1 / (1 + np.exp(-np.clip(total, -35, 35)))}
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, f"doc_id {kind}, score double")


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, held_out = table(spark, folder, "documents"), fold("doc_id", 3) == 1
    weights = learn(docs, table(spark, folder, "labels").filter(~held_out))
    return score(docs, weights).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
