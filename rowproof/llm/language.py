"""Language identification by error-correcting output codes over byte n-grams.

Every language has a codeword. One binary classifier per bit tells from the n-grams of a text whether
the bit is one: a naive Bayes log-odds per hashed n-gram, learned from the summed n-gram counts of all
training texts (no sample). A text's margin per bit is its mean log-odds; decoding chooses the codeword
with the least loss, a logistic loss weighted by how well each bit told its training texts apart. Two
codewords with nearly the same loss flag the text as ambiguous.

How it is laid out: one scan counts n-grams (tasks add up a fixed table of buckets x languages, split
into rows so that the sums are spread), a second scan measures the bits, a third predicts. No text is
shuffled. What is collected and sent to the tasks is that table, whose size is fixed by the number of
buckets and languages.

Defined cases: a null text or one without any letter is `und` with score 0; so is every text when
nothing could be learned. Ties of languages in training go by name. Rows with a null or empty lang are
not learned from. Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowproof.llm.texts import blocks, byte_view, fold, mix, table

#: Hashed n-grams; the counts are BUCKETS x languages numbers.
BUCKETS = 1 << 16
ORDERS = (2, 3)
#: A second-best codeword within this share of the best one's loss makes a text ambiguous.
AMBIGUOUS = 0.05
UNKNOWN = "und"
PIECES = 64

#: White space, digits and signs count as one separator, letters in lower case (bytes of longer characters as they are).
FOLDED = np.arange(256, dtype=np.uint8)
FOLDED[:128] = 32
FOLDED[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
FOLDED[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)


def codewords(k: int) -> np.ndarray:
    """k x bits of 0 and 1: the exhaustive code for few languages, else a fixed random code.

    The exhaustive code of k words has 2^(k-1) - 1 bits, and any two words differ in 2^(k-2) of them.
    """
    if k <= 1:
        return np.ones((k, 1), np.int8)
    if k <= 5:
        bits = np.arange(1, 1 << (k - 1))
        rest = (bits[None, :] >> np.arange(k - 1)[:, None]) & 1
        return np.vstack([np.zeros((1, len(bits)), int), rest]).astype(np.int8)
    n = int(np.ceil(10 * np.log2(k)))
    best, far = None, -1
    rng = np.random.default_rng(7)
    for _ in range(200):
        code = rng.integers(0, 2, (k, n)).astype(np.int8)
        apart = min(int((code[i] != code[j]).sum()) for i in range(k) for j in range(i))
        if apart > far and (code.min(0) < code.max(0)).all():
            best, far = code, apart
    return best


def _grams(data: np.ndarray, at: np.ndarray, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per order: hashed n-grams of all texts one after another, and where each text's begin."""
    letters = FOLDED[data].astype(np.uint64)
    for order in ORDERS:
        if len(letters) < order:
            yield np.zeros(0, np.int64), np.zeros(len(at), np.int64)
            continue
        code = letters[: len(letters) - order + 1].copy()
        for j in range(1, order):
            code = code * np.uint64(256) + letters[j : len(letters) - order + 1 + j]
        ids = (mix(code, order) % np.uint64(buckets)).astype(np.int64)
        sizes = np.maximum(np.diff(at) - order + 1, 0)
        keep = np.ones(len(ids), bool)
        for back in range(1, order):  # n-grams that would run into the next text
            last = at[1:] - back
            keep[last[(last >= 0) & (last < len(ids))]] = False
        yield ids[keep], np.concatenate([[0], np.cumsum(sizes)])


def _letters(texts: pa.Array) -> np.ndarray:
    """Whether each text has any letter."""
    found = pc.match_substring_regex(texts, r"\p{L}")
    return found.fill_null(False).to_numpy(zero_copy_only=False)


def counts_by_language(train: DataFrame, names: list[str], buckets: int = BUCKETS) -> np.ndarray:
    """languages x buckets counts of n-grams over all training rows (text, lang)."""
    index = {name: i for i, name in enumerate(names)}
    width = -(-buckets // PIECES)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(names), width * PIECES), np.int64)
        for batch in batches:
            data, at = byte_view(batch.column("text"))
            which = np.array([index.get(x, -1) for x in batch.column("lang").to_pylist()], np.int64)
            for first, last in blocks(at):
                part, ends = data[at[first] : at[last]], at[first : last + 1] - at[first]
                for ids, begins in _grams(part, ends, buckets):
                    of = np.repeat(which[first:last], np.diff(begins))
                    for i in np.unique(which[first:last][which[first:last] >= 0]):
                        total[i, :buckets] += np.bincount(ids[of == i], minlength=buckets)
        if total.any():
            yield pa.RecordBatch.from_pydict(
                {"piece": list(range(PIECES)), "counts": [total[:, p * width : (p + 1) * width].tobytes() for p in range(PIECES)]}
            )

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        whole = sum(np.frombuffer(x, np.int64) for x in rows["counts"])
        return pd.DataFrame({"piece": rows["piece"].iloc[:1], "counts": [whole.tobytes()]})

    kind = "piece long, counts binary"
    # Two steps, so that the second one adds a bounded number of rows whatever the number of tasks.
    parts = train.select("text", "lang").mapInArrow(count, kind)
    parts = parts.groupBy("piece", (F.spark_partition_id() % 64).alias("part")).applyInPandas(
        lambda rows: add(rows[["piece", "counts"]]), kind
    )
    total = np.zeros((len(names), width * PIECES), np.int64)
    for row in parts.groupBy("piece").applyInPandas(add, kind).collect():
        total[:, row.piece * width : (row.piece + 1) * width] += np.frombuffer(row.counts, np.int64).reshape(len(names), width)
    return total[:, :buckets]


class Codes:
    """The learned tables: log-odds per n-gram and bit, codewords, and the weight of every bit."""

    def __init__(self, names: list[str], counts: np.ndarray):
        self.names, self.code = names, codewords(len(names))
        shares = (counts + 0.5) / (counts.sum(1, keepdims=True) + 0.5 * counts.shape[1])
        bits = []
        for bit in self.code.T:
            ones, zeros = shares[bit == 1], shares[bit == 0]
            one = ones.mean(0) if len(ones) else np.full(counts.shape[1], 1 / counts.shape[1])
            zero = zeros.mean(0) if len(zeros) else np.full(counts.shape[1], 1 / counts.shape[1])
            bits.append(np.clip(np.log(one) - np.log(zero), -8, 8))
        self.odds = np.array(bits, np.float32).T.copy()
        self.weight = np.full(len(bits), 1 / len(bits))

    def margins(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """texts x bits: the mean log-odds of a text's n-grams."""
        n = len(at) - 1
        out, total = np.zeros((n, self.odds.shape[1])), np.zeros(n)
        for ids, begins in _grams(data, at, len(self.odds)):
            sizes = np.diff(begins)
            some = sizes > 0
            if len(ids):
                out[some] += np.add.reduceat(self.odds[ids], begins[:-1][some], axis=0, dtype=np.float64)
            total += sizes
        return out / np.maximum(total, 1)[:, None]

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: the nearest codeword, a score in 0..1, and whether a second one is as near."""
        signs = 2.0 * self.code - 1
        loss = np.stack([(self.weight * np.log1p(np.exp(-8 * margins * s))).sum(1) for s in signs], 1)
        best = loss.argmin(1)
        low = loss[np.arange(len(loss)), best]
        odds = np.exp(-8 * (loss - low[:, None]))
        score = 1 / odds.sum(1)
        others = loss.copy()
        others[np.arange(len(loss)), best] = np.inf
        near = others.min(1, initial=np.inf) <= low * (1 + AMBIGUOUS) + 1e-12
        return best, score, near


def learn(train: DataFrame, buckets: int = BUCKETS) -> Codes | None:
    """Fit on all rows with a text and a lang; None when there is no such row."""
    train = train.filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & (F.col("lang") != ""))
    # Labels, not texts: as many as there are languages.
    names = sorted(r.lang for r in train.select("lang").distinct().collect())
    if not names:
        return None
    codes = Codes(names, counts_by_language(train, names, buckets))
    codes.weight = bit_weights(train, codes)
    return codes


def bit_weights(train: DataFrame, codes: Codes) -> np.ndarray:
    """Weights from how often each bit is right on the training rows, scaled to one."""
    index = {name: i for i, name in enumerate(codes.names)}

    def right(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits, seen = np.zeros(codes.code.shape[1], np.int64), 0
        for batch in batches:
            data, at = byte_view(batch.column("text"))
            which = np.array([index[x] for x in batch.column("lang").to_pylist()], np.int64)
            for first, last in blocks(at):
                margins = codes.margins(data[at[first] : at[last]], at[first : last + 1] - at[first])
                hits += ((margins > 0) == (codes.code[which[first:last]] == 1)).sum(0)
                seen += last - first
        if seen:
            yield pa.RecordBatch.from_pydict({"bit": list(range(len(hits))), "hits": hits, "seen": [seen] * len(hits)})

    rows = (
        train.select("text", "lang").mapInArrow(right, "bit long, hits long, seen long")
        .groupBy("bit").agg((F.sum("hits") / F.sum("seen")).alias("share")).collect()
    )
    share = np.full(codes.code.shape[1], 0.5)
    for row in rows:
        share[row.bit] = row.share
    weight = np.log((np.clip(share, 0.5001, 0.9999)) / (1 - np.clip(share, 0.5001, 0.9999)))
    return weight / weight.sum()


def predict(docs: DataFrame, codes: Codes | None, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """lang_pred, score, ambiguous beside the columns `carry` for every row of `docs`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").fill_null("")
            known = _letters(texts)
            data, at = byte_view(texts)
            n = len(texts)
            best, score, near = np.zeros(n, np.int64), np.zeros(n), np.zeros(n, bool)
            if codes is not None:
                for first, last in blocks(at):
                    margins = codes.margins(data[at[first] : at[last]], at[first : last + 1] - at[first])
                    best[first:last], score[first:last], near[first:last] = codes.decode(margins)
            else:
                known[:] = False
            names = np.array([*(codes.names if codes else []), UNKNOWN], object)
            yield pa.RecordBatch.from_pydict(
                {
                    **{name: batch.column(f"c_{name}") for name in carry},
                    "lang_pred": pa.array(names[np.where(known, best, len(names) - 1)], pa.string()),
                    "score": np.where(known, score, 0.0),
                    "ambiguous": near & known,
                }
            )

    kinds = [f"`{name}` {docs.schema[name].dataType.simpleString()}" for name in carry]
    rows = docs.select(*(docs[name].alias(f"c_{name}") for name in carry), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, ", ".join([*kinds, "lang_pred string, score double, ambiguous boolean"]))


def held_out(column: str = "doc_id") -> Column:
    return fold(column, 4) == 2


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    codes = learn(docs.filter(~held_out()))
    return predict(docs, codes).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "ambiguous")
