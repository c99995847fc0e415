"""Language-model scoring by deleted interpolation.

A token's probability is a mixture of its bigram share, its unigram share and a uniform share. The three
weights depend on how often the context was seen, in buckets of powers of two, and are learned by
expectation-maximisation on counts that were held out (deleted) from the n-gram counts: one seventh of the
documents is scored with the counts of the others, and the weights are those that explain it best.

How it is laid out: documents are stored in blocks; keys of words and word pairs are counted over all
training documents by `counts`; every block gets the totals of its own keys. What expectation-maximisation
works on is a table of (bucket, bigram share, unigram share) with how often each occurs, the shares held to
a hundredth of a decimal logarithm, so its size is bounded; its steps are sums over that table.

Defined cases: a null text is empty and has the end token alone. Without training documents all tokens are
unknown and the uniform share of one token is left, so scores are 0. Rows sharing a doc_id are documents of
their own. Other columns are not read. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowproof.llm.counts import BLOCK_TEXT, Block, answers, distinct, read_block, stored_blocks, totals, with_answers
from rowproof.llm.texts import fold, mix, table
from rowproof.sources.staging import staged

END = np.uint64(0x5851F42D4C957F2D)
START = np.uint64(0x14057B7EF767814F)
#: Context buckets: contexts seen 0, 1, 2-3, 4-7, ... times.
BUCKETS = 40
STEPS = 15
#: Weights at first: bigram, unigram, uniform; the last never falls below LEAST.
BEGIN, LEAST = (0.4, 0.5, 0.1), 1e-6
#: Shares are held to a hundredth of a decimal logarithm; a share of zero is this number.
ZERO = 10_000
TRAIN, DELETED, HELD_OUT = 0, 1, 2


def tokens(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, token and the token before it, of all documents with their end tokens."""
    n = len(block.first) - 1
    at = block.first[1:] + np.arange(n)  # where the end tokens come
    token = np.empty(len(block.words) + n, np.uint64)
    is_end = np.zeros(len(token), bool)
    is_end[at] = True
    token[is_end], token[~is_end] = END, block.words
    before = np.concatenate([[START], token[:-1]])
    before[at[:-1] + 1] = START
    return np.repeat(np.arange(n), np.diff(block.first) + 1), token, before


def pairs_of(token: np.ndarray, before: np.ndarray) -> np.ndarray:
    return mix(mix(before, 21) * np.uint64(0x9FB21C651E98DF25) + token, 22)


def keys_of(block: Block) -> list[tuple[np.ndarray, np.ndarray]]:
    _, token, before = tokens(block)
    return [distinct(mix(token, 20)), distinct(pairs_of(token, before))]


class Counted:
    """Counts of the tokens, their contexts and their pairs in a block."""

    def __init__(self, batch: pa.RecordBatch, i: int, part: str):
        self.block = read_block(batch, i)
        self.doc, token, before = tokens(self.block)
        words, at = np.unique(mix(token, 20), return_inverse=True)
        total = totals(batch, i, 0, 2, part)
        self.token = total[at]
        # A document's start has been followed as often as there were ends.
        known = np.searchsorted(words, mix(before, 20))
        end = total[np.searchsorted(words, mix(np.array([END]), 20))]
        self.context = np.where(before == START, end, total[np.minimum(known, len(words) - 1)])
        _, at = np.unique(pairs_of(token, before), return_inverse=True)
        self.pair = totals(batch, i, 1, 2, part)[at]

    @property
    def bucket(self) -> np.ndarray:
        return np.minimum(np.frexp(self.context.astype(float))[1], BUCKETS - 1)

    def shares(self, n_tokens: int) -> tuple[np.ndarray, np.ndarray]:
        return self.pair / np.maximum(self.context, 1), self.token / max(n_tokens, 1)


def _deleted(n_tokens: int):
    """How often each (bucket, bigram share, unigram share) comes in the deleted documents."""

    def held(share: np.ndarray) -> np.ndarray:
        return np.where(share > 0, np.rint(-100 * np.log10(np.maximum(share, 1e-90))), ZERO).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                c = Counted(batch, i, "base")
                two, one = c.shares(n_tokens)
                code, count = np.unique((c.bucket * (ZERO + 1) + held(two)) * (ZERO + 1) + held(one), return_counts=True)
                yield pa.RecordBatch.from_pydict(
                    {"bucket": code // (ZERO + 1) ** 2, "two": code // (ZERO + 1) % (ZERO + 1), "one": code % (ZERO + 1), "n": count}
                )

    return run


def learned_weights(seen: DataFrame, uniform: float, steps: int = STEPS) -> np.ndarray:
    """Expectation-maximisation: bucket x (bigram, unigram, uniform) weights from (bucket, two, one, n)."""
    weights = np.tile(np.array(BEGIN), (BUCKETS, 1))
    spark = seen.sparkSession
    share = {x: F.when(F.col(x) == ZERO, 0.0).otherwise(F.pow(F.lit(10.0), F.col(x) / -100)) for x in ("two", "one")}
    table_ = staged(seen.select("bucket", share["two"].alias("s2"), share["one"].alias("s1"), "n"))
    for _ in range(steps):
        now = spark.createDataFrame([(b, *map(float, weights[b])) for b in range(BUCKETS)], "b int, l2 double, l1 double, l0 double")
        parts = table_.join(F.broadcast(now), F.col("bucket") == F.col("b")).select(
            "bucket", "n", (F.col("l2") * F.col("s2")).alias("p2"), (F.col("l1") * F.col("s1")).alias("p1"),
            (F.col("l0") * uniform).alias("p0"),
        )
        whole = F.col("p2") + F.col("p1") + F.col("p0")
        sums = parts.groupBy("bucket").agg(*(F.sum(F.col("n") * F.col(p) / whole).alias(p) for p in ("p2", "p1", "p0")))
        for row in sums.collect():  # at most one row per bucket
            got = np.maximum([row.p2, row.p1, row.p0], 0)
            got = got / got.sum()
            got[2] = max(got[2], LEAST)
            weights[row.bucket] = got / got.sum()
    return weights


def _scored(weights: np.ndarray, n_tokens: int, n_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                c = Counted(batch, i, "full")
                two, one = c.shares(n_tokens)
                w = weights[c.bucket]
                p = w[:, 0] * two + w[:, 1] * one + w[:, 2] / (n_words + 1)
                n = len(c.block.first) - 1
                base = np.log10((c.token + 1) / (n_tokens + n_words + 1))
                size = np.diff(c.block.first) + 1
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": c.block.doc_id,
                        "held_out": np.full(n, c.block.kind == HELD_OUT),
                        "n_tokens": size,
                        "n_known": np.bincount(c.doc, c.token > 0, n).astype(np.int64),
                        "train_tokens": np.full(n, n_tokens),
                        "base_score": np.bincount(c.doc, base, n),
                        "score": np.bincount(c.doc, np.log10(p), n),
                    }
                )

    return run


def scored(docs: DataFrame, kind=None, block_text: int = BLOCK_TEXT, steps: int = STEPS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    `kind` tells for each row whether it is TRAIN, DELETED (in training, weights are learned on it) or
    HELD_OUT.
    """
    remainder = fold("doc_id", 7)
    kind = F.when(remainder == 2, HELD_OUT).when(remainder == 3, DELETED).otherwise(TRAIN) if kind is None else kind
    blocks = stored_blocks(docs, kind, block_text)
    answered = answers(blocks, keys_of, 2)
    sums = answered.filter("block < 0 and key % 2 = 0").agg(
        *(F.coalesce(F.sum(F.col("sums")[i]), F.lit(0)).alias(f"s{i}") for i in range(4))
    ).first()
    n_words, n_tokens, base_words, base_tokens = (int(x) for x in sums)
    if n_tokens:
        deleted = with_answers(blocks.filter(F.col("kind") == DELETED), answered)
        seen = deleted.mapInArrow(_deleted(base_tokens), "bucket long, two long, one long, n long")
        seen = seen.groupBy("bucket", "two", "one").agg(F.sum("n").alias("n"))
        weights = learned_weights(seen, 1 / (base_words + 1), steps)
    else:
        weights = np.tile(np.array([0.0, 0.0, 1.0]), (BUCKETS, 1))
    id_kind = docs.schema["doc_id"].dataType.simpleString()
    return with_answers(blocks, answered).mapInArrow(
        _scored(weights, n_tokens, n_words),
        f"doc_id {id_kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )


def op5_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return scored(table(spark, folder, "documents"))
