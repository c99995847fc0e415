"""N-gram Jaccard join by multiple global orders.

Two sets of n tokens or so that overlap enough share a token among the first few of each, under any order
of all tokens; a false pair that shares one under one order seldom shares one under another. A pair must
share a prefix token under every order before it is verified on the whole sets.

The first order puts rare tokens before frequent ones, by their document counts over the whole table, so
common passages stand behind what is a document's own; the others go by a hash of their own, whatever the
counts. A prefix token of one document only cannot be shared and is not sent; but it counts in the places of
the tokens behind it, and a pair is a candidate only if behind its shared token both sets are still long
enough for their union.

What keeps large groups of copies from being paired with one another: documents with equal sets are one
class with one representative, and what is asked for is which documents are connected. In the first round
every prefix token's documents are compared with one of them only, the one with the fewest tokens of its own
(in a group of edited copies, the original). In the second round, pairs of documents that share a prefix
token and are not yet connected are compared, all of them, so no link between two groups is missed. Links
inside a connected group change nothing and are not looked for.

Defined cases: a null text or one without words has an empty set and links with nothing. A row with
a null doc_id belongs to the group of an equal set, else to none. Rows sharing a doc_id are one node with the
links of all its texts, and have one component_id. Other columns are not read. Shingles are told apart by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowproof.llm.components import components
from rowproof.llm.counts import (
    BLOCK_TEXT, Block, answers, distinct, pack_sorted, read_block, stored_blocks, totals, unpack_sorted, with_answers,
)
from rowproof.llm.texts import list_column, mix, table
from rowproof.sources.staging import staged

SHINGLE = 4
#: Two sets link from this share of their union on, in hundredths.
SIMILAR = 85
ORDERS = 2


def shingles(block: Block, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Document and hash of the distinct shingles of every document, sorted by both."""
    first, words = block.first, block.words
    n = np.diff(first)
    long = np.flatnonzero(n >= size)
    count = np.zeros(len(n), np.int64)
    count[long] = n[long] - size + 1
    count[(n > 0) & (n < size)] = 1
    doc = np.repeat(np.arange(len(n)), count)
    begin = first[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    h = np.full(len(doc), np.uint64(0x2545F4914F6CDD1D)) + n.clip(max=size)[doc].astype(np.uint64)
    for k in range(size):
        there = k < n[doc]
        h[there] = mix(h[there] * np.uint64(0x9FB21C651E98DF25) + words[np.minimum(begin + k, max(len(words) - 1, 0))[there]], 31)
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return doc[new], h[new]


def _keys(size: int):
    def run(block: Block) -> list[tuple[np.ndarray, np.ndarray]]:
        _, h = shingles(block, size)
        return [distinct(h)]

    return run


def prefix_length(n: np.ndarray, similar: int = SIMILAR) -> np.ndarray:
    """So many first tokens of a set of n: a linked set shares one of them."""
    return n - -(-similar * n // 100) + 1


def _prefixes(
    doc: np.ndarray, h: np.ndarray, rank: np.ndarray, n: np.ndarray, seed: int, similar: int
) -> tuple[np.ndarray, np.ndarray]:
    """The prefix tokens under one order by document, and their places in it."""
    order = np.lexsort((h, rank, doc) if seed == 0 else (mix(h, seed), doc))
    begin = np.cumsum(n) - n
    place = np.arange(len(h)) - begin[doc[order]]
    first = place < prefix_length(n, similar)[doc[order]]
    return order[first], place[first]


def _sets(size: int, similar: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = read_block(batch, i)
                docs = len(block.first) - 1
                doc, h = shingles(block, size)
                n = np.bincount(doc, minlength=docs)
                _, at = np.unique(h, return_inverse=True)
                count = totals(batch, i, 0, 1, "full")[at]
                own = np.bincount(doc[count == 1], minlength=docs)
                # A prefix full of tokens that no other document has shares none.
                open_ = (n > 0) & (own < prefix_length(n, similar))
                mine = np.flatnonzero(open_[doc])
                lists = {}
                for seed in range(ORDERS):
                    number = np.searchsorted(np.flatnonzero(open_), doc[mine])
                    at, place = _prefixes(number, h[mine], count[mine], n[open_], seed, similar)
                    at, shared = mine[at], count[mine[at]] > 1
                    at, place = at[shared], place[shared]
                    sizes = np.bincount(doc[at], minlength=docs)
                    lists[f"t{seed}"] = list_column(pa.array(h[at].view(np.int64)), sizes)
                    if seed == 0:
                        lists["places"] = list_column(pa.array(place), sizes)
                edge = np.concatenate([[0], np.cumsum(n)])
                digest, packed = [], []
                for k in range(docs):
                    if open_[k]:
                        mine = h[edge[k] : edge[k + 1]]
                        digest.append(hashlib.blake2b(mine.tobytes(), digest_size=16).digest())
                        packed.append(pack_sorted(mine))
                    else:
                        digest.append(None)
                        packed.append(None)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": block.doc_id, "n": n, "own": own, "digest": pa.array(digest, pa.binary()),
                        **lists, "tokens": pa.array(packed, pa.binary()),
                    }
                )

    return run


def _verified(similar: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yes, held = [], (None, None)
            for a, x, y in zip(batch.column("a").to_pylist(), batch.column("tokens_a"), batch.column("tokens_b"), strict=True):
                x, y = x.as_py(), y.as_py()
                if held[0] != x:
                    held = (x, unpack_sorted(x))
                one, two = held[1], unpack_sorted(y)
                both = np.concatenate([one, two])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                yes.append(100 * common >= similar * (len(one) + len(two) - common))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(pa.array(yes, pa.bool_())), batch.column("b").filter(pa.array(yes, pa.bool_()))], ["a", "b"]
            )

    return run


def _links(pairs: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """Of the pairs (a, b) those that link: first by sizes and the other orders, then on the whole sets."""
    kind = sets.schema["doc_id"].dataType.simpleString()
    light = ["n", *(f"t{k}" for k in range(1, ORDERS))]
    side = {s: sets.select(*(F.col(c).alias(f"{c}_{s}") for c in ("doc_id", *light))) for s in "ab"}
    near = pairs.join(side["a"], F.col("a") == F.col("doc_id_a")).join(side["b"], F.col("b") == F.col("doc_id_b"))
    near = near.filter(
        (F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * similar)
    )
    for k in range(1, ORDERS):
        near = near.filter(F.arrays_overlap(f"t{k}_a", f"t{k}_b"))
    near = near.select("a", "b").distinct()
    whole = {s: sets.select(F.col("doc_id").alias(f"doc_id_{s}"), F.col("tokens").alias(f"tokens_{s}")) for s in "ab"}
    return (
        near.join(whole["b"], F.col("b") == F.col("doc_id_b")).join(whole["a"], F.col("a") == F.col("doc_id_a"))
        .select("a", "b", "tokens_a", "tokens_b").mapInArrow(_verified(similar), f"a {kind}, b {kind}")
    )


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).filter("a != b").distinct()


def joined(docs: DataFrame, similar: int = SIMILAR, size: int = SHINGLE, block_text: int = BLOCK_TEXT) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of `docs`."""
    blocks = stored_blocks(docs, most=block_text)
    answered = answers(blocks, _keys(size), 1)
    id_field = docs.schema["doc_id"].dataType.simpleString()
    orders = ", ".join(["t0 array<long>, places array<long>", *(f"t{k} array<long>" for k in range(1, ORDERS))])
    sets = staged(
        with_answers(blocks, answered).mapInArrow(
            _sets(size, similar), f"doc_id {id_field}, n long, own long, digest binary, {orders}, tokens binary"
        )
    )
    known = sets.filter("digest is not null and doc_id is not null")
    classes = known.groupBy(F.col("digest").alias("digest_")).agg(F.min("doc_id").alias("stands"))
    heads = staged(known.join(classes, (F.col("digest") == F.col("digest_")) & (F.col("doc_id") == F.col("stands"))).drop("digest_", "stands"))
    token = heads.select(F.explode(F.arrays_zip("t0", "places")).alias("t"), "doc_id", "own", "n").select(
        F.col("t.t0").alias("token"), "doc_id", "own", "n", (F.col("n") - F.col("t.places")).alias("left")
    )

    def enough(n: Column, left: Column, other_n: Column, other_left: Column) -> Column:
        """From the shared token on, both sets hold as many tokens as the overlap of linked sets needs."""
        return F.least(left, other_left) * (100 + similar) >= (n + other_n) * similar

    # First round: the documents of a prefix token against the one with the fewest tokens of its own.
    centre = token.groupBy(F.col("token").alias("token_")).agg(
        F.min(F.struct("own", "doc_id", "n", "left")).alias("centre"), F.count(F.lit(1)).alias("c")
    ).filter("c > 1")
    first = _ordered(
        token.join(
            centre,
            (F.col("token") == F.col("token_")) & (F.col("doc_id") != F.col("centre.doc_id"))
            & enough(F.col("n"), F.col("left"), F.col("centre.n"), F.col("centre.left")),
        ).select(F.col("doc_id").alias("x"), F.col("centre.doc_id").alias("y"))
    )
    links = staged(_links(first, heads, similar))

    # Second round: all documents of a prefix token that are not connected yet.
    linked = staged(components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))))
    placed = token.join(linked, F.col("doc_id") == F.col("node"), "left").select(
        "token", "doc_id", "n", "left", F.coalesce("component", "doc_id").alias("component")
    )
    open_ = placed.groupBy(F.col("token").alias("token_")).agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    ).filter("low < high")
    apart = staged(placed.join(open_, F.col("token") == F.col("token_")).drop("token_", "low", "high"))
    other = apart.select(*(F.col(c).alias(f"{c}_") for c in apart.columns))
    second = _ordered(
        apart.join(
            other,
            (F.col("token") == F.col("token_")) & (F.col("doc_id") < F.col("doc_id_"))
            & (F.col("component") != F.col("component_"))
            & enough(F.col("n"), F.col("left"), F.col("n_"), F.col("left_")),
        ).select(F.col("doc_id").alias("x"), F.col("doc_id_").alias("y"))
    )
    more = _links(second, heads, similar)
    # An id of several rows connects the classes of its texts, and its rows without class follow them.
    repeated = sets.filter("doc_id is not null").groupBy(F.col("doc_id").alias("id")).count().filter("count > 1")
    shared = staged(
        known.join(repeated, F.col("doc_id") == F.col("id")).select("id", "digest").distinct()
        .join(classes, F.col("digest") == F.col("digest_")).select("id", "stands")
    )
    least = shared.groupBy(F.col("id").alias("id_")).agg(F.min("stands").alias("low"))
    bridges = shared.join(least, F.col("id") == F.col("id_")).select(F.col("low").alias("a"), F.col("stands").alias("b"))
    linked = components(links.unionByName(more).unionByName(bridges).select(F.col("a").alias("u"), F.col("b").alias("v")))
    follow = least.join(linked, F.col("low") == F.col("node"), "left").select("id_", F.coalesce("component", "low").alias("leads"))
    # Most documents share no rare token and have no class: they would all be one null key of a join.
    alone = (
        sets.filter("digest is null").join(follow, F.col("doc_id") == F.col("id_"), "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("leads", "doc_id").alias("component_id"))
    )
    return alone.unionByName(
        sets.filter("digest is not null").select("doc_id", "n", "digest")
        .join(classes, F.col("digest") == F.col("digest_"), "left")
        .join(linked, F.col("stands") == F.col("node"), "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "stands", "doc_id").alias("component_id"))
    )


def op6_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return joined(table(spark, folder, "documents"))
