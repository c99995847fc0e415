"""Counting hashed keys of all documents, and giving every block of documents the totals of its keys.

Documents are stored in blocks of bounded size. A block sends each of its distinct keys once, to the
bucket that the key's high bits name, as packed sorted numbers with its own counts (so a frequent key is
as cheap as a rare one: no bucket is hot, and a key comes at most once from each block). A bucket adds up
and answers every block in the order in which it asked, so answers are plain numbers, mostly small.

A block or a bucket fits in memory by construction: there are about as many buckets as blocks. Blocks and
answers are tables in the shared folder; Spark shuffles them by bucket and by block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowproof.llm.repeats import whole_groups
from rowproof.llm.texts import LOWER, blocks, byte_view, prefix_hash, span_hash, text_or_empty, word_bounds
from rowproof.sources.staging import staged

#: Bytes of text in a block.
BLOCK_TEXT = 4 << 20


def squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def expand(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def pack_sorted(keys: np.ndarray) -> bytes:
    """Sorted 64-bit numbers as differences, equal bytes of all of them together."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return squeeze(steps.view(np.uint8).reshape(-1, 8).T.tobytes())


def unpack_sorted(data: bytes) -> np.ndarray:
    raw = np.frombuffer(expand(data), np.uint8).reshape(8, -1).T
    return np.cumsum(np.ascontiguousarray(raw).view(np.uint64).ravel(), dtype=np.uint64)


def pack_counts(counts: np.ndarray) -> bytes:
    """Unsigned 64-bit numbers, equal bytes of all of them together: the upper ones are mostly zero."""
    return squeeze(counts.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes())


def unpack_counts(data: bytes) -> np.ndarray:
    raw = np.frombuffer(expand(data), np.uint8).reshape(8, -1).T
    return np.ascontiguousarray(raw).view("<u8").ravel().astype(np.int64)


@dataclass
class Block:
    """Documents of one kind: their ids, and their lower-cased words as hashes."""

    kind: int
    doc_id: pa.Array
    words: np.ndarray
    first: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def _stored(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    held: dict[int, list] = {}

    def row(kind: int) -> pa.RecordBatch:
        nonlocal number
        ids, texts = (pa.concat_arrays(x) for x in zip(*held.pop(kind), strict=True))
        data, at = byte_view(texts)
        number += 1
        return pa.RecordBatch.from_pydict(
            {
                "block": [number - 1],
                "kind": [kind],
                "ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                "sizes": [np.diff(at)],
                "text": [zstandard.ZstdCompressor(level=3).compress(data.tobytes())],
            }
        )

    size: dict[int, int] = {}
    for batch in batches:
        kinds = batch.column("kind").to_numpy()
        _, at = byte_view(batch.column("text"))
        for kind in np.unique(kinds).tolist():
            mine = np.flatnonzero(kinds == kind)
            lengths = np.cumsum(np.diff(at)[mine])
            low = 0
            while low < len(mine):
                room = most - size.get(kind, 0) + (lengths[low - 1] if low else 0)
                high = max(low + 1, int(np.searchsorted(lengths, room, "right")))
                which = pa.array(mine[low:high])
                held.setdefault(kind, []).append((batch.column("doc_id").take(which), batch.column("text").take(which)))
                size[kind] = size.get(kind, 0) + int(lengths[high - 1] - (lengths[low - 1] if low else 0))
                if size[kind] >= most or high < len(mine):
                    yield row(kind)
                    size[kind] = 0
                low = high
    for kind in list(held):
        yield row(kind)


def stored_blocks(docs: DataFrame, kind=None, most: int = BLOCK_TEXT) -> DataFrame:
    """block, kind, ids, sizes, text: the whole table in blocks, written once. Kinds do not mix."""
    rows = docs.select("doc_id", (F.lit(0) if kind is None else kind).cast("int").alias("kind"), text_or_empty().alias("text"))
    id_kind = docs.schema["doc_id"].dataType.simpleString()
    return staged(
        rows.mapInArrow(
            lambda batches: _stored(batches, most),
            f"block long, kind long, ids array<{id_kind}>, sizes array<long>, text binary",
        )
    )


def read_block(batch: pa.RecordBatch, i: int) -> Block:
    data = np.frombuffer(expand(batch.column("text")[i].as_py()), np.uint8)
    at = np.concatenate([[0], np.cumsum(batch.column("sizes")[i].values.to_numpy())])
    words, first = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    for a, b in blocks(at):  # the numbers per byte are for a part of the block only
        part = LOWER[data[at[a] : at[b]]]
        starts, ends, begins = word_bounds(part, at[a : b + 1] - at[a])
        words.append(span_hash(prefix_hash(part), starts, ends))
        first.append(begins[1:] + first[-1][-1])
    return Block(batch.column("kind")[i].as_py(), batch.column("ids")[i].values, np.concatenate(words), np.concatenate(first))


#: From a block, per level: all its keys with how often each counts.
Keys = Callable[[Block], list[tuple[np.ndarray, np.ndarray]]]


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(keys, return_counts=True)


def _ask(keys_of: Keys, buckets: int, levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A bucket is a range of keys, so its part of the sorted keys is a slice.
        edges = np.array([(b << 64) // buckets for b in range(buckets)], np.uint64)
        for batch in batches:
            for i in range(batch.num_rows):
                block = read_block(batch, i)
                for level, (keys, counts) in enumerate(keys_of(block)):
                    at = np.append(np.searchsorted(keys, edges), len(keys))
                    some = np.flatnonzero(np.diff(at))
                    yield pa.RecordBatch.from_pydict(
                        {
                            "key": pa.array(some * levels + level),
                            "block": pa.array([batch.column("block")[i].as_py()] * len(some), pa.int64()),
                            "kind": pa.array([block.kind] * len(some), pa.int64()),
                            "keys": pa.array([pack_sorted(keys[at[b] : at[b + 1]]) for b in some], pa.binary()),
                            "counts": pa.array([pack_counts(counts[at[b] : at[b + 1]]) for b in some], pa.binary()),
                        }
                    )

    return run


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per asking block the totals over kind 0, and over kinds 0 and 1; then a row of sums per bucket."""
    for rows in whole_groups(batches, 1):
        group = rows.column("key").to_numpy()
        for low, high in zip(*(lambda e: (e[:-1], e[1:]))(np.append(np.flatnonzero(np.diff(group, prepend=group[0] - 1)), len(group))), strict=True):
            part = rows.slice(low, high - low)
            keys = [unpack_sorted(x) for x in part.column("keys").to_pylist()]
            counts = np.concatenate([unpack_counts(x) for x in part.column("counts").to_pylist()])
            sizes = np.array([len(k) for k in keys])
            kind = np.repeat(part.column("kind").to_numpy(), sizes)
            unique, place = np.unique(np.concatenate(keys), return_inverse=True)
            base = np.bincount(place, counts * (kind == 0), len(unique)).astype(np.int64)
            full = base + np.bincount(place, counts * (kind == 1), len(unique)).astype(np.int64)
            at = np.cumsum(sizes) - sizes
            for k, (block, own) in enumerate(zip(part.column("block").to_pylist(), part.column("kind").to_pylist(), strict=True)):
                mine = place[at[k] : at[k] + sizes[k]]
                yield pa.RecordBatch.from_pydict(
                    {
                        "block": [block], "key": [int(group[low])],
                        "full": [pack_counts(full[mine])],
                        "base": [pack_counts(base[mine]) if own == 1 else None],
                        "sums": pa.array([None], pa.list_(pa.int64())),
                    },
                    schema=ANSWER,
                )
            sums = [int((full > 0).sum()), int(full.sum()), int((base > 0).sum()), int(base.sum())]
            yield pa.RecordBatch.from_pydict(
                {"block": [-1], "key": [int(group[low])], "full": [None], "base": [None], "sums": [sums]}, schema=ANSWER
            )


ANSWER = pa.schema(
    [("block", pa.int64()), ("key", pa.int64()), ("full", pa.binary()), ("base", pa.binary()), ("sums", pa.list_(pa.int64()))]
)


def answers(blocks: DataFrame, keys_of: Keys, levels: int) -> DataFrame:
    """block, key (bucket and level), full, base, sums: written once."""
    buckets = max(1, blocks.count() // 2)
    asked = blocks.mapInArrow(
        _ask(keys_of, buckets, levels), "key long, block long, kind long, keys binary, counts binary"
    )
    return staged(
        asked.repartition("key").sortWithinPartitions("key")
        .mapInArrow(_answer, "block long, key long, full binary, base binary, sums array<long>")
    )


def with_answers(blocks: DataFrame, answered: DataFrame) -> DataFrame:
    """The blocks with `got`, the list of their answers."""
    got = answered.filter("block >= 0").groupBy(F.col("block").alias("block_")).agg(
        F.collect_list(F.struct("key", "full", "base")).alias("got")
    )
    return blocks.join(got, F.col("block") == F.col("block_"), "left").drop("block_")


def totals(batch: pa.RecordBatch, i: int, level: int, levels: int, part: str) -> np.ndarray:
    """The totals of a block's keys of one level, in the order of its sorted keys."""
    got = batch.column("got")[i].as_py() or []
    mine = sorted((g["key"], g[part]) for g in got if g["key"] % levels == level)
    return np.concatenate([unpack_counts(x) for _, x in mine]) if mine else np.zeros(0, np.int64)
