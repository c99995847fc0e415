"""Substring dedup by depth-limited radix sort: repeated windows are equal groups of sorted suffixes.

The suffixes of all texts are ordered only through the first `WINDOW` bytes, by most-significant-digit
passes: a suffix alone in its group leaves at once, a group whose next digit is the same everywhere stays
as it is, and a group with several digits is sorted and split. What is left in a group after the last pass
agrees in `WINDOW` bytes: those groups are exactly the repeated windows.

The first pass is the one that is distributed (see `repeats`): its digit is the hash of a window's
minimiser, a function of the window, so equal windows meet and most suffixes leave before any text moves.
The other passes take eight bytes each, within the bounded group of one minimiser.

Defined cases: null texts are empty; texts shorter than a window keep all; a repeated row is a copy of
itself, so all its windows are removed; matches never cross documents. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from rowproof.llm.repeats import HOT_WINDOWS, Scheme, covered, with_spans
from rowproof.llm.texts import byte_view, table

WINDOW, GRAM = 200, 32
DIGIT = 8


def digits(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number, first byte most significant; zeros after the end."""
    x = np.concatenate([data, np.zeros(DIGIT, np.uint8)]).astype(np.uint64)
    for reach in (1, 2, 4):
        x = (x[:-reach] << np.uint64(8 * reach)) | x[reach:]
    return x


def equal_windows(key: np.ndarray, pieces: list[bytes], n: np.ndarray, scheme: Scheme) -> np.ndarray:
    """For every window of every piece whether another one of its key has the same bytes."""
    data = np.frombuffer(b"".join(pieces), np.uint8)
    sizes = np.array([len(p) for p in pieces])
    number = digits(data)
    piece = np.repeat(np.arange(len(pieces)), n)
    place = np.arange(len(piece)) - np.repeat(np.cumsum(n) - n, n)
    suffix = (np.cumsum(sizes) - sizes)[piece] + place
    order = np.argsort(key[piece], kind="stable")
    group_key = key[piece][order]
    edge = np.concatenate([[True], group_key[1:] != group_key[:-1]])
    left = order  # windows still in a group, in the order of their suffixes so far
    depth = 0
    while True:
        first = np.flatnonzero(edge)
        size = np.diff(np.append(first, len(left)))
        keep = np.repeat(size > 1, size)
        left, edge = left[keep], edge[keep]
        if depth >= scheme.window or not len(left):
            break
        width = min(DIGIT, scheme.window - depth)
        digit = number[suffix[left] + depth] >> np.uint64(8 * (DIGIT - width))
        group = np.cumsum(edge) - 1
        first = np.flatnonzero(edge)
        differs = np.logical_or.reduceat(digit != digit[first][group], first)
        mixed = np.flatnonzero(differs[group])
        if len(mixed):
            turn = np.lexsort((digit[mixed], group[mixed]))
            left[mixed], digit[mixed] = left[mixed][turn], digit[mixed][turn]
            edge[1:] |= digit[1:] != digit[:-1]
        depth += width
    again = np.zeros(len(piece), bool)
    again[left] = True
    return again


def removed(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT_WINDOWS, keep_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and the kept bytes as `kept`, if asked for)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = byte_view(batch.column("text"))
            text, start, stop = covered(batch.column("spans"))
            sizes = np.diff(at)
            first = np.searchsorted(text, np.arange(len(sizes) + 1))
            view, digest, kept = memoryview(data), [], []
            for i in range(len(sizes)):
                low, parts = int(at[i]), []
                for k in range(first[i], first[i + 1]):
                    parts.append(view[low : at[i] + start[k]])
                    low = int(at[i] + stop[k])
                parts.append(view[low : at[i + 1]])
                h = hashlib.sha256()
                for part in parts:
                    h.update(part)
                digest.append(h.hexdigest())
                if keep_text:
                    kept.append(b"".join(parts))
            columns = {
                "doc_id": batch.column("doc_id"),
                "n_bytes": pa.array(sizes),
                "n_removed": pa.array(np.bincount(text, stop - start, len(sizes)).astype(np.int64)),
                "n_spans": pa.array(np.diff(first)),
                "kept_sha256": pa.array(digest, pa.string()),
            }
            yield pa.RecordBatch.from_pydict(columns | ({"kept": pa.array(kept, pa.binary())} if keep_text else {}))

    kind = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    spans = with_spans(docs, Scheme(False, window, gram), equal_windows, hot)
    return spans.mapInArrow(run, kind + ", kept binary" * keep_text)


def op4_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return removed(table(spark, folder, "documents"))
