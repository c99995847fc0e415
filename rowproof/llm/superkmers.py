"""Substring dedup over words by super-k-mer partitioning.

Consecutive windows of words that share a minimiser travel as one packed string, a super-k-mer, to the
bucket of that minimiser (see `repeats`). There the windows of all super-k-mers are sorted and equal
neighbours counted, word by word and so exactly.

Defined cases: null texts have no words; texts with fewer words than a window keep all; a repeated row is
a copy of itself, so all its windows are removed; windows never cross documents. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from rowproof.llm.repeats import HOT_WINDOWS, Scheme, covered, with_spans
from rowproof.llm.texts import byte_view, prefix_hash, span_hash, table, word_bounds

WINDOW, GRAM = 35, 8


def word_ids(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A number per word, equal for equal words only, and where each piece's words begin."""
    data = np.frombuffer(b"".join(pieces), np.uint8)
    at = np.zeros(len(pieces) + 1, np.int64)
    np.cumsum([len(p) for p in pieces], out=at[1:])
    starts, ends, first = word_bounds(data, at)
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    letters = data[data != 32]  # pieces hold words and single blanks only
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    return words.dictionary_encode().indices.to_numpy().astype(np.int64), first


def equal_windows(key: np.ndarray, pieces: list[bytes], n: np.ndarray, scheme: Scheme) -> np.ndarray:
    """For every window of every piece whether another one of its key has the same words."""
    ids, first = word_ids(pieces)
    piece = np.repeat(np.arange(len(pieces)), n)
    begin = first[piece] + np.arange(len(piece)) - np.repeat(np.cumsum(n) - n, n)
    # Sorted by a hash of the window, then by its words where the hash alone does not tell.
    hashes = span_hash(prefix_hash(ids.astype(np.uint64)), begin, begin + scheme.window)
    order = np.lexsort((hashes, key[piece]))
    same = (hashes[order][1:] == hashes[order][:-1]) & (key[piece][order][1:] == key[piece][order][:-1])
    pairs = np.flatnonzero(same)
    equal = np.zeros(len(same), bool)
    for a in range(0, len(pairs), 1 << 16):
        part = pairs[a : a + (1 << 16)]
        i, j = begin[order[part]], begin[order[part + 1]]
        alike = np.ones(len(part), bool)
        for k in range(scheme.window):
            alike &= ids[i + k] == ids[j + k]
        equal[part] = alike
    again = np.zeros(len(piece), bool)
    again[order[:-1][equal]] = True
    again[order[1:][equal]] = True
    clash = np.flatnonzero(same & ~equal)
    if len(clash):  # different windows of one hash: sort all of that hash by their words
        rows = np.flatnonzero(np.isin(hashes, hashes[order[clash]]))
        matrix = np.column_stack([key[piece[rows]], *(ids[begin[rows] + k] for k in range(scheme.window))])
        _, which, count = np.unique(matrix, axis=0, return_inverse=True, return_counts=True)
        again[rows] = count[which.ravel()] > 1
    return again


def removed(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT_WINDOWS, keep_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and the kept words as `kept`, if asked for)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = byte_view(batch.column("text"))
            text, start, stop = covered(batch.column("spans"))
            first = np.searchsorted(text, np.arange(len(at)))
            count, digest, kept = np.zeros(len(at) - 1, np.int64), [], []
            for i in range(len(at) - 1):
                words = data[at[i] : at[i + 1]].tobytes().split()
                count[i] = len(words)
                if first[i] < first[i + 1]:
                    low, parts = 0, []
                    for k in range(first[i], first[i + 1]):
                        parts += words[low : start[k]]
                        low = stop[k]
                    words = parts + words[low:]
                joined = b" ".join(words)
                digest.append(hashlib.sha256(joined).hexdigest())
                if keep_text:
                    kept.append(joined)
            columns = {
                "doc_id": batch.column("doc_id"),
                "n_words": pa.array(count),
                "n_removed": pa.array(np.bincount(text, stop - start, len(count)).astype(np.int64)),
                "kept_sha256": pa.array(digest, pa.string()),
            }
            yield pa.RecordBatch.from_pydict(columns | ({"kept": pa.array(kept, pa.binary())} if keep_text else {}))

    kind = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, n_removed long, kept_sha256 string"
    spans = with_spans(docs, Scheme(True, window, gram), equal_windows, hot)
    return spans.mapInArrow(run, kind + ", kept binary" * keep_text)


def op10_superkmer_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return removed(table(spark, folder, "documents"))
