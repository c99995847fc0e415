"""Packing into token windows: order-preserving dynamic programming with monotone-queue transitions.

Documents keep their order and stand one after another, each with an end id. A window may end after a
document (free), after a sentence (a small penalty) or within one (a larger penalty); it also costs its
padding. The best cost up to a cut is the least, over the cuts that one window can reach back to, of
their cost plus position: a sliding minimum with a monotone queue, here taken for a row of cuts at once.

How it is laid out: every task packs the rows of its own input split in their order, a block at a time;
nothing is shuffled, and memory holds one block. A sequence id is made of the task's number and a counter,
so a task that runs again gives the same ids. The last window of a block is padded, unless its length is a
power of two.

Token ids are those of the `tokenizers` file. Texts of plain Latin characters are encoded with the same
vocabulary by `tiktoken`, which is about four times as fast and gives the same ids there; all other texts,
and those that name a special token, by `tokenizers` itself.

Defined cases: a null text counts as empty; an empty document is its end id alone. Repeated rows are
packed as often as they come. An empty table has no pieces. Other columns are not read.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from rowproof.llm.texts import blocks, byte_view, table, text_or_empty

SIZE = 1024
END_ID = 0
#: Documents are packed together in blocks of about so many bytes of text (a few hundred windows).
BLOCK = 1 << 19
#: A window but the last of a block is padded by so many tokens at most.
PADDING = 64
#: Costs of a cut, in tokens of padding.
SENTENCE, TRUNCATION = 2, 16
#: A cost that no packing has.
NEVER = np.int64(1) << np.int64(60)
#: Vocabulary files: the tokenizer, and the same vocabulary as ranks.
TOKENIZER, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"

PLAIN = re.compile("[\t\n\r\x20-\x7e¡-ɏ]*")
SPECIAL = "<|endoftext|>"


class Encoder:
    """Token ids of whole texts, without special tokens added."""

    def __init__(self, tokenizer: str | None = None, ranks: str | None = None):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(tokenizer or public_tokenizers.path(TOKENIZER))
        with open(ranks or public_tokenizers.path(RANKS), "rb") as lines:
            known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding(
            "plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens={}
        )
        self.ends_sentence = np.zeros(max(known.values()) + 2, bool)
        for token, i in known.items():
            self.ends_sentence[i] = token.rstrip(b"\"')")[-1:] in (b".", b"!", b"?", b"\n")

    def __call__(self, text: str) -> np.ndarray:
        if PLAIN.fullmatch(text) and SPECIAL not in text:
            return self.fast.encode_to_numpy(text)
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """The least of the last `width` values up to each place: the head of a monotone queue.

    Running minima of blocks of `width`, from the left and from the right, meet in every window.
    """
    if len(x) <= width:
        return np.minimum.accumulate(x)
    padded = np.full(-(-len(x) // width) * width, NEVER)
    padded[: len(x)] = x
    block = padded.reshape(-1, width)
    left = np.minimum.accumulate(block, axis=1).ravel()[: len(x)]
    right = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    left[width - 1 :] = np.minimum(left[width - 1 :], right[: len(x) - width + 1])
    return left


def best_cuts(cost: np.ndarray, size: int = SIZE, padding_most: int = PADDING) -> np.ndarray:
    """Where windows of at most `size` tokens end, with least padding plus cutting costs.

    `cost[i]` is the cost of ending a window after i tokens; the last end is len(cost) - 1.

    After k windows the slack is k * size minus the tokens taken: the padding so far. A window that
    ends at slack s began at a slack of s or less, by `padding_most` at most. So the best costs by
    slack after k + 1 windows are the costs of the cuts plus a sliding minimum of the row before.
    """
    total, most = len(cost) - 1, min(padding_most, size - 1)
    edge = np.full(total + 2 * size, NEVER)  # no window ends before the first token or after the last
    open_cost = np.concatenate([edge, cost[1:total], edge])
    rows = [np.zeros(1, np.int64)]
    least, windows, slack = NEVER, 0, 0  # the best ending: its cost, and the windows before the last
    while True:
        row, k = rows[-1], len(rows)
        end = k * size
        left = end - total  # the slack if the next window is the last
        if left >= 0:
            s = np.arange(min(left, len(row) - 1) + 1)
            length = total - (end - size - s)
            padding = np.where(length & (length - 1), left, s)  # a power of two is not padded
            whole = np.where((length > 0) & (length <= size), row[: len(s)] + padding, NEVER)
            i = int(whole.argmin())
            if whole[i] < least:
                least, windows, slack = int(whole[i]), k - 1, i
            if left >= len(row) - 1:
                break
        at = len(edge) - 1 + end
        ahead = open_cost[at : at - len(row) - most : -1]
        reach = sliding_minimum(np.concatenate([row, np.full(most, NEVER)]), most + 1)
        new = np.minimum(reach + ahead, NEVER)
        rows.append(new[: int(new.argmin()) + 1])  # more slack at no less cost leads nowhere better
    cuts = [total]
    for k in range(windows, 0, -1):
        cuts.append(k * size - slack)
        low = max(0, slack - most)
        slack = low + int(rows[k - 1][low : slack + 1].argmin())
    return np.array(cuts[::-1])


def cut_costs(ids: np.ndarray, doc_ends: np.ndarray, ends_sentence: np.ndarray) -> np.ndarray:
    """What it costs to end a window after 0, 1, ... tokens."""
    cost = np.full(len(ids) + 1, TRUNCATION, np.int64)
    cost[1:][ends_sentence[np.minimum(ids, len(ends_sentence) - 1)]] = SENTENCE
    cost[doc_ends] = 0
    return cost


def pieces(documents: list[np.ndarray], ends_sentence: np.ndarray, size: int = SIZE) -> dict[str, np.ndarray]:
    """The pieces of some documents (each with its end id) packed together."""
    ids = np.concatenate(documents).astype("<u4")
    sizes = np.array([len(x) for x in documents])
    doc_ends = np.cumsum(sizes)
    cuts = best_cuts(cut_costs(ids, doc_ends, ends_sentence), size)
    stops = np.union1d(cuts, doc_ends)
    starts = np.concatenate([[0], stops[:-1]])
    doc, window = np.searchsorted(doc_ends, starts, "right"), np.searchsorted(cuts, starts, "right")
    begin = np.concatenate([[0], cuts[:-1]])
    view = memoryview(ids.tobytes())
    return {
        "doc": doc,
        "start": starts - (doc_ends - sizes)[doc],
        "length": stops - starts,
        "ids_crc32": np.array([zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]),
        "doc_tokens": sizes[doc],
        "window": window,
        "offset": starts - begin[window],
    }


def packed(docs: DataFrame, size: int = SIZE, tokenizer: str | None = None, ranks: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, done = Encoder(tokenizer, ranks), 0
        first_id = TaskContext.get().partitionId() << 32
        end = np.array([END_ID], np.uint32)
        for batch in batches:
            _, at = byte_view(batch.column("text"))
            for first, last in blocks(at, BLOCK):
                texts = batch.column("text").slice(first, last - first)
                made = pieces([np.concatenate([encode(t.as_py()), end]) for t in texts], encode.ends_sentence, size)
                doc_id = batch.column("doc_id").slice(first, last - first).take(pa.array(made.pop("doc")))
                window = made.pop("window")
                made["sequence_id"] = window + (first_id + done)
                done += int(window[-1]) + 1
                order = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": doc_id, **{name: pa.array(made[name].astype(np.int64)) for name in order}}
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    longs = ", ".join(f"{n} long" for n in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"))
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, f"doc_id {kind}, {longs}")


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed(table(spark, folder, "documents"))
