"""Document fingerprints from Lempel-Ziv phrases.

A text is parsed into phrases, byte by byte: each phrase is the shortest piece from the present place on that
is not in the text's dictionary yet, which then enters it (LZ78). Texts that compress well together have many
phrases in common. The fingerprint is a minimum-hash signature of the phrase set: its `SIGNATURE` least
32-bit hashes, or all of them if the set is smaller. The likeness of two fingerprints estimates the Jaccard
similarity of the sets: of the least hashes of both together, the share that both have.

A dictionary starts anew after `DICTIONARY` phrases, so a text of any length is parsed in bounded memory;
the signature is of all its phrases.

`edited` sets every document beside its next one (in ascending order of id, after the last the first), whose
beginning replaces its last quarter. Documents come together with their next ones through one shuffle of the texts:

1. ids and text hashes alone are divided into ranges, and the least of each range is fetched (one pair of numbers
   for each `RANGE_BYTES` of text);
2. every row goes to the part that its pair falls in, and the first row of a part to the part before as well;
3. a part is read in order, two documents at a time, so a long part costs time, not memory.

Defined cases: null counts as empty; an empty text has the empty fingerprint, which is like itself (1) and
unlike any other (0); null ids come first; rows that share an id come by the hash of their text; repeated rows are
documents of their own, each the next of the one before; a single row is its own next one; other columns are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowproof.llm.texts import table, text_or_empty

#: Least hashes in a fingerprint.
SIGNATURE = 128
#: Phrases after which a dictionary starts anew.
DICTIONARY = 1 << 20
#: Bytes of text in a part.
RANGE_BYTES = 16 << 20
#: The part of a text that is replaced.
REPLACED = 4


def parse(data: bytes, start: int = 0, seen: set[bytes] | None = None, most: int = DICTIONARY) -> list[int]:
    """Where the phrases from `start` on end; what is left at the end of the text is in the dictionary already.

    All beginnings of a phrase are in the dictionary, so its length is searched from the last one's on.
    """
    seen = set() if seen is None else seen
    ends, n, size = [], len(data), 1
    while start + 1 <= n:
        piece = data[start : start + size]
        if piece in seen:
            while piece in seen:
                if start + size >= n:
                    return ends
                size += 1
                piece = data[start : start + size]
        else:
            shorter = piece[:-1]
            while shorter and shorter not in seen:
                piece, shorter = shorter, shorter[:-1]
        seen.add(piece)
        if len(seen) >= most:
            seen.clear()
        start += len(piece)
        size = len(piece)
        ends.append(start)
    return ends


def phrases(data: bytes, ends: list[int]) -> list[bytes]:
    return [data[a:b] for a, b in zip([0, *ends], ends)]


def signature(found: list[bytes], size: int = SIGNATURE) -> np.ndarray:
    """The least hashes of the phrase set in ascending order."""
    hashes = np.unique(np.fromiter(map(xxhash.xxh32_intdigest, found), np.uint32, len(found)))
    return hashes[:size]


def written(least: np.ndarray) -> str:
    return least.astype(">u4").tobytes().hex()


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u4").astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray, size: int = SIGNATURE) -> float:
    """Estimated Jaccard similarity of two phrase sets, 0 to 1."""
    both = np.union1d(a, b)[:size]
    if not len(both):
        return 1.0
    return float(np.isin(both, a, assume_unique=True) @ np.isin(both, b, assume_unique=True).astype(np.int64) / len(both))


class _Document:
    """A text with its phrases and its fingerprint."""

    def __init__(self, doc_id, data: bytes, size: int, most: int) -> None:
        self.doc_id, self.data, self.size, self.most = doc_id, data, size, most
        self.points = len(data.decode())
        self.ends = parse(data, most=most)
        self.phrases = phrases(data, self.ends)
        self.least = signature(self.phrases, size)

    def edited(self, after: _Document) -> tuple[str, np.ndarray]:
        """Digest and fingerprint of the text whose end is replaced; phrases before it are parsed once."""
        n = self.points // REPLACED
        if not n:
            return hashlib.sha256(self.data).hexdigest(), self.least
        text = self.data.decode()
        cut = len(text[: self.points - n].encode())
        data = self.data[:cut] + after.data.decode()[:n].encode()
        same = bisect_right(self.ends, cut)
        # The dictionary as it was after those phrases.
        known = set(self.phrases[same - same % self.most : same])
        start = self.ends[same - 1] if same else 0
        more = parse(data, start, known, self.most)
        found = self.phrases[:same] + [data[a:b] for a, b in zip([start, *more], more)]
        return hashlib.sha256(data).hexdigest(), signature(found, self.size)

    def row(self, after: _Document) -> dict:
        digest, changed = self.edited(after)
        return {
            "doc_id": self.doc_id,
            "n_chars": self.points,
            "edited_sha256": digest,
            "fingerprint": written(self.least),
            "edited_fingerprint": written(changed),
            "near_edited": likeness(self.least, changed, self.size),
            "near_next": likeness(self.least, after.least, self.size),
        }


def fingerprints(docs: DataFrame, size: int = SIGNATURE, dictionary: int = DICTIONARY) -> DataFrame:
    """doc_id, fingerprint and n_phrases of every row; nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                found = [phrases(data, parse(data, most=dictionary)) for data in (x.as_py() for x in part.column("data"))]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part.column("doc_id"),
                        "fingerprint": pa.array([written(signature(f, size)) for f in found], pa.string()),
                        "n_phrases": pa.array([len(f) for f in found], pa.int64()),
                    }
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    data = text_or_empty().cast("binary").alias("data")
    return docs.select("doc_id", data).mapInArrow(run, f"doc_id {kind}, fingerprint string, n_phrases long")


#: A row's place in the order: whether its id is there, the id, and a hash of its text.
Place = tuple[bool, object, int]


def _first_places(docs: DataFrame, part_bytes: int) -> list[Place]:
    """The first place of every part, in order; about one part for each `part_bytes` of text."""
    places = docs.select("doc_id", F.xxhash64("data").alias("hash"))
    total = docs.agg(F.sum(F.octet_length("data")), F.count(F.lit(1))).first()
    parts = max(1, -(-((total[0] or 0) + 64 * total[1]) // part_bytes))
    key = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "hash")
    dealt = places.repartitionByRange(parts, "doc_id", "hash")
    firsts = dealt.groupBy(F.spark_partition_id().alias("part")).agg(F.min(key).alias("first")).select("first.*").collect()
    return sorted({(r.known, r.doc_id if r.known else 0, r.hash) for r in firsts}, key=lambda p: (p[0], p[1] if p[0] else 0, p[2]))


def _dealt(firsts: list[Place]):
    """The rows with their part; the first rows of a part once more, marked, at the end of the part before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = set(firsts)
        order = [(known, doc_id, h) for known, doc_id, h in firsts]
        nulls = [h for known, _, h in order if not known]
        named = [(doc_id, h) for known, doc_id, h in order if known]
        for batch in batches:
            ids, hashes = batch.column("doc_id").to_pylist(), batch.column("hash").to_pylist()
            part, again, last = [], [], []
            for i, (doc_id, h) in enumerate(zip(ids, hashes, strict=True)):
                if doc_id is None:
                    at = bisect_right(nulls, h) - 1
                else:
                    at = len(nulls) + bisect_right(named, (doc_id, h)) - 1
                part.append(at)
                if (doc_id is not None, 0 if doc_id is None else doc_id, h) in starts:
                    again.append(i)
                    last.append((at - 1) % len(order))
            rows = batch.append_column("part", pa.array(part, pa.int32())).append_column("ahead", pa.array([False] * len(part)))
            yield rows
            if again:
                extra = batch.take(pa.array(again))
                yield extra.append_column("part", pa.array(last, pa.int32())).append_column("ahead", pa.array([True] * len(again)))

    return run


def _in_order(size: int, dictionary: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        before: _Document | None = None
        part, over = None, False
        for batch in batches:
            columns = [batch.column(c) for c in ("part", "ahead", "doc_id", "data")]
            for number, ahead, doc_id, data in zip(*columns, strict=True):
                if number.as_py() != part:
                    part, before, over = number.as_py(), None, False
                if over:  # copies of the row ahead
                    continue
                document = _Document(doc_id.as_py(), data.as_py(), size, dictionary)
                if before is not None:
                    out.append(before.row(document))
                before, over = document, ahead.as_py()
                if len(out) >= 256:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def edited(
    docs: DataFrame, size: int = SIGNATURE, dictionary: int = DICTIONARY, part_bytes: int = RANGE_BYTES
) -> DataFrame:
    """Every row with the fingerprints of its text and of its edited text, and how like it is to that and to the next row's.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. The plan is
    made after the ranges of `docs` are known, which reads it twice.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", text_or_empty().cast("binary").alias("data"))
    firsts = _first_places(rows, part_bytes)
    hashed = rows.select("doc_id", "data", F.xxhash64("data").alias("hash"))
    dealt = hashed.mapInArrow(_dealt(firsts), f"doc_id {kind}, data binary, hash long, part int, ahead boolean")
    ordered = dealt.repartition("part").sortWithinPartitions("part", "ahead", "doc_id", "hash")
    schema = pa.schema(
        [
            ("doc_id", pa.string() if kind == "string" else pa.int32() if kind == "int" else pa.int64()), ("n_chars", pa.int64()),
            *((c, pa.string()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")),
            ("near_edited", pa.float64()), ("near_next", pa.float64()),
        ]
    )
    return ordered.select("part", "ahead", "doc_id", "data").mapInArrow(
        _in_order(size, dictionary, schema),
        f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )


def op13_phrase_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    return edited(table(spark, folder, "documents"))
