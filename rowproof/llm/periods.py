"""Periodic runs of words, found by string synchronising sets.

A run is a stretch of a document with smallest period q, at least four (`EXPONENT`) times q long, that
neither neighbour extends. Periods up to `SMALL` are read off by comparing the words with themselves so far
apart. Beyond, for every power of two t a synchronising set of level t is chosen: a position is in it if the
least hash of t words among those that begin at it or at the t positions after it is the first's or the
last's. Whether a position is in the set depends on its 2t words only, so a run with period p has, p
words further on, the next position of the same context: equal contexts propose their distance as a period.

Where the t words have a period of t/4 or less (the highly periodic places), many hashes are equal and none
is taken. Those places are parts of runs of a smaller period, and these are all known when level t begins.

Why no run is missed. Take a run of period p from s on, and the level t with (3t-1)/2 <= p <= 3t-1.
Not all positions from s to s+p+2t-2 can be highly periodic: neighbours would share their period, and by
the lemma of Fine and Wilf the run would have a period below p. Hence one of the t positions from some
i < s+p on is in the set; its context ends before s+p+3t-2 and comes again p later, before s+2p+3t-2 <= s+4p,
so inside the run. Two equal contexts of the set are more than t/4 apart, so a position has at most twelve
partners within 3t-1; all are looked at. A proposal is taken to its full length word by word, so hashes only
propose; of equal stretches the smallest period stays.

A document is worked on by one task in memory that is a fixed multiple of its size, documents are grouped
into blocks of about a megabyte, nothing is shuffled, and a lost task is done again.

Defined cases: a null or blank text has no words and no runs; repeated rows, ids that are shared or null
are rows of their own; very long texts are taken whole; of other columns those named by `carry` are passed on.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowproof.llm.texts import blocks, byte_view, list_column, mix, table, text_or_empty, word_bounds

#: A run is at least so many times its period long. The proof above needs four or more.
EXPONENT = 4
#: Words that a run has at least.
LEAST = 6
#: Periods found by direct comparison; the first level of the sets, four words, begins after them.
SMALL, FIRST_LEVEL = 5, 4
#: Words compared at once while proposals are taken to their full length.
COMPARED = 1 << 20

NONE = np.uint64((1 << 64) - 1)


def numbered_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number per word, equal for equal words only."""
    if not len(starts):
        return np.zeros(0, np.int32)
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts] += 1
    inside[ends] -= 1
    letters = data[np.cumsum(inside[:-1]).astype(bool)]
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    return words.dictionary_encode().indices.to_numpy()


def least_of(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours."""
    reach = 1
    while 2 * reach <= width:
        x = np.minimum(x[:-reach], x[reach:])
        reach *= 2
    return np.minimum(x[: len(x) - (width - reach)], x[width - reach :]) if reach < width else x


def stretches(true: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the maximal stretches of true values."""
    edges = np.flatnonzero(np.diff(true.astype(np.int8), prepend=0, append=0))
    return edges[::2], edges[1::2]


def _agree(ids: np.ndarray, a: np.ndarray, b: np.ndarray, room: np.ndarray, step: int) -> np.ndarray:
    """How many words from a and from b on agree, going by `step`, at most `room`."""
    far, todo, width = np.zeros(len(a), np.int64), np.flatnonzero(room > 0), 16
    while len(todo):
        going = []
        each = max(1, COMPARED // width)
        for low in range(0, len(todo), each):
            part = todo[low : low + each]
            k = np.minimum(far[part][:, None] + np.arange(width), room[part][:, None] - 1)
            equal = ids[a[part][:, None] + step * k] == ids[b[part][:, None] + step * k]
            count = np.where(equal.all(axis=1), width, equal.argmin(axis=1))
            far[part] = np.minimum(far[part] + count, room[part])
            going.append(part[(count == width) & (far[part] < room[part])])
        todo, width = np.concatenate(going), min(2 * width, COMPARED)
    return far


class _Found:
    """Runs so far: begin, end and period, in words of the block."""

    def __init__(self) -> None:
        self.parts: list[np.ndarray] = [np.zeros((0, 3), np.int64)]

    def add(self, low: np.ndarray, high: np.ndarray, period: np.ndarray) -> None:
        self.parts.append(np.column_stack([low, high, period]))

    def all(self) -> np.ndarray:
        """Each stretch once, with its smallest period."""
        rows = np.concatenate(self.parts)
        rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
        self.parts = [rows[new]]
        return self.parts[0]


def _proposals(position: np.ndarray, context: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and distances of equal contexts that are as far apart as the level's periods."""
    bits = max(16, int(position[-1]).bit_length()) if len(position) else 16
    low = np.uint64((1 << bits) - 1)
    packed = np.sort((context & ~low) | position.astype(np.uint64))
    place, name = (packed & low).astype(np.int64), packed & ~low
    first, apart = np.zeros(0, np.int64), np.zeros(0, np.int64)
    here, k = np.arange(len(place)), 0
    while len(here):
        k += 1
        here = here[here + k < len(place)]
        distance = place[here + k] - place[here]
        near = (name[here + k] == name[here]) & (distance <= 3 * level - 1)
        here, distance = here[near], distance[near]
        fit = 2 * distance >= 3 * level - 1
        first, apart = np.append(first, place[here[fit]]), np.append(apart, distance[fit])
    return first, apart


def runs(ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Begin, end (places in `ids`) and period of every run of every document; `first` tells where each begins."""
    found = _Found()
    end = np.repeat(first[1:], np.diff(first))
    for p in range(1, SMALL + 1):
        if len(ids) <= p:
            break
        begin, stop = stretches((ids[p:] == ids[:-p]) & (end[: len(ids) - p] > np.arange(p, len(ids))))
        far = stop - begin + p >= EXPONENT * p
        found.add(begin[far], stop[far] + p, np.full(far.sum(), p))
    level = FIRST_LEVEL
    # From here on only documents long enough for a run of the level; `place` leads back to the block.
    place, h = np.arange(len(ids)), mix(ids.astype(np.uint64))
    size = np.diff(first)
    doc = np.repeat(np.arange(len(size)), size)
    for reach in (1, 2):
        h = _joined(h, reach)
    while len(place):
        enough = size[doc] >= 2 * EXPONENT * level - 2 * level - 2
        if not enough.all():
            place, h, doc = place[enough], h[enough], doc[enough]
        if not len(place):
            break
        left = end[place] - place
        hashes = np.where(left >= level, h, NONE)
        known = found.all()
        known = known[(known[:, 2] * EXPONENT <= level) & (known[:, 1] - known[:, 0] >= level)]
        if len(known):
            edges = np.zeros(len(ids) + 1, np.int32)
            np.add.at(edges, known[:, 0], 1)
            np.add.at(edges, known[:, 1] - level + 1, -1)
            hashes[np.cumsum(edges[:-1])[place] > 0] = NONE
        least = least_of(hashes, level + 1)
        chosen = np.flatnonzero(
            (left[: len(least)] >= 2 * level) & (least != NONE)
            & ((least == hashes[: len(least)]) | (least == hashes[level:]))
        )
        h = _joined(h, level)
        at, period = _proposals(chosen, h[chosen] + mix(doc[chosen].astype(np.uint64)), level)
        at = place[at]
        inside = at + period < end[at]
        _take(ids, first, doc_end=end, at=at[inside], period=period[inside], level=level, found=found)
        level *= 2
    return found.all()


def _joined(h: np.ndarray, reach: int) -> np.ndarray:
    """Hashes of twice the words; those that reach into the next document are never used."""
    return mix(h * np.uint64(0x9FB21C651E98DF25) + np.append(h[reach:], np.zeros(min(reach, len(h)), np.uint64)), reach)


def _take(
    ids: np.ndarray, first: np.ndarray, doc_end: np.ndarray, at: np.ndarray, period: np.ndarray, level: int, found: _Found
) -> None:
    """Join proposals of one period that overlap, take them to their full length and keep the runs."""
    if not len(at):
        return
    order = np.lexsort((at, period))
    at, period = at[order], period[order]
    fresh = np.ones(len(at), bool)
    fresh[1:] = (period[1:] != period[:-1]) | (at[1:] > at[:-1] + 2 * level)
    head = np.flatnonzero(fresh)
    low, p = at[head], period[head]
    high = np.append(at[head[1:] - 1], at[-1]) + 2 * level  # words low..high-1 agree with those p later
    begin = first[np.searchsorted(first, low, "right") - 1]
    low = low - _agree(ids, low - 1, low - 1 + p, low - begin, -1)
    high = high + _agree(ids, high, high + p, np.maximum(doc_end[low] - p - high, 0), 1)
    some = np.flatnonzero(high - low + p >= EXPONENT * p)
    rows = np.unique(np.column_stack([low[some], high[some], p[some]]), axis=0)
    for a, b, q in rows.tolist():
        begins, ends = stretches(ids[a:b] == ids[a + q : b + q])  # one, unless a hash misled
        far = ends - begins + q >= EXPONENT * q
        found.add(a + begins[far], a + ends[far] + q, np.full(far.sum(), q))


def joined_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> pa.Array:
    """One text per document: its words, one blank between two. `first` tells where each document's words begin."""
    lead = np.ones(len(starts), np.int64)
    lead[first[:-1][first[:-1] < first[1:]]] = 0
    sizes = ends - starts + lead
    to = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(sizes, out=to[1:])
    out = data[np.arange(to[-1]) + np.repeat(starts - lead - to[:-1], sizes)] if len(starts) else np.zeros(0, np.uint8)
    out[to[:-1][lead > 0]] = 32
    offsets = to[first].astype(np.int64)
    return pa.Array.from_buffers(pa.large_utf8(), len(first) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(out)]).cast(pa.string())


def _periodic(least: int, exponent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = byte_view(batch.column("text"))
            for a, b in blocks(at):
                part = data[at[a] : at[b]]
                starts, ends, first = word_bounds(part, at[a : b + 1] - at[a])
                found = runs(numbered_words(part, starts, ends), first)
                size = found[:, 1] - found[:, 0]
                found = found[size >= np.maximum(least, exponent * found[:, 2])]
                doc = np.searchsorted(first, found[:, 0], "right") - 1
                edges = np.zeros(len(starts) + 1, np.int64)
                np.add.at(edges, found[:, 0] + found[:, 2], 1)
                np.add.at(edges, found[:, 1], -1)
                kept = np.cumsum(edges[:-1]) == 0
                kept_before = np.append(0, np.cumsum(kept))
                spans = pa.StructArray.from_arrays(
                    [pa.array(x) for x in (found[:, 0] - first[doc], found[:, 1] - found[:, 0], found[:, 2])],
                    ["start", "length", "period"],
                )
                made = {
                    "n_words": pa.array(np.diff(first)),
                    "runs": list_column(spans, np.bincount(doc, minlength=b - a)),
                    "collapsed": joined_words(part, starts[kept], ends[kept], kept_before[first]),
                }
                yield pa.RecordBatch.from_pydict({"carried": batch.column("carried").slice(a, b - a)} | made)

    return run


def periodic_runs(
    docs: DataFrame, least: int = LEAST, exponent: int = EXPONENT, carry: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """carried (the named columns), n_words, runs and collapsed of every row of `docs`.

    `runs` lists (start, length, period) by start, then period, of runs that are at least `least` words and
    `exponent` (four or more) periods long. `collapsed` has the words, one blank between two, without
    those that any run holds after its first period.
    """
    if exponent < EXPONENT:
        raise ValueError(f"runs of fewer than {EXPONENT} periods are not looked for")
    rows = docs.select(F.struct(*carry).alias("carried"), text_or_empty().alias("text"))
    kind = rows.schema["carried"].dataType.simpleString()
    return rows.mapInArrow(
        _periodic(least, exponent),
        f"carried {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string",
    )


def _planted(docs: DataFrame) -> DataFrame:
    """doc_id and text; of a tenth of the ids the words repeat, from a place and with a period that the id gives."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10).cast("long")

    def repeated(words: Column) -> Column:
        n = F.size(words)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        tail = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
        whole = F.slice(F.concat(F.slice(words, F.lit(1), a), tail), F.lit(1), n)
        return F.when(n > 0, F.array_join(whole, " ")).otherwise("")

    words = F.filter(F.split(text_or_empty(), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    # The lambda's argument is split once, not once per use.
    planted = F.get(F.transform(F.array(words), repeated), F.lit(0))
    return docs.select("doc_id", F.when(h % 10 == 0, planted).otherwise(text_or_empty()).alias("text"))


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs(_planted(table(spark, folder, "documents")))
    longest = F.array_max(
        F.transform(
            "runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))
        )
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(""))
    return found.select("*", longest.alias("longest")).select(
        F.col("carried.doc_id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.start")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"),
        F.expr("1000 * longest.length div -longest.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
