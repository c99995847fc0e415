"""Windows of a fixed number of symbols (bytes or words) that occur more than once, exactly.

Two equal windows have the same minimiser: the least hash among their grams of a shorter length.
Consecutive windows of a text that share one are a run. A window can only occur twice if the hash of its
minimiser does, so:

1. one scan finds the runs of every text; they are written as numbers (place, length, minimiser hash);
2. hashes that occur once are left out, counted with partial sums: nearly all of an ordinary text goes here;
3. the runs that are left are cut out of their texts, each as one piece of text that holds all its
   windows, and sent to the bucket of their minimiser, where an operator finds equal windows in its own way;
4. repeated windows come back as spans of their document.

Texts are shuffled once, for steps 3 and 4 together (Spark reuses that exchange). A bucket group is
bounded: the group of a minimiser with more than `hot` windows is not gathered but split by one more digit,
a 128-bit cryptographic digest (BLAKE2b) of each window's own bytes. Equal pieces are counted as one first, then
the windows of distinct pieces by that digit, with partial sums, so a passage that a third of all documents
share is summed in every task before it moves. Only here do equal digests stand for equal windows; their
bytes are not compared. Joins back are ordinary equi-joins, which adaptive execution divides where a key is hot.

Hot minimisers are few, one for each `hot` windows of the corpus at most. Up to `MOST_HOT` of them are sent to
a second scan of the texts; more are joined to the rows that have them.

Rows are known by doc_id and a 128-bit hash of their text, so that rows sharing a doc_id, or without one, are
texts of their own and a repeated row is a copy. Runs, pieces and spans carry a number for the two, given when
the runs are written.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowproof.llm.texts import (
    blocks, byte_view, list_column, prefix_hash, span_hash, text_or_empty, word_bounds,
)
from rowproof.sources.staging import staged

#: Windows of one minimiser that one task may hold (some hundred bytes each); more take the way for hot ones.
HOT_WINDOWS = 1 << 21
#: Bytes of pieces that a bucket task works on at once, beyond the group it is in.
BUCKET_BYTES = 1 << 22
#: Hot minimisers that a task may hold as a list (eight bytes each); more come to the rows by a join.
MOST_HOT = 1 << 18
#: Symbols of a text looked at together: a minimiser's place must fit in so many.
PLACE_BITS = 22
LONGEST = 1 << (PLACE_BITS - 1)


@dataclass(frozen=True)
class Scheme:
    """What a symbol is, and the lengths of a window and of a gram in symbols."""

    words: bool
    window: int
    gram: int


@dataclass
class Symbols:
    """All symbols of some texts: a number each, their bytes, and where each text's begin."""

    values: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray


def symbols(data: np.ndarray, at: np.ndarray, words: bool) -> Symbols:
    if not words:
        places = np.arange(len(data) + 1)
        return Symbols(data, places[:-1], places[1:], at)
    starts, ends, first = word_bounds(data, at)
    return Symbols(span_hash(prefix_hash(data), starts, ends), starts, ends, first)


def _least_of(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours."""
    reach = 1
    while 2 * reach <= width:
        x = np.minimum(x[:-reach], x[reach:])
        reach *= 2
    return np.minimum(x[: len(x) - (width - reach)], x[width - reach :]) if reach < width else x


def runs(values: np.ndarray, first: np.ndarray, scheme: Scheme) -> tuple[np.ndarray, ...]:
    """Text, first window in the text, number of windows and minimiser hash of every run."""
    window, gram = scheme.window, scheme.gram
    none = np.zeros(0, np.int64)
    if len(values) < window:
        return none, none, none, none
    h, begin = prefix_hash(values), np.arange(len(values) - gram + 1)
    hashes = span_hash(h, begin, begin + gram)
    low = np.uint64((1 << PLACE_BITS) - 1)
    least = _least_of((hashes & ~low) | begin.astype(np.uint64), window - gram + 1)
    edges = np.zeros(len(least) + 1, np.int8)
    some = np.diff(first) >= window
    edges[first[:-1][some]] += 1
    edges[first[1:][some] - window + 1] -= 1
    inside = np.cumsum(edges[:-1]).astype(bool)
    new = inside.copy()
    new[1:] &= (least[1:] != least[:-1]) | ~inside[:-1]
    start = np.flatnonzero(new)
    count = np.bincount((np.cumsum(new) - 1)[inside], minlength=len(start))
    text = np.searchsorted(first, start, "right") - 1
    return text, start - first[text], count, hashes[(least[start] & low).astype(np.int64)].view(np.int64)


def _stretches(s: Symbols, window: int) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """Texts whole, or very long ones in stretches that overlap by a window less one symbol."""
    step = LONGEST - window + 1
    t = 0
    while t < len(s.first) - 1:
        if s.first[t + 1] - s.first[t] > LONGEST:
            for low in range(s.first[t], s.first[t + 1] - window + 1, step):
                yield t, low - s.first[t], low, np.array([low, min(low + LONGEST, s.first[t + 1])])
            t += 1
            continue
        last = t
        while last < len(s.first) - 1 and s.first[last + 1] - s.first[t] <= LONGEST:
            last += 1
        yield t, 0, s.first[t], s.first[t : last + 1]
        t = last


def _mark(scheme: Scheme, whole: bool = False):
    """The runs of every text that has any; with the rows of those texts, if `whole`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = byte_view(batch.column("text"))
            for a, b in blocks(at):
                s = symbols(data[at[a] : at[b]], at[a : b + 1] - at[a], scheme.words)
                found = []
                for t, offset, low, first in _stretches(s, scheme.window):
                    text, start, count, key = runs(s.values[low : first[-1]], first - low, scheme)
                    found.append((text + t, start + offset, count, key))
                if not found:
                    continue
                text, start, count, key = (np.concatenate(x) for x in zip(*found, strict=True))
                sizes = np.bincount(text, minlength=b - a)
                some = pa.array(np.flatnonzero(sizes))
                rows = batch.slice(a, b - a).take(some)
                marked = pa.RecordBatch.from_pydict(
                    {
                        "doc_id": rows.column("doc_id"),
                        "th": rows.column("th"),
                        "runs": list_column(pa.array((start << 16) | count), sizes[sizes > 0]),
                        "keys": list_column(pa.array(key), sizes[sizes > 0]),
                    }
                )
                yield (marked, rows) if whole else marked

    return run


def _cut(scheme: Scheme, with_hot: bool, row: tuple[str, ...] = ("number",)):
    """The runs in `todo` as pieces; `row` are the columns that tell whose they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = byte_view(batch.column("text"))
            for a, b in blocks(at):
                part, ends = data[at[a] : at[b]], at[a : b + 1] - at[a]
                s = symbols(part, ends, scheme.words)
                todo = batch.column("todo").slice(a, b - a)
                sizes = np.diff(todo.offsets.to_numpy())
                todo = todo.flatten()
                doc = np.repeat(np.arange(b - a), sizes)
                place, hot = todo.field("run").to_numpy(), todo.field("hot").to_numpy(zero_copy_only=False)
                mine = np.flatnonzero(hot == with_hot)
                if not len(mine):
                    continue
                doc, place = doc[mine], place[mine]
                first, count = place >> 16, place & 0xFFFF
                begin = s.first[doc] + first
                start, end = s.starts[begin], s.ends[begin + count + scheme.window - 2]
                piece = [part[x:y].tobytes() for x, y in zip(start.tolist(), end.tolist(), strict=True)]
                if scheme.words:
                    piece = [b" ".join(x.split()) for x in piece]
                which = pa.array(doc)
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": todo.field("key").take(pa.array(mine)),
                        **{c: batch.column(c).slice(a, b - a).take(which) for c in row},
                        "first": pa.array(first),
                        "n": pa.array(count),
                        "piece": pa.array(piece, pa.binary()),
                    }
                )

    return run


def _cut_known(scheme: Scheme, known: np.ndarray):
    """The pieces of runs whose minimiser is one of the sorted `known`, straight from the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = _cut(scheme, True, ("doc_id", "th"))
        for marked, rows in _mark(scheme, whole=True)(batches):
            keys, places = marked.column("keys"), marked.column("runs")
            sizes = np.diff(keys.offsets.to_numpy())
            key = keys.flatten().to_numpy()
            mine = known[np.minimum(np.searchsorted(known, key), len(known) - 1)] == key
            if not mine.any():
                continue
            count = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[mine], minlength=len(sizes))
            todo = pa.StructArray.from_arrays(
                [places.flatten().filter(pa.array(mine)), pa.array(key[mine]), pa.array(np.ones(mine.sum(), bool))], ["run", "key", "hot"]
            )
            texts = {c: rows.column(c) for c in ("doc_id", "th", "text")}
            yield from cut([pa.RecordBatch.from_pydict(texts | {"todo": list_column(todo, count)})])

    return run


def merged(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping or touching spans of a row as one; spans come in any order."""
    order = np.lexsort((start, row))
    row, start, end = row[order], start[order], end[order]
    if not len(row):
        return row, start, end
    # Ends so far within a row: rows are told apart by a shift beyond any end.
    shift = row * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + shift)
    new = np.concatenate([[True], (start[1:] + shift[1:] > reach[:-1]) | (row[1:] != row[:-1])])
    at = np.flatnonzero(new)
    last = np.concatenate([at[1:], [len(row)]]) - 1
    return row[at], start[at], reach[last] - shift[last]


def _spans(table: pa.Table, row: np.ndarray, at: np.ndarray, window: int) -> pa.RecordBatch:
    """Spans of the windows `at` of the rows' pieces, in symbols of their documents."""
    begin = table.column("first").to_numpy()[row] + at
    row, start, end = merged(row, begin, begin + window)
    which = pa.array(row)
    return pa.RecordBatch.from_pydict(
        {
            **{c: table.column(c).combine_chunks().take(which) for c in ("number", "doc_id", "th") if c in table.column_names},
            "start": pa.array(start),
            "stop": pa.array(end),
        }
    )


def whole_groups(batches: Iterator[pa.RecordBatch], most: int = BUCKET_BYTES) -> Iterator[pa.Table]:
    """Rows sorted by key, so many bytes at once and never a key in two tables."""
    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows])
        if held.nbytes < most:
            continue
        keys = held.column("key").to_numpy()
        cut = int(np.searchsorted(keys, keys[-1]))
        if cut:
            yield held.slice(0, cut)
            held = held.slice(cut)
    if held is not None and held.num_rows:
        yield held


Finder = Callable[[np.ndarray, list[bytes], np.ndarray, Scheme], np.ndarray]


def _bucket(scheme: Scheme, find: Finder):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches):
            # Equal pieces are looked at once; all windows of a piece that comes twice are repeated.
            code = table.column("piece").combine_chunks().dictionary_encode()
            of = code.indices.to_numpy()
            copies = np.bincount(of)
            n, key = np.zeros(len(copies), np.int64), np.zeros(len(copies), np.int64)
            n[of], key[of] = table.column("n").to_numpy(), table.column("key").to_numpy()
            again = find(key, code.dictionary.to_pylist(), n, scheme) | np.repeat(copies > 1, n)
            begin = np.cumsum(n) - n
            row = np.repeat(np.arange(len(of)), n[of])
            at = np.arange(len(row)) - np.repeat(np.cumsum(n[of]) - n[of], n[of])
            yes = again[np.repeat(begin[of], n[of]) + at]
            if yes.any():
                yield _spans(table, row[yes], at[yes], scheme.window)

    return run


def _digits(scheme: Scheme):
    """The digest of every window of a piece, as two numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = byte_view(batch.column("piece"))
            for a, b in blocks(at, BUCKET_BYTES // 16):
                part = data[at[a] : at[b]]
                s = symbols(part, at[a : b + 1] - at[a], scheme.words)
                n = batch.column("n").slice(a, b - a).to_numpy()
                row = np.repeat(np.arange(b - a), n)
                place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                begin = s.first[row] + place
                start, end = s.starts[begin].tolist(), s.ends[begin + scheme.window - 1].tolist()
                view = memoryview(part.tobytes())
                digest = b"".join(hashlib.blake2b(view[x:y], digest_size=16).digest() for x, y in zip(start, end, strict=True))
                one, two = np.frombuffer(digest, np.int64).reshape(-1, 2).T
                which = pa.array(row)
                yield pa.RecordBatch.from_pydict(
                    {
                        "number": batch.column("number").slice(a, b - a).take(which),
                        "at": pa.array(place),
                        "one": pa.array(one.copy()),
                        "two": pa.array(two.copy()),
                        "copies": batch.column("copies").slice(a, b - a).take(which),
                    }
                )

    return run


def _hot_spans(scheme: Scheme):
    """Spans of all windows of a piece but those that `alone` names (null: none)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, 1 << 12):
                batch = whole.slice(low, 1 << 12)
                n, alone = batch.column("n").to_numpy(), batch.column("alone")
                row = np.repeat(np.arange(len(n)), n)
                begin = np.cumsum(n) - n
                again = np.ones(len(row), bool)
                sizes = alone.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                again[np.repeat(begin, sizes) + alone.flatten().to_numpy()] = False
                if again.any():
                    at = np.arange(len(row)) - np.repeat(begin, n)
                    yield _spans(pa.Table.from_batches([batch]), row[again], at[again], scheme.window)

    return run


def same_row(left: str, right: str) -> Column:
    """Rows of two relations whose id columns have these prefixes are the same."""
    return F.col(f"{left}doc_id").eqNullSafe(F.col(f"{right}doc_id")) & (F.col(f"{left}th") == F.col(f"{right}th"))


def numbered(docs: DataFrame) -> DataFrame:
    """doc_id, th, text: what rows are known by, and their text."""
    # Never null, also by its type: an inner join would else filter the texts, and their exchange serve only once.
    digest = F.coalesce(F.unhex(F.md5("text")), F.lit(b""))
    return docs.select("doc_id", text_or_empty().alias("text")).select("doc_id", digest.alias("th"), "text")


def with_spans(docs: DataFrame, scheme: Scheme, find: Finder, hot: int = HOT_WINDOWS, most_hot: int = MOST_HOT) -> DataFrame:
    """doc_id, text and `spans` (list of start, stop in symbols, or null) of every row of `docs`.

    A span is covered by windows that also start elsewhere. `find` gets keys, distinct pieces with their
    numbers of windows, and tells for every window whether it equals another one of the same key.
    """
    base = numbered(docs)
    id_kind = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, th binary"
    marks = staged(
        base.mapInArrow(_mark(scheme), f"{id_kind}, runs array<long>, keys array<long>")
        .withColumn("number", F.monotonically_increasing_id())
    )
    keys = staged(
        marks.select(F.explode(F.arrays_zip("runs", "keys")).alias("r"))
        .groupBy(F.col("r.keys").alias("known"))
        .agg(F.count(F.lit(1)).alias("c"), F.sum(F.col("r.runs").bitwiseAND(0xFFFF)).alias("windows")).filter("c > 1")
        .select("known", (F.col("windows") > hot).alias("hot"))
    )
    # Rows that repeat an id and its text have one number.
    rows = staged(
        marks.groupBy(F.col("doc_id").alias("t_doc_id"), F.col("th").alias("t_th")).agg(F.min("number").alias("number"))
    )
    todo = (
        marks.select(F.col("number").alias("number2"), F.explode(F.arrays_zip("runs", "keys")).alias("r"))
        .select("number2", F.col("r.runs").alias("run"), F.col("r.keys").alias("key"))
        .join(keys, F.col("key") == F.col("known"))
        .groupBy("number2")
        .agg(F.collect_list(F.struct("run", "key", "hot")).alias("todo"))
    )
    todo = rows.join(todo, F.col("number") == F.col("number2")).drop("number2")
    chosen = base.join(todo, same_row("", "t_")).select("number", "text", "todo")
    piece_kind = "first long, n long, piece binary"
    span_kind = "number long, start long, stop long"
    spans = (
        chosen.mapInArrow(_cut(scheme, False), f"key long, number long, {piece_kind}")
        .repartition("key").sortWithinPartitions("key")
        .mapInArrow(_bucket(scheme, find), span_kind)
    )
    spans_of = F.collect_set(F.struct("start", "stop")).alias("spans")
    hot_listed = None
    known = np.sort(np.array([r.known for r in keys.filter("hot").select("known").limit(most_hot + 1).collect()], np.int64))
    if len(known):
        if len(known) <= most_hot:
            own = ("doc_id", "th")
            cut = base.mapInArrow(_cut_known(scheme, known), f"key long, {id_kind}, {piece_kind}")
        else:
            own = ("number",)
            cut = chosen.filter(F.exists("todo", lambda x: x["hot"])).mapInArrow(_cut(scheme, True), f"key long, number long, {piece_kind}")
        pieces = staged(cut.select(*own, "first", "n", "piece", F.unhex(F.md5("piece")).alias("pid")))
        # Numbers are given once: what is written keeps them.
        distinct = staged(
            pieces.groupBy("piece").agg(F.count(F.lit(1)).alias("copies"), F.min("n").alias("n"))
            .withColumns({"pid": F.unhex(F.md5("piece")), "number": F.monotonically_increasing_id()})
        )
        # A window that occurs once has one row, which the least number and place of its group name.
        alone = (
            distinct.mapInArrow(_digits(scheme), "number long, at long, one long, two long, copies long")
            .groupBy("one", "two").agg(F.sum("copies").alias("c"), F.min("number").alias("number2"), F.min("at").alias("at"))
            .filter("c = 1").groupBy("number2").agg(F.collect_list("at").alias("alone"))
        )
        # Written, so that a piece of very many documents meets a plain exchange, which Spark can divide.
        places = staged(
            distinct.select(F.col("pid").alias("pid2"), "number", F.col("n").alias("n2"))
            .join(alone, F.col("number") == F.col("number2"), "left")
            .filter(F.col("alone").isNull() | (F.size("alone") < F.col("n2"))).select("pid2", "alone")
        )
        found = (
            pieces.join(places, F.col("pid") == F.col("pid2")).select(*own, "first", "n", "alone")
            .mapInArrow(_hot_spans(scheme), span_kind if own == ("number",) else f"{id_kind}, start long, stop long")
        )
        if own == ("number",):
            spans = spans.unionByName(found)
        else:
            hot_listed = found.groupBy(F.col("doc_id").alias("s_doc_id"), F.col("th").alias("s_th")).agg(spans_of)
    listed = spans.groupBy(F.col("number").alias("number2")).agg(spans_of)
    listed = (
        rows.join(listed, F.col("number") == F.col("number2"))
        .select(F.col("t_doc_id").alias("s_doc_id"), F.col("t_th").alias("s_th"), "spans")
    )
    if hot_listed is not None:
        # A row has two lists at most, one of each way.
        listed = listed.unionByName(hot_listed).groupBy("s_doc_id", "s_th").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    return base.join(listed, same_row("", "s_"), "left").select("doc_id", "text", "spans")


def covered(spans: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, start and stop of the maximal covered runs of some texts."""
    sizes = np.diff(spans.offsets.to_numpy())
    sizes = np.where(spans.is_null().to_numpy(zero_copy_only=False), 0, sizes)
    flat = spans.flatten()
    return merged(
        np.repeat(np.arange(len(spans)), sizes),
        flat.field("start").to_numpy().astype(np.int64), flat.field("stop").to_numpy().astype(np.int64),
    )
