"""Near-duplicate vectors: PCA-ordered tiled comparison with suffix-norm bounds.

Unit vectors are turned into the basis of their principal components, largest first. Two tiles of vectors
are compared a few leading dimensions at a time; what the other dimensions can still add to a cosine is
at most the product of the two suffix norms, so a pair stops as soon as it cannot reach the threshold.
This is done in single precision with room for its rounding; what it cannot tell is computed in double.

Tiles are cells of a grid over the first two components, wide enough that linked vectors lie in the same
or in neighbouring cells; a cell with more vectors than a tile holds is divided by a hash. A tile is packed
into one value, in the precision in which its vectors are given, and written once; several tiles are a shelf,
the row in which they are read. Pairs of tiles are never shuffled or written: a task reads two parts of the shelves
and compares what of them are neighbours, so the disk holds the vectors twice, however many pairs there are.
A large group of copies is many pairs of tiles, never one task; and it leaves a task as counts and a spanning
forest, a row for each vector, never as pairs.

Comparing every pair that the grid leaves is the operator's own work and grows with the square of a cell;
the matrix of second moments (dimension squared) and the counts of crowded cells (at most a few hundred) are
all that the driver sees.

Defined cases: vectors that are null, empty, zero, or hold a null or a value that is not finite link with
nothing, nor does a null id. Ids are of any integral type. Vectors of different lengths are never linked; the basis is learned from the
most common length and others keep their own axes. Rows that share an id add up their links under it, and
copies of a row are links of each other. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from rowproof.llm.components import components
from rowproof.llm.texts import table
from rowproof.sources.staging import staged

THRESHOLD = 0.95
#: Vectors of a tile, and rows of a tile compared at once.
TILE, STRIP = 4096, 512
#: Bytes of a tile as doubles; long vectors make smaller tiles.
TILE_BYTES = 4 << 20
#: Bytes of the vectors of a shelf, and of the pairs of shelves that a task receives at once.
SHELF, RECEIVED = 4 << 20, "16777216"
#: Dimensions added between two tests of the bound.
STEP = 16
#: Below this share of pairs left, these are finished one by one.
FEW = 0.02
#: Cosines this near to the threshold are computed again from the given vectors.
CLOSE = 1e-9
#: Bytes of prepared tiles that a task keeps, and edges that it keeps before they are made a forest.
HELD, EDGES = 64 << 20, 1 << 20


def usable(vectors: DataFrame) -> DataFrame:
    """id, x: vectors that can be linked, as floats if they are given so, else as doubles."""
    given = vectors.schema["embedding"].dataType
    single = isinstance(getattr(given, "elementType", None), FloatType)
    x = F.col("embedding") if single else F.transform("embedding", lambda v: v.cast("double"))
    sound = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vectors.select(F.col("vec_id").alias("id"), x.alias("x")).filter(
        F.col("id").isNotNull() & F.col("x").isNotNull() & sound & F.exists("x", lambda v: v != 0)
    )


def _units(x: np.ndarray) -> np.ndarray:
    x = x.astype(float)
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def principal_axes(rows: DataFrame, dimension: int) -> np.ndarray:
    """Columns: the axes of largest second moment first, of all unit vectors of this length."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dimension, dimension))
        for batch in batches:
            flat = batch.column("x").flatten().to_numpy().reshape(-1, dimension)
            for low in range(0, len(flat), STRIP):
                x = _units(flat[low : low + STRIP])
                total += x.T @ x
        yield pa.RecordBatch.from_pydict({"moment": [total.tobytes()]})

    def add(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"moment": [sum(np.frombuffer(m) for m in group["moment"]).tobytes()]})

    parts = rows.filter(F.size("x") == dimension).mapInArrow(moments, "moment binary")
    parts = parts.groupBy(F.spark_partition_id() % 64).applyInPandas(add, "moment binary")
    total = sum(np.frombuffer(r.moment) for r in parts.collect())
    return np.linalg.eigh(np.reshape(total, (dimension, dimension)))[1][:, ::-1].copy()


def _cells(x: pa.ListArray, axes: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Length and cell of each vector; a vector's cell does not depend on the rows around it."""
    sizes = np.diff(x.offsets.to_numpy()).astype(np.int64)
    flat = x.flatten().to_numpy()
    at = np.cumsum(sizes) - sizes
    cell = np.zeros((len(sizes), 2), np.int64)
    for d in np.unique(sizes):
        every = np.flatnonzero(sizes == d)
        for low in range(0, len(every), STRIP):
            rows = every[low : low + STRIP]
            u = _units(flat[at[rows][:, None] + np.arange(d)])
            lead = np.einsum("ij,jk->ik", u, axes[:, :2]) if d == len(axes) else u[:, :2]
            cell[rows[:, None], np.arange(lead.shape[1])] = np.floor(lead / width)
    return sizes, cell[:, 0], cell[:, 1]


def _counted(axes: np.ndarray, width: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filter(len, batches):
            place, n = np.unique(np.stack(_cells(batch.column("x"), axes, width)), axis=1, return_counts=True)
            yield pa.RecordBatch.from_pydict({"size": place[0], "c1": place[1], "c2": place[2], "n": n})

    return run


def _dealt(axes: np.ndarray, width: float, parts: dict[tuple[int, int, int], int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = _cells(batch.column("x"), axes, width)
            most = np.array([parts.get(p, 1) for p in zip(*(c.tolist() for c in place), strict=True)], np.int64)
            part = batch.column("h").to_numpy() % most if len(most) else most
            yield pa.RecordBatch.from_pydict(
                {"id": batch.column("id"), "x": batch.column("x"), "size": place[0], "c1": place[1], "c2": place[2], "part": part}
            )

    return run


def _packed(group: pa.Table) -> pa.Table:
    first = group.slice(0, 1).to_pylist()[0]
    ids, x = (group.column(c).combine_chunks() for c in ("id", "x"))
    offsets = pa.array([0, len(ids)], pa.int32())
    return pa.table(
        {"tile": [first["tile"]], "size": [first["size"]], "c1": [first["c1"]], "c2": [first["c2"]],
         "ids": pa.ListArray.from_arrays(offsets, ids), "data": pa.array([x.flatten().to_numpy().tobytes()], pa.binary())}
    )


def _shelved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shelf = np.cumsum(pc.binary_length(batch.column("data")).to_numpy()) // SHELF
        first = np.flatnonzero(np.diff(shelf, prepend=-1))
        tiles = pa.StructArray.from_arrays(batch.columns, fields=list(batch.schema))
        offsets = pa.array([*first, len(shelf)], pa.int32())
        yield pa.RecordBatch.from_pydict({"shelf": batch.column("tile").take(pa.array(first)), "tiles": pa.ListArray.from_arrays(offsets, tiles)})


def shelves(rows: DataFrame, axes: np.ndarray, width: float, tile: int) -> DataFrame:
    """shelf, tiles (tile, size, c1, c2, ids, data): a tile is at most about `tile` vectors of a cell."""
    place = ("size", "c1", "c2")
    counted = rows.select("x").mapInArrow(_counted(axes, width), "size long, c1 long, c2 long, n long")
    room = F.greatest(F.lit(1), F.least(F.lit(tile), F.floor(F.lit(TILE_BYTES) / (8 * F.col("size")))))
    crowded = counted.groupBy(*place).agg(F.sum("n").alias("n")).withColumn("parts", F.ceil(F.col("n") / room)).filter("parts > 1")
    parts = {(r.size, r.c1, r.c2): r.parts for r in crowded.select("size", *place[1:], "parts").collect()}
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("id", "x")}
    dealt = rows.select("id", "x", F.xxhash64("id", "x").alias("h")).mapInArrow(
        _dealt(axes, width, parts), f"id {kinds['id']}, x {kinds['x']}, size long, c1 long, c2 long, part long"
    )
    packed = f"tile string, size long, c1 long, c2 long, ids array<{kinds['id']}>, data binary"
    tiles = dealt.withColumn("tile", F.concat_ws("/", *place, "part")).drop("part").groupBy("tile").applyInArrow(_packed, packed)
    return tiles.mapInArrow(_shelved, f"shelf string, tiles array<struct<{packed.replace(' ', ': ').replace(',:', ',')}>>")


class Side(NamedTuple):
    """Vectors as given and, in single precision, what is compared of them."""

    x: np.ndarray
    turned: np.ndarray
    #: Norm of what follows each step but the last; the first step of `turned` and the norm after it.
    rest: np.ndarray
    lead: np.ndarray

    def cut(self, low: int) -> Side:
        return Side(*(v[low : low + STRIP] for v in self))

    @property
    def bytes(self) -> int:
        return sum(v.nbytes for v in self)


def _side(x: np.ndarray, axes: np.ndarray | None) -> Side:
    u = _units(x)
    turned = u if axes is None else u @ axes
    after = np.add.reduceat(turned**2, np.arange(0, turned.shape[1], STEP), axis=1)[:, :0:-1].cumsum(1)
    rest = np.sqrt(after[:, ::-1]).astype(np.float32)
    turned = turned.astype(np.float32)
    return Side(x, turned, rest, np.hstack([turned[:, :STEP], rest[:, :1]]))


def _reaches(x: np.ndarray, y: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows of x and y, paired as given, have at least this cosine."""
    value = np.einsum("ij,ij->i", _units(x), _units(y))
    found = value >= threshold
    close = np.flatnonzero(np.abs(value - threshold) <= CLOSE)
    if len(close):
        x, y = x[close].astype(float), y[close].astype(float)
        found[close] = np.einsum("ij,ij->i", x, y) / np.sqrt(np.einsum("ij,ij->i", x, x) * np.einsum("ij,ij->i", y, y)) >= threshold
    return found


def _told(a: Side, b: Side, i: np.ndarray, j: np.ndarray, value: np.ndarray, slack: float, threshold: float) -> np.ndarray:
    """Which pairs i, j reach the threshold, by their single-precision cosines where these can tell."""
    found = value >= threshold + slack
    unsure = np.flatnonzero(~found & (value >= threshold - slack))
    for low in range(0, len(unsure), 4 * STRIP):
        k = unsure[low : low + 4 * STRIP]
        found[k] = _reaches(a.x[i[k]], b.x[j[k]], threshold)
    return found


def _places(few: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where few of a matrix of booleans are true, looked at by eights."""
    if few.size % 8:
        return np.nonzero(few)
    eights = np.flatnonzero(few.reshape(-1).view(np.uint64) != 0)
    at = np.flatnonzero(few.reshape(-1, 8)[eights])
    return np.divmod(eights[at // 8] * 8 + at % 8, few.shape[1])


def _linked(a: Side, b: Side, threshold: float) -> tuple[np.ndarray, np.ndarray] | np.ndarray:
    """Pairs of at least this cosine: places in a and in b if they are few, else a matrix of booleans."""
    dimension = a.x.shape[1]
    slack = (dimension + 16) * 2.0**-23  # more than rounding changes in sums of products of unit vectors
    low, steps = np.float32(threshold - 2 * slack), -(-dimension // STEP)
    bound = a.lead @ b.lead.T
    for step in range(1, steps + 1):
        open_ = bound >= low
        left = np.count_nonzero(open_)
        if left < FEW * open_.size or not left:
            i, j = _places(open_)
            value = np.einsum("ij,ij->i", a.turned[i], b.turned[j])
            found = _told(a, b, i, j, value, slack, threshold)
            return i[found], j[found]
        if step < steps:
            k = slice(step * STEP, (step + 1) * STEP)
            if step == 1:
                dots = bound - a.rest[:, :1] * b.rest[:, 0]
            dots += a.turned[:, k] @ b.turned[:, k].T
            bound = dots + a.rest[:, step, None] * b.rest[:, step] if step + 1 < steps else dots
    found = bound >= threshold + slack
    i, j = np.nonzero(open_ & ~found)
    found[i, j] = _told(a, b, i, j, bound[i, j], slack, threshold)
    return found


def close_pairs(a: np.ndarray, b: np.ndarray, axes: np.ndarray | None, threshold: float) -> np.ndarray:
    """Which rows of a and b (as given) have at least this cosine, as a matrix of booleans."""
    found = _linked(_side(a, axes), _side(b, axes), threshold)
    if isinstance(found, tuple):
        places, found = found, np.zeros((len(a), len(b)), bool)
        found[places] = True
    return found


def _forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """The smallest number linked to each of n by the edges i-j."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _spanning(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Some of the pairs of a matrix of booleans, which connect all that the others connect."""
    n, m = found.shape
    i, j, left = np.zeros(0, np.int64), np.zeros(0, np.int64), found
    while left.any():
        rows, columns = np.flatnonzero(left.any(1)), np.flatnonzero(left.any(0))
        i = np.concatenate([i, rows, left.argmax(0)[columns]])
        j = np.concatenate([j, left.argmax(1)[rows], columns])
        label = _forest(i, j + n, n + m)
        left = found & (label[:n, None] != label[n:])
    return i, j


class Found:
    """What a task finds: the links of each vector of its tiles, and edges that connect what is linked."""

    def __init__(self) -> None:
        self.tiles: dict[str, tuple[int, np.ndarray]] = {}
        self.ids: list[np.ndarray] = []
        self.edges = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        self.rows = self.open = 0

    def tile(self, name: str, ids: pa.Array) -> tuple[int, np.ndarray]:
        """The number of the first vector of a tile, and the links of its vectors."""
        if name not in self.tiles:
            self.tiles[name] = self.rows, np.zeros(len(ids), np.int64)
            self.ids.append(ids.to_numpy().copy())
            self.rows += len(ids)
        return self.tiles[name]

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        self.edges.append((i, j))
        self.open += len(i)
        if self.open >= EDGES + self.rows:
            label = self.forest()
            i = np.flatnonzero(label != np.arange(self.rows))
            self.edges, self.open = [(i, label[i])], 0

    def forest(self) -> np.ndarray:
        return _forest(*(np.concatenate(e) for e in zip(*self.edges, strict=True)), self.rows)

    def result(self) -> Iterator[pa.RecordBatch]:
        """u, v, n: each linked vector, the smallest id that it is connected to, and its links."""
        if not self.rows:
            return
        ids, count, label = np.concatenate(self.ids), np.concatenate([n for _, n in self.tiles.values()]), self.forest()
        least = ids.copy()
        np.minimum.at(least, label, ids)
        some = np.flatnonzero(count)
        for low in range(0, len(some), 32 * TILE):
            k = some[low : low + 32 * TILE]
            yield pa.RecordBatch.from_pydict({"u": pa.array(ids[k]), "v": pa.array(least[label[k]]), "n": pa.array(count[k])})


def _tiles(shelf: pa.ListScalar) -> dict[str, pa.Array]:
    tiles = shelf.values
    return {f.name: column for f, column in zip(tiles.type, tiles.flatten(), strict=True)}


def _neighbours(a: dict[str, pa.Array], b: dict[str, pa.Array]) -> np.ndarray:
    """Which tiles of two shelves can hold linked vectors: places in a and b, row by row."""
    near = a["size"].to_numpy()[:, None] == b["size"].to_numpy()
    for c in ("c1", "c2"):
        near &= np.abs(a[c].to_numpy()[:, None] - b[c].to_numpy()) <= 1
    return np.argwhere(near)


def _compared(axes: np.ndarray, threshold: float, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, sides, held = Found(), {}, 0

        def side(tile: dict[str, pa.Scalar]) -> Side:
            nonlocal held
            name, d = tile["tile"].as_py(), tile["size"].as_py()
            out = sides.pop(name, None)
            if out is None:
                x = np.frombuffer(tile["data"].as_buffer(), kind).reshape(-1, d).copy()
                out = _side(x, axes if d == len(axes) else None)
                held += out.bytes
            sides[name] = out  # the last is the one used last
            while held > HELD and len(sides) > 1:
                held -= sides.pop(next(iter(sides))).bytes
            return out

        def compare(tile_a: dict[str, pa.Scalar], tile_b: dict[str, pa.Scalar]) -> None:
            own = tile_a["tile"] == tile_b["tile"]
            a, b = side(tile_a), side(tile_b)
            (at_a, links_a), (at_b, links_b) = (found.tile(t["tile"].as_py(), t["ids"].values) for t in (tile_a, tile_b))
            for p in range(0, len(a.x), STRIP):
                for q in range(p if own else 0, len(b.x), STRIP):
                    same = own and p == q
                    linked = _linked(a.cut(p), b.cut(q), threshold)
                    if isinstance(linked, tuple):
                        i, j = linked
                        if same:
                            i, j = i[i != j], j[i != j]
                        if not len(i):
                            continue
                        counts = np.bincount(i), np.bincount(j)
                    else:
                        if same:
                            np.fill_diagonal(linked, False)
                        counts = np.count_nonzero(linked, axis=1), np.count_nonzero(linked, axis=0)
                        i, j = _spanning(linked)
                    links_a[p : p + len(counts[0])] += counts[0]
                    if not same:
                        links_b[q : q + len(counts[1])] += counts[1]
                    found.add(i + p + at_a, j + q + at_b)

        for batch in batches:
            for k in range(batch.num_rows):
                own = batch.column("shelf_a")[k] == batch.column("shelf_b")[k]
                left, right = (_tiles(batch.column(f"tiles_{s}")[k]) for s in "ab")
                for n, m in _neighbours(left, right).tolist():
                    if not own or n <= m:
                        compare({c: v[n] for c, v in left.items()}, {c: v[m] for c, v in right.items()})
        yield from found.result()

    return run


@contextmanager
def received(spark: SparkSession, size: str = RECEIVED) -> Iterator[None]:
    """Arrow batches of at most about so many bytes in the block, and of the session's size after it."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of `vectors` (vec_id, embedding)."""
    rows = usable(vectors)
    common = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    out = vectors.select("vec_id")
    if common is None:
        return out.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    axes = principal_axes(rows, common.d)
    id_kind = rows.schema["id"].dataType.simpleString()
    width = float(np.sqrt(2 - 2 * threshold)) * (1 + 1e-9)  # linked unit vectors are no farther apart
    shelf = staged(shelves(rows, axes, width, tile))
    left, right = (shelf.select(*(F.col(c).alias(f"{c}_{s}") for c in shelf.columns)) for s in "ab")
    work = left.join(right.hint("shuffle_replicate_nl"), F.col("shelf_a") <= F.col("shelf_b"))
    kind = "float32" if isinstance(rows.schema["x"].dataType.elementType, FloatType) else "float64"
    found = work.mapInArrow(_compared(axes, threshold, kind), f"u {id_kind}, v {id_kind}, n long")
    with received(vectors.sparkSession):
        found = staged(found.groupBy("u", "v").agg(F.sum("n").alias("n")))
    links = found.groupBy(F.col("u").alias("u_")).agg(F.sum("n").alias("n_links"))
    linked = components(found.select("u", "v"))
    component = F.coalesce(F.col("component"), F.col("vec_id"))
    return (
        out.join(links, F.col("vec_id") == F.col("u_"), "left")
        .join(linked, F.col("vec_id") == F.col("node"), "left")
        .select(
            "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
            component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"),
        )
    )


def op3_vector_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "embeddings"))
