"""Exact quantiles with linear interpolation, for tables of any size.

Spark's `percentile` is exact but keeps one entry per distinct value in a single task. It is used
while the counted rows bound that memory. Beyond the bound the wanted order statistics are found
by narrowing: every pass counts rows around a bracket and asks a bounded sketch for a smaller
bracket. Counts decide, the sketch only guides, so the answer is exact and no pass shuffles more
than a few numbers per column.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import floor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowproof.operators.columns import number, ref

# Values that `percentile` may hold in one task, over all columns of one aggregate.
MAX_VALUES_IN_TASK = 1_000_000
# Error bound of the guiding sketch: its rank is off by at most rows / SKETCH_ACCURACY.
SKETCH_ACCURACY = 10_000
# Rows of all brackets together that may be fetched once they are known to be this few.
MAX_FETCHED = 20_000


@dataclass(frozen=True)
class _Bracket:
    """The `inside` rows strictly between `low` and `high`; `below` rows are smaller or equal `low`."""

    column: str
    low: float | None
    high: float | None
    below: int
    inside: int
    ranks: tuple[int, ...]

    def values(self) -> Column:
        """The column inside the bracket, null outside."""
        x = ref(self.column)
        cond = x.isNotNull()
        if self.low is not None:
            cond = cond & (x > F.lit(self.low))
        if self.high is not None:
            cond = cond & (x < F.lit(self.high))
        return F.when(cond, x)

    def shares(self) -> list[float]:
        """Where to cut the bracket: closely around every wanted rank."""
        margin = 2 / SKETCH_ACCURACY
        cuts: list[float] = []
        for rank in self.ranks:
            share = (rank - self.below + 0.5) / self.inside
            for cut in (share - margin, share + margin):
                if not cuts or cut - cuts[-1] > margin / 2:
                    cuts.append(cut)
        return [min(max(cut, 0.0), 1.0) for cut in cuts]


def quantile_values(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    max_values_in_task: int = MAX_VALUES_IN_TASK,
) -> dict[str, Column]:
    """Per column an array column of its quantiles: an aggregate, or literals found by narrowing.

    Either form can be used inside `df.agg`. Columns must be numeric; nulls and NaN are ignored.
    """
    columns = list(dict.fromkeys(columns))
    if not columns or df.count() * len(columns) <= max_values_in_task:
        return {c: F.percentile(number(c), list(probabilities)) for c in columns}
    found = _narrow(df.select(*(number(c).alias(c) for c in columns)),
                    columns, probabilities)
    return {
        c: F.array(*(F.lit(v).cast("double") for v in values)) for c, values in found.items()
    }


def _narrow(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]
) -> dict[str, list[float | None]]:
    sizes = df.agg(*(F.count(ref(c)).alias(c) for c in columns)).first()
    positions = {c: [p * (sizes[c] - 1) for p in probabilities] for c in columns}
    found: dict[tuple[str, int], float] = {}
    brackets = []
    for c in columns:
        ranks = {r for pos in positions[c] for r in (floor(pos), min(floor(pos) + 1, sizes[c] - 1))}
        if sizes[c]:
            brackets.append(_Bracket(c, None, None, 0, sizes[c], tuple(sorted(ranks))))
    while brackets:
        if sum(b.inside for b in brackets) <= MAX_FETCHED:
            _fetch(df, brackets, found)
            break
        brackets = _cut(df, brackets, found)

    def interpolate(c: str, pos: float) -> float | None:
        if not sizes[c]:
            return None
        lower = floor(pos)
        a, b = found[c, lower], found[c, min(lower + 1, sizes[c] - 1)]
        return a if pos == lower else (lower + 1 - pos) * a + (pos - lower) * b

    return {c: [interpolate(c, pos) for pos in positions[c]] for c in columns}


def _fetch(df: DataFrame, brackets: Sequence[_Bracket], found: dict) -> None:
    """Read off the ranks from the few values that are left."""
    lists = df.agg(
        *(F.array_sort(F.collect_list(b.values())).alias(f"b{i}") for i, b in enumerate(brackets))
    ).first()
    for i, b in enumerate(brackets):
        for rank in b.ranks:
            found[b.column, rank] = lists[f"b{i}"][rank - b.below]


def _cut(df: DataFrame, brackets: Sequence[_Bracket], found: dict) -> list[_Bracket]:
    """One sketch job proposes edges inside the brackets, one count job decides what they hold.

    Edges are values of the bracket, and brackets are open, so every pass leaves fewer rows.
    """
    sketches = df.agg(
        *(
            F.percentile_approx(b.values(), b.shares(), SKETCH_ACCURACY).alias(f"b{i}")
            for i, b in enumerate(brackets)
        )
    ).first()
    edges = [sorted(set(sketches[f"b{i}"])) for i in range(len(brackets))]

    counts = []
    for i, b in enumerate(brackets):
        x = b.values()
        bounds = [None, *edges[i], None]
        for j, (low, high) in enumerate(zip(bounds, bounds[1:])):
            gap = x.isNotNull()
            gap = gap if low is None else gap & (x > F.lit(low))
            gap = gap if high is None else gap & (x < F.lit(high))
            counts.append(F.count_if(gap).alias(f"gap{i}_{j}"))
            if high is not None:
                counts.append(F.count_if(x == F.lit(high)).alias(f"at{i}_{j}"))
    row = df.agg(*counts).first()

    left = []
    for i, b in enumerate(brackets):
        bounds = [b.low, *edges[i], b.high]
        below = b.below
        for j, (low, high) in enumerate(zip(bounds, bounds[1:])):
            inside = row[f"gap{i}_{j}"]
            ranks = tuple(r for r in b.ranks if below <= r < below + inside)
            if ranks:
                left.append(_Bracket(b.column, low, high, below, inside, ranks))
            below += inside
            if j < len(edges[i]):
                at = row[f"at{i}_{j}"]
                found |= {(b.column, r): high for r in b.ranks if below <= r < below + at}
                below += at
    return left
