"""Totals beyond 32 bits come back whole."""

import numpy as np
import pyarrow as pa

from rowproof.llm import counts


def test_totals_over_32_bits_are_not_clipped():
    keys = np.array([3, 9, 2**63 + 5], np.uint64)
    each = [np.array([3 * 10**9, 1, 0]), np.array([2**32 - 1, 2, 2**40])]
    asked = pa.RecordBatch.from_pydict(
        {
            "key": pa.array([0, 0]), "block": pa.array([0, 1]), "kind": pa.array([0, 1]),
            "keys": [counts.pack_sorted(keys)] * 2, "counts": [counts.pack_counts(c) for c in each],
        }
    )
    got = {r["block"]: r for b in counts._answer(iter([asked])) for r in b.to_pylist()}
    full, base = [int(a + b) for a, b in zip(*each, strict=True)], each[0].tolist()
    assert counts.unpack_counts(got[0]["full"]).tolist() == full
    assert counts.unpack_counts(got[1]["full"]).tolist() == full
    assert counts.unpack_counts(got[1]["base"]).tolist() == base
    assert got[-1]["sums"] == [3, sum(full), 2, sum(base)]
