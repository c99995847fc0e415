"""The number of matches kept per value is a parameter; None keeps all."""

import pytest

from rowproof.operators import fuzzy
from tests.test_fuzzy import made_up, set_score, sort_score


def all_pairs(values, threshold, keep):
    found = set()
    for name, score in (("token_sort_ratio", sort_score), ("token_set_ratio", set_score)):
        for v in values:
            best = sorted((-score(v, m), m) for m in values)[:keep]
            found |= {(name, v, m, -s) for s, m in best if -s >= threshold and v < m}
    return found


@pytest.mark.parametrize("keep", [2, None])
def test_kept_matches_equal_all_pairs(spark, keep):
    values = made_up(3, 40) + [f"Same Name{'.' * i}" for i in range(8)]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    rows = [tuple(r) for r in fuzzy.fuzzy_matches(df, "v", 70, keep=keep).collect()]
    assert len(rows) == len(set(rows)) and set(rows) == all_pairs(values, 70, keep)
    assert fuzzy.multi_fuzzy_matches(df, ["v"], 70, keep).count() > 0
