import numpy as np
import pytest

from rowproof.llm import vectors
from rowproof.llm.components import components


def brute(rows, threshold):
    good = [
        (i, k, np.array(x, float)) for k, (i, x) in enumerate(rows)
        if i is not None and x and all(v is not None and np.isfinite(v) for v in x) and any(x)
    ]
    links, group = {}, {i: i for i, _ in rows}

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for n, (i, _, x) in enumerate(good):
        for j, _, y in good[:n]:
            if len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                links[i], links[j] = links.get(i, 0) + 1, links.get(j, 0) + 1
                a, b = find(i), find(j)
                group[max(a, b)] = min(a, b)
    return {i: (links.get(i, 0), find(i) if i is not None else None) for i, _ in rows}


@pytest.mark.parametrize("tile", [4096, 20])
def test_equals_brute_force(spark, tile):
    r = np.random.default_rng(2)
    base = r.normal(size=(60, 40))
    rows = [(i, list(map(float, x))) for i, x in enumerate(base)]
    for i in range(60, 200):  # copies, near copies, chains, other lengths of vector
        x = base[i % 12] * r.uniform(0.1, 9) + r.normal(size=40) * r.choice([0, 0.1, 0.2, 0.3, 0.5])
        rows.append((i, list(map(float, x))))
    rows += [(200, None), (201, []), (202, [0.0] * 40), (203, [float("nan")] * 40), (204, [None] + rows[0][1][1:])]
    rows += [(205, [float("inf")] + rows[0][1][1:]), (206, [1.0]), (207, [5.0]), (208, [-1.0]), (209, [1.0, 2.0]), (210, [1e-300, 2e-300])]
    rows.append((None, rows[0][1]))
    docs = spark.createDataFrame([(i, x, "x", 1) for i, x in rows], "vec_id long, embedding array<double>, n_links string, id int").repartition(4)
    got = {v.vec_id: (v.n_links, v.component_id) for v in vectors.near_duplicates(docs, tile=tile).collect()}
    assert got == brute(rows, vectors.THRESHOLD)


def test_bounds_stop_nothing_that_links():
    r = np.random.default_rng(4)
    a = r.normal(size=(80, 64))
    b = np.vstack([a[:40] + r.normal(size=(40, 64)) * 0.3, r.normal(size=(40, 64))])
    axes = np.linalg.qr(r.normal(size=(64, 64)))[0]
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    for few in (0.0, 1.0):
        vectors.FEW, before = few, vectors.FEW
        assert (vectors.close_pairs(a, b, axes, 0.9) == (unit(a) @ unit(b).T >= 0.9)).all()
        vectors.FEW = before


def test_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in vectors.near_duplicates(docs).collect())
    assert got == [(1, 2, 1, True), (1, 2, 1, True), (2, 0, 2, True)]
    assert vectors.near_duplicates(docs.limit(0)).count() == 0


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(200, 200), (129, 300), (5, 4)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in [*range(100, 130), 300]}}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_ids_of_type_int_and_many_equal_rows(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(300)] + [(300, [1.0, -2.0, 3.0])]
    docs = spark.createDataFrame(rows, "vec_id int, embedding array<float>").repartition(3)
    got = {v.vec_id: (v.n_links, v.component_id, v.kept) for v in vectors.near_duplicates(docs, tile=64).collect()}
    assert got == {i: (299, 0, i == 0) for i in range(300)} | {300: (0, 300, True)}


def shuffle_bytes(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f.getName(): f.length() for f in (files.apply(k) for k in range(files.size())) if f.getName().startswith("shuffle_")}


def test_pairs_of_tiles_are_not_shuffled(spark, monkeypatch):
    r = np.random.default_rng(7)
    x = r.normal(size=(600, 32)).astype(np.float32)
    x[500:] = x[:100] + r.normal(size=(100, 32)) * r.choice([0, 0.1, 0.3], size=(100, 1))
    rows = [(i, list(map(float, v))) for i, v in enumerate(x)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    before, seen = shuffle_bytes(spark), {}

    def watched(df, staged=vectors.staged):  # shuffle files go with the garbage of the driver
        out = staged(df)
        seen.update(shuffle_bytes(spark))
        return out

    monkeypatch.setattr(vectors, "staged", watched)
    found = vectors.near_duplicates(docs, tile=10)
    moved = sum(n for name, n in seen.items() if name not in before)
    assert {v.vec_id: (v.n_links, v.component_id) for v in found.collect()} == brute(rows, vectors.THRESHOLD)
    assert moved < 10 * x.nbytes


def test_cosines_at_the_threshold_are_told_in_double():
    r = np.random.default_rng(8)
    axes = np.linalg.qr(r.normal(size=(48, 48)))[0]
    base = np.linalg.qr(r.normal(size=(48, 2)))[0].T
    cosines = 0.95 + np.array([s * 10.0**-k for k in range(4, 13) for s in (-1, 1)])
    a = np.vstack([base[0] * 3, r.normal(size=(9, 48))])
    b = (cosines[:, None] * base[0] + np.sqrt(1 - cosines[:, None] ** 2) * base[1]) * r.uniform(0.1, 9, size=(len(cosines), 1))
    want = (a @ b.T / np.sqrt((a * a).sum(1)[:, None] * (b * b).sum(1))) >= 0.95
    for few in (0.0, 0.02, 1.0):
        vectors.FEW, before = few, vectors.FEW
        assert (vectors.close_pairs(a, b, axes, 0.95) == want).all()
        vectors.FEW = before


def test_spanning_pairs_connect_what_all_connect():
    r = np.random.default_rng(9)
    for share in (0.002, 0.02, 0.3, 1.0):
        found = r.random((70, 50)) < share
        i, j = np.nonzero(found)
        k, m = vectors._spanning(found)
        assert found[k, m].all()
        assert (vectors._forest(i, j + 70, 120) == vectors._forest(k, m + 70, 120)).all()
