"""Embedding near-dedup against brute force, and the codes' bounds."""

import math

import numpy as np
import pytest

from daygrain.llm import embedding_dedup as dedup


def brute(rows, threshold):
    """{row: (n_links, component)} of (key, vector, label) rows."""
    usable = {}
    for i, (_, v, label) in enumerate(rows):
        if label is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        usable[i] = np.array(v, float) / np.linalg.norm(np.array(v, float))
    n, root = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in usable:
        for j in usable:
            if j < i and rows[i][2] == rows[j][2] and len(usable[i]) == len(usable[j]) and usable[i] @ usable[j] >= threshold:
                n[i] += 1
                n[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i, (key, _, _) in enumerate(rows):
        least.setdefault(find(i), []).append(key)
    out = []
    for i, (key, _, _) in enumerate(rows):
        known = [k for k in least[find(i)] if k is not None]
        component = min(known) if known else None
        out.append((key, n[i], component, component is not None and component == key))
    return out


def clusters(seed, dim, n):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, dim))
    rows = []
    for i in range(n):
        v = centres[rng.integers(12)] + rng.standard_normal(dim) * rng.choice([0.1, 0.25, 0.3, 1.0])
        rows.append((i, [float(np.float32(x)) for x in v * rng.choice([1, 30])], int(rng.integers(3))))
    return rows


@pytest.mark.parametrize("seed,dim,block", [(1, 16, 2048), (2, 64, 20), (3, 3, 7)])
def test_links_match_brute_force(spark, seed, dim, block):
    rows = clusters(seed, dim, 160)
    v = rows[0][1]
    rows += [(200 + i, v, 0) for i in range(30)]
    rows += [
        (300, None, 0), (301, [], 0), (302, [0.0] * dim, 0), (303, [None, *v[1:]], 0), (304, [math.nan, *v[1:]], 0),
        (305, [math.inf, *v[1:]], 0), (306, v, None), (307, v[:-1], 0), (308, [-x for x in v], 0), (309, [x * 1e-30 for x in v], 0),
        (0, rows[3][1], rows[3][2]), (None, v, 0), (None, None, None),
    ]
    df = spark.createDataFrame([(*r, "own") for r in rows], "vec_id long, embedding array<double>, label int, kept string")
    got = [tuple(r) for r in dedup.near_duplicates(df.coalesce(1), block=block).collect()]
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2] or 0)
    assert sorted(got, key=order) == sorted(brute(rows, 0.93), key=order)


@pytest.mark.parametrize("seed", range(6))
def test_forest_joins_what_the_links_join(seed):
    rng = np.random.default_rng(seed)
    n, m = rng.integers(1, 30, 2)
    i, j = np.nonzero(rng.random((n, m)) < rng.choice([0.0, 0.03, 0.1, 0.9]))
    row, column = dedup.forest(i, j, n, m)
    assert set(zip(row.tolist(), column.tolist())) <= set(zip(i.tolist(), j.tolist()))

    def parts(rows, columns):
        root = list(range(n + m))

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in zip(rows, columns):
            root[find(a)] = find(n + b)
        found = [find(x) for x in range(n + m)]
        return [[a == b for b in found] for a in found], len(set(found))

    both, number = parts(row, column)
    assert both == parts(i, j)[0] and len(row) == n + m - number


def test_a_group_of_near_copies_has_no_row_per_link(spark):
    rng = np.random.default_rng(9)
    rows = [(i, (np.ones(8) + 0.01 * rng.standard_normal(8)).tolist(), 0) for i in range(200)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    classes = vectors.selectExpr("label", "size(embedding) AS dim", "embedding AS v", "1L AS n", "vec_id AS class")
    found = dedup._compared(dedup._blocks(classes.coalesce(1), 64), 0.93)
    pairs = 4 * 5 // 2  # of blocks, each with two rows a class at most; 19,900 links
    assert found.count() <= pairs * 2 * (64 + 64)
    got = dedup.near_duplicates(vectors, block=64).collect()
    assert all((r.n_links, r.component_id) == (199, 0) for r in got)


def test_huge_and_tiny_components(spark):
    rows = [(1, [1e200, 2e200], 0), (2, [1e-200, 2e-200], 0), (3, [1e200, -2e200], 0)]
    got = dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == {1: (1, 1), 2: (1, 1), 3: (0, 3)}


def test_empty_table(spark):
    assert dedup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).collect() == []


@pytest.mark.parametrize("dim", [2, 7, 64])
def test_bounds_are_certain_and_estimates_unbiased(dim):
    rng = np.random.default_rng(dim)
    a, b = (dedup.units(rng.standard_normal((300, dim))) for _ in range(2))
    b[:100] = dedup.units(a[:100] + 0.1 * rng.standard_normal((100, dim)))
    codes = dedup.Codes(b)
    estimate, low, high = codes.estimate(a)
    exact = a @ b.T
    assert (low <= exact).all() and (exact <= high).all()
    assert abs((estimate - exact).mean()) < 0.05
    assert (codes.products(a)[exact >= 0.93] >= np.broadcast_to(codes.least(0.93), exact.shape)[exact >= 0.93]).all()


def test_most_pairs_need_no_exact_product():
    rng = np.random.default_rng(5)
    a = dedup.units(rng.standard_normal((400, 64)))
    codes = dedup.Codes(a)
    assert (codes.products(a) >= codes.least(0.93)).mean() < 0.01
