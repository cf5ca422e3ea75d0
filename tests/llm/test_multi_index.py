"""Nearest neighbours against brute force: recall, and exact results where all cells are met."""

import math

import numpy as np
import pytest

from daygrain.llm import multi_index as mi

SCHEMA = "vec_id long, embedding array<float>, label int, score string, rank string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "own", "own") for i, v in rows], SCHEMA)


def brute(rows, every, k=10):
    """{(position of the query's row): [(vec_id, distance)]}"""
    sound = [(n, i, np.array(v, np.float32).astype(float)) for n, (i, v) in enumerate(rows)
             if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for n, i, q in sound:
        if i is not None and i % every == 0:
            found = [(math.sqrt(((x - q) ** 2).sum()), j is None, j or 0, j) for m, j, x in sound if m != n and len(x) == len(q)]
            out[n] = (i, [(f[3], f[0]) for f in sorted(found, key=lambda f: f[:3])[:k]])
    return out


def cloud(seed, n, dim, spread):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((10, dim))
    return [(i, [float(np.float32(x)) for x in centres[rng.integers(10)] + spread * rng.standard_normal(dim)]) for i in range(n)]


def compare(got, rows, every, k=10):
    """The share of the true neighbours that were found; ranks and scores must be right in themselves."""
    want, found = brute(rows, every, k), {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append(r)
    hits = total = 0
    for i, near in want.values():
        mine = found.get(i, [])
        assert len(mine) % max(1, len(near)) == 0 and (mine or not near)
        total += len(near)
        worst = near[-1][1] if near else 0
        hits += sum(r.score <= worst * (1 + 1e-12) for r in mine)
        own = [(r.score, r.vec_id is None, r.vec_id or 0) for r in mine]
        assert own == sorted(own)
    return hits / max(1, total)


ODD = [
    (None, 0), (3, 1), (800, 0), (801, 0), (801, 0), *[(900 + i, 5) for i in range(40)],
]


def odd(rows):
    v = rows[0][1]
    more = [(i, rows[j][1]) for i, j in ODD]
    return rows + more + [(300, None), (400, []), (500, [0.0] * len(v)), (600, [None, *v[1:]]), (700, [math.nan, *v[1:]]), (1000, v[:-1])]


@pytest.mark.parametrize("seed,dim,block", [(1, 16, 1024), (2, 5, 9), (3, 1, 1024)])
def test_all_cells_give_the_exact_result(spark, monkeypatch, seed, dim, block):
    real = mi.blocks
    monkeypatch.setattr(mi, "blocks", lambda sizes: real(sizes, block))
    rows = odd(cloud(seed, 200, dim, 0.3))
    got = mi.search(frame(spark, rows).repartition(3), queries="vec_id % 50 = 0", enough=10**9).collect()
    want = brute(rows, 50)
    expected = sorted((i, n + 1, j, d) for i, near in want.values() for n, (j, d) in enumerate(near))
    plain = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got)
    key = lambda r: (r[0], r[1], r[2] is None, r[2] or 0)
    for a, b in zip(sorted(plain, key=key), sorted(expected, key=key), strict=True):
        assert a[:3] == b[:3] and math.isclose(a[3], b[3], rel_tol=1e-12, abs_tol=1e-12)


@pytest.mark.parametrize("spread", [0.05, 0.5, 3.0])
def test_recall(spark, spread):
    rows = cloud(7, 3000, 32, spread)
    got = mi.search(frame(spark, rows), queries="vec_id % 20 = 0").collect()
    assert compare(got, rows, 20) >= 0.9


def test_far_fewer_entries_are_met_in_clusters():
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((60, 16))
    x = centres[rng.integers(60, size=4000)] + 0.02 * rng.standard_normal((4000, 16))
    left, right = mi.codebook(x[:, :8], 16), mi.codebook(x[:, 8:], 16)
    index = mi.Index(left, right, np.zeros(0, np.int64))
    index = mi.Index(left, right, np.bincount(index.cells(x), minlength=len(left) * len(right)))
    a, b = index.distances(x[:50])
    for q in range(50):
        cells = index.visited(a[q], b[q], 200)
        assert 200 <= index.sizes[cells].sum() < 4000
        sums = [a[q][c // len(right)] + b[q][c % len(right)] for c in cells]
        assert sums == sorted(sums)
        assert (index.needed(a[q], b[q], np.array(cells[-1:])) == index.sizes[cells].sum()).all()


def test_every_cell_is_met_once():
    rng = np.random.default_rng(3)
    sizes = rng.integers(0, 3, 7 * 9)
    index = mi.Index(np.zeros((7, 1)), np.zeros((9, 1)), sizes)
    cells = index.visited(rng.random(7), rng.random(9), 10**9)
    assert sorted(cells) == list(np.flatnonzero(sizes))


def test_blocks_hold_whole_cells_or_parts_of_large_ones():
    sizes = np.array([3, 0, 5, 25, 1, 9, 2, 0, 10])
    first, parts = mi.blocks(sizes, 10)
    assert parts.tolist() == [1, 0, 1, 3, 1, 1, 1, 0, 1]
    held = {}
    for cell, n in enumerate(sizes):
        for p in range(parts[cell]):
            held.setdefault(int(first[cell]) + p, []).append((cell, n))
    assert all(len(cells) == 1 or sum(n for _, n in cells) <= 10 for cells in held.values())
    assert not any(cell == 3 and len(cells) > 1 for cells in held.values() for cell, _ in cells)


def test_many_copies_and_few_rows(spark):
    v = [1.0, 2.0, 3.0]
    copies = mi.search(frame(spark, [(i, v) for i in range(300)]), queries="vec_id = 200").collect()
    assert [(r["rank"], r.vec_id, r.score) for r in copies] == [(i + 1, i, 0.0) for i in range(10)]
    few = mi.search(frame(spark, [(0, v), (1, [1.0, 2.0, 5.0]), (2, None)])).collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in few] == [(0, 1, 1, 2.0)]
    assert mi.search(frame(spark, [(0, v)])).collect() == []


def test_empty_table(spark):
    assert mi.search(frame(spark, [])).collect() == []
    assert mi.search(frame(spark, [(0, None), (1, [0.0])])).collect() == []
