"""Product codes against a plain definition in Python's integers."""

import hashlib
import math

import numpy as np
import pytest

from daygrain.llm import code_lloyd as lloyd


def brute(rows, positions=4, entries=256, rounds=4, scale=1024):
    """{row: (codes, error)} of kept (key, vector, label) rows and the codebooks."""
    kept = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return [], {}
    width = len(kept[0][1]) // positions
    cut = [[[math.floor(scale * x) for x in r[1]][p * width : (p + 1) * width] for p in range(positions)] for r in kept]
    books = {p: [c[p] for c in cut[:entries]] for p in range(positions)}

    def assign(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p, book in books.items():
            members = {}
            for c in cut:
                members.setdefault(assign(c[p], book)[1], []).append(c[p])
            books[p] = [[sum(x) // len(x) for x in zip(*members[i])] if i in members else e for i, e in enumerate(book)]
    found = [[assign(c[p], books[p]) for p in range(positions)] for c in cut]
    return [(r[0], r[2], [i for _, i in f], sum(d for d, _ in f)) for r, f in zip(kept, found)], books


def vectors(seed, n, dim, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, dim))
    rows = []
    for i in range(n):
        v = centres[rng.integers(6)] + 0.2 * rng.standard_normal(dim)
        rows.append((i, [float(np.float32(x * spread)) for x in v], int(rng.integers(3))))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "own", 3) for r in rows], "vec_id long, embedding array<double>, label int, error string, salt int")


def odd(rows, dim):
    v = rows[0][1]
    return rows + [
        (None, rows[1][1], None), (5, rows[2][1], 1), (900, None, 0), (901, [], 0), (902, [0.0] * dim, None),
        (903, [None, *v[1:]], 0), (904, [math.nan, *v[1:]], 0), (905, [-math.inf, *v[1:]], 0), (906, v[:-1], 0),
        (907, v + v, 0), *[(1000 + i, v, 2) for i in range(60)],
    ]


@pytest.mark.parametrize("seed,n,dim,entries,spread", [(1, 120, 8, 16, 1.0), (2, 60, 4, 256, 1.0), (3, 90, 12, 7, 1e9)])
def test_codes_match_brute_force(spark, seed, n, dim, entries, spread):
    rows = odd(vectors(seed, n, dim, spread), dim)
    made = lloyd.compress(frame(spark, rows).repartition(5), entries=entries)
    want, books = brute([r for r in rows if r[1] is None or len(r[1]) == dim], entries=entries)
    assert made.codebooks == books
    got = [(r.vec_id, r.label, r.entries, r.error) for r in made.codes.collect()]
    order = lambda r: (r[0] is None, r[0] or 0, str(r[1:]))
    assert sorted(got, key=order) == sorted([(*w[:3], min(w[3], lloyd.MOST_LONG)) for w in want], key=order)


def test_query_columns(spark, tmp_path):
    rows = odd(vectors(4, 80, 8), 8)
    frame(spark, rows).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = lloyd.query(spark, str(tmp_path)).collect()
    want, books = brute([r for r in rows if r[1] is None or len(r[1]) == 8])
    by_label = {}
    for _, label, _, error in want:
        by_label[label] = by_label.get(label, 0) + error
    numbers = ",".join(str(x) for p in range(4) for e in books[p] for x in e)
    sha = hashlib.sha256(numbers.encode()).hexdigest()
    expected = [(k, "".join(f"{i:02x}" for i in c), e, by_label[label], sha) for k, label, c, e in want]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))


def test_label_error_of_hot_and_rare_labels(spark, monkeypatch):
    codes = spark.createDataFrame([(i, i % 3 if i < 40 else None, i) for i in range(60)], "vec_id long, label int, error long")
    want = {label: sum(i for i in range(60) if (i % 3 if i < 40 else None) == label) for label in (0, 1, 2, None)}
    for share in (0.0, 0.25, 1.0):
        monkeypatch.setattr(lloyd, "HOT_SHARE", share)
        got = lloyd.with_label_error(codes).collect()
        assert len(got) == 60 and all(r.label_error == want[r.label] for r in got)


def test_only_rows_that_change_entry_are_dealt_anew(spark):
    rows = frame(spark, vectors(5, 200, 8))
    whole = lloyd._whole(rows, "vec_id", "embedding", "label", 1024, 4)
    books = lloyd._first_entries(whole, 4, 8)
    parts = whole.selectExpr("row_key", "posexplode(array(slice(v,1,2),slice(v,3,2),slice(v,5,2),slice(v,7,2))) AS (position, part)", "-1 AS entry", "0 AS salt")
    members = lloyd._settled(parts, books)
    again = lloyd._settled(members, books)
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    arrived = [f for f in again.inputFiles() if "arrived" in f]
    assert spark.read.parquet(*arrived).count() == 0  # the same entries: nobody moves
    assert again.count() == members.count() == 800


def test_empty_table(spark, tmp_path):
    frame(spark, []).write.parquet(str(tmp_path / "embeddings.parquet"))
    assert lloyd.query(spark, str(tmp_path)).collect() == []
    frame(spark, [(1, None, 0)]).write.parquet(str(tmp_path / "n" / "embeddings.parquet"))
    assert lloyd.query(spark, str(tmp_path / "n")).collect() == []
