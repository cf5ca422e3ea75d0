"""The Jaccard join against brute force over all pairs."""

import random

import numpy as np
import pytest

from daygrain.llm import jaccard_join as join

from corpus import corpus, odd_rows, prose, word


def shingle_set(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    """(n_shingles, component_id, kept) of each row."""
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(i)
    out = [None] * len(rows)
    for members in groups.values():
        least = min((rows[i][0] for i in members if rows[i][0] is not None), default=None)
        first = min(members, key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, i))
        for i in members:
            out[i] = (len(sets[i]), least, i == first)
    return out


def near_threshold(rng, n):
    """Pairs of texts of n words whose similarity lies about 4/5, on both sides and on it."""
    out = []
    for changed in range(0, n // 8):
        words = [word(rng) + str(i) for i in range(n)]
        other = list(words)
        for i in range(changed):
            other[-1 - i] = f"new{i}"
        out += [" ".join(words), " ".join(other)]
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_match_brute_force(spark, documents, seed):
    rng = random.Random(seed)
    texts = near_threshold(rng, 9) + near_threshold(rng, 40) + near_threshold(rng, 100)
    rows = corpus(seed) + odd_rows() + [(3000 + i, t) for i, t in enumerate(texts)] + [(4000, prose(rng, 4000))]
    out = join.near_duplicates(documents(rows).coalesce(1), with_text=True)
    got = sorted(out.collect(), key=lambda r: r.row_key)
    assert [(r.doc_id, r.text) for r in got] == rows
    assert [(r.n_shingles, r.component_id, r.kept) for r in got] == brute(rows)


def test_chains_link_transitively(spark, documents):
    rng = random.Random(4)
    words = [word(rng) + str(i) for i in range(200)]
    rows = []
    for i in range(12):
        rows.append((100 - i, " ".join(words)))
        words = words[8:] + [f"step{i}x{j}" for j in range(8)]
    out = join.near_duplicates(documents(rows)).collect()
    assert {r.component_id for r in out} == {89}
    assert brute(rows)[0][1] == 89


def test_empty_table(spark):
    assert join.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_linked_sets_share_a_key(seed):
    """Whatever the sizes: sets on the edge of the threshold have a key in common."""
    rng = np.random.default_rng(seed)
    for size in [1, 2, 3, 4, 5, 6, 7, 8, 9, 12, 20, 50, 333]:
        base = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        for add in range(len(base) // 4 + 1):
            for drop in range(len(base) // 5 + 1):
                other = np.unique(np.concatenate([base[drop:], rng.integers(0, 2**63, add).astype(np.uint64)]))
                if join.linked(base, other):
                    assert np.intersect1d(join.keys(base), join.keys(other)).size, (size, add, drop)


@pytest.mark.parametrize("seed", range(4))
def test_tree_loses_no_pair(seed):
    rng = np.random.default_rng(seed)
    centres = [np.unique(rng.integers(0, 2**63, n).astype(np.uint64)) for n in (30, 200, 900)]
    sets = []
    for _ in range(150):
        c = centres[rng.integers(3)]
        keep = rng.random(len(c)) > rng.choice([0, 0.03, 0.1, 0.3])
        sets.append(np.unique(np.concatenate([c[keep], rng.integers(0, 2**63, rng.integers(1, 20)).astype(np.uint64)])))
    points = join.folded([join.counts(s).tobytes() for s in sets])
    parts = rng.integers(0, 40, len(sets))
    a, b = join.CountTree(points, np.array([len(s) for s in sets]), parts).pairs()
    got = {(min(x, y), max(x, y)) for x, y in zip(a.tolist(), b.tolist())}
    assert len(got) == len(a)
    want = {(i, j) for j in range(150) for i in range(j) if parts[i] != parts[j] and join.linked(sets[i], sets[j])}
    assert want and want <= got


def test_near_copies_that_miss_their_hub_give_no_row_a_pair(spark, documents, monkeypatch):
    """The first documents have parts of the copies' text and so are the hubs of its keys, but link with none."""
    rng = random.Random(5)
    base = [word(rng) + str(i) for i in range(110)]
    texts = []
    for i in range(60):
        words, at = list(base), 8 * i % 95
        words[at : at + 15] = [f"part{i}x{j}" for j in range(15)]
        texts.append(" ".join(words))
    for i in range(300):
        words = list(base)
        words[rng.randrange(110)] = f"copy{i}"
        texts.append(" ".join(words))
    rows = list(enumerate(texts))
    made = {}

    def counted(df, name, staged=join.staged):
        out = staged(df, name)
        made[name] = made.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(join, "staged", counted)
    out = join.near_duplicates(documents(rows).coalesce(1)).collect()
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in out}
    assert [got[i] for i, _ in rows] == brute(rows)
    assert len({c for _, c, _ in got.values()}) < 70
    assert made["links"] < made["stars"]


@pytest.mark.parametrize("seed", range(4))
def test_forest_joins_what_links(seed):
    rng = np.random.default_rng(seed)
    base = [np.unique(rng.integers(0, 2**63, n).astype(np.uint64)) for n in (40, 44, 300, 5000)]
    sets = []
    for _ in range(300):
        c = base[rng.integers(4)]
        keep = rng.random(len(c)) > rng.choice([0, 0.04, 0.1, 0.2])
        sets.append(np.unique(np.concatenate([c[keep], rng.integers(0, 2**63, rng.integers(1, 9)).astype(np.uint64)])))
    parts = rng.integers(0, 200, len(sets))

    def groups(pairs):
        root = parts.copy()
        for i, j in pairs:
            root[root == root[j]] = root[i]
        return {tuple(np.flatnonzero(root == r)) for r in root}, len(np.unique(root))

    links = [(i, j) for j in range(len(sets)) for i in range(j) if join.linked(sets[i], sets[j])]
    got = join.forest(sets, parts)
    assert groups(got) == groups(links)
    assert len(got) == len(np.unique(parts)) - groups(links)[1]
