"""Substring and suffix dedup against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from daygrain.llm import repeats, substring_dedup, suffix_dedup

from corpus import corpus, odd_rows, prose


def by_words(rows, size):
    """Kept words of each row, in order of (doc_id, position); null ids first."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, i))
    seen, out = set(), [None] * len(rows)
    for i in order:
        words = (rows[i][1] or "").encode().split()
        gone = [False] * len(words)
        for a in range(len(words) - size + 1):
            window = tuple(words[a : a + size])
            if window in seen:
                gone[a : a + size] = [True] * size
            seen.add(window)
        out[i] = (len(words), sum(gone), hashlib.sha256(b" ".join(w for w, g in zip(words, gone) if not g)).hexdigest())
    return out


def by_bytes(rows, size):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[a : a + size] for t in texts for a in range(len(t) - size + 1))
    out = []
    for t in texts:
        gone = [False] * len(t)
        for a in range(len(t) - size + 1):
            if seen[t[a : a + size]] > 1:
                gone[a : a + size] = [True] * size
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def results(df, *names):
    return sorted(df.collect(), key=lambda r: r["row_key"]) and [
        tuple(r[n] for n in names) for r in sorted(df.collect(), key=lambda r: r["row_key"])
    ]


def fixture(seed):
    rows = corpus(seed, n=40) + odd_rows()
    long = prose(random.Random(seed), 3000)
    return [*rows, (2000, long), (2001, long[5000:9000] + " the end"), (2002, "ab" * 700), (2003, "abc" * 500)]


@pytest.mark.parametrize("seed", [1, 2])
def test_words_match_brute_force(spark, documents, seed, monkeypatch):
    rows = fixture(seed)
    df = documents(rows).coalesce(1)
    out = substring_dedup.remove_repeats(df, size=20, with_text=True)
    assert out.columns[: len(df.columns) - 1] == ["doc_id", "kept", "score", "row_key"]
    got = results(out, "n_units", "n_removed", "kept_sha256")
    assert got == by_words(rows, 20)
    for r in out.collect():
        assert (r.text is None) == (rows[r.row_key][1] is None)
        assert r.n_removed == sum(s.end - s.start for s in r.spans)
        assert r.text is None or hashlib.sha256(r.text.encode()).hexdigest() == r.kept_sha256


@pytest.mark.parametrize("seed,limit", [(1, 16 << 20), (3, 1200)])
def test_bytes_match_brute_force(spark, documents, seed, limit, monkeypatch):
    """Also with anchors of more than two contents or so left to the counted windows."""
    monkeypatch.setattr(suffix_dedup, "ANCHOR_BYTES", limit)
    rows = fixture(seed)
    out = suffix_dedup.remove_repeats(documents(rows).coalesce(1), size=400)
    got = results(out, "n_units", "n_removed", "n_spans", "kept_sha256")
    assert got == by_bytes(rows, 400)
    assert sum(r[1] for r in got) > 0


def test_short_windows_and_segments(spark, documents, monkeypatch):
    """Documents cut into many segments give the same runs of windows."""
    rng = np.random.default_rng(5)
    text = bytes(rng.integers(97, 99, 900).astype(np.uint8))
    units = repeats.byte_units(text)
    whole = repeats.runs_of(units, 30, 8)
    monkeypatch.setattr(repeats, "SEGMENT", 64)
    cut = repeats.runs_of(units, 30, 8)
    assert whole.count.sum() == cut.count.sum() == 871
    anchors = lambda r: np.repeat(r.anchor, r.count)
    assert (anchors(whole) == anchors(cut)).all()
    places = np.arange(871)
    assert len(set(repeats.window_hashes(units, 30, places).tolist())) == len({text[i : i + 30] for i in range(871)})


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert substring_dedup.remove_repeats(empty).collect() == []
    assert suffix_dedup.remove_repeats(empty).collect() == []


@pytest.mark.parametrize("alphabet,bucket", [(2, 1 << 18), (26, 50), (1, 50)])
def test_suffixes_are_in_order(alphabet, bucket, monkeypatch):
    """Long ties, resolved by the ranks of the cover's sample."""
    monkeypatch.setattr(suffix_dedup, "BUCKET", bucket)
    rng = random.Random(alphabet)
    text = "".join(chr(97 + rng.randrange(alphabet)) for _ in range(900)).encode()
    text = text[:300] + text[:300] + text[100:400] + text[300:]
    suffixes = suffix_dedup.Suffixes(text, 4096)
    places = np.arange(len(text))
    got = np.concatenate(list(suffixes.ordered(places)))
    padded = text + bytes(8192)
    assert [padded[i : i + 2000] for i in got] == sorted(padded[i : i + 2000] for i in places)


def test_cover_meets_every_difference():
    cover = set(suffix_dedup.COVER.tolist())
    for i in range(suffix_dedup.PERIOD):
        for j in range(suffix_dedup.PERIOD):
            d = suffix_dedup.SHIFT[i, j]
            assert (i + d) % suffix_dedup.PERIOD in cover and (j + d) % suffix_dedup.PERIOD in cover
