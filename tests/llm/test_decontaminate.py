"""Benchmark decontamination against brute force."""

import hashlib
import random
import re

import pytest

from daygrain.llm import decontaminate

from corpus import odd_rows, prose

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def words(text):
    return WORD.findall((text or "").encode().translate(LOWER))


def brute(rows, items, size=13):
    windows = {}
    for item, text in items:
        w = words(text)
        m = min(size, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            windows.setdefault(tuple(w[i : i + m]), set()).add(item)
    out = []
    for _, text in rows:
        w = words(text)
        hit, found = [False] * len(w), set()
        for m in {len(k) for k in windows}:
            for i in range(len(w) - m + 1):
                if items_ := windows.get(tuple(w[i : i + m])):
                    found |= items_
                    hit[i : i + m] = [True] * m
        out.append((len(w), sum(hit), sorted(found, key=lambda i: (i is None, i or ""))))
    return out


@pytest.fixture
def fixture():
    rng = random.Random(6)
    items = [(f"b{i}", prose(rng, rng.choice([13, 14, 30, 60]))) for i in range(12)]
    items += [("short", "qua quo qui"), ("one", "Xylophon"), ("b0", items[1][1]), ("none", None), ("blank", " .,; "), (None, "lost words here")]
    rows = odd_rows()
    for i in range(30):
        text = prose(rng, rng.randint(5, 300))
        for _ in range(rng.randint(0, 3)):
            w = rng.choice(items[:12])[1].split(" ")
            cut = rng.randint(0, 5)
            passage = " ".join(w[cut : len(w) - rng.randint(0, 5)]).upper()
            at = rng.randrange(len(text))
            text = f"{text[:at]} -- {passage} -- {text[at:]}"
        rows.append((i, text))
    return [*rows, (500, "a xylophon, QUA-quo qui! lost words here"), (501, items[0][1] * 200)], items


@pytest.mark.parametrize("block", [64 << 20, 400])
def test_hits_match_brute_force(spark, documents, fixture, block):
    """Also with the benchmark in many blocks, and items longer than one."""
    rows, items = fixture
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    out = decontaminate.contamination(documents(rows), benchmark, block_bytes=block)
    out = out.withColumn("n_hit", decontaminate.n_hit()).withColumn("bad", decontaminate.contaminated())
    got = sorted(out.collect(), key=lambda r: r.row_key)
    assert [(r.n_words, r.n_hit, r.hit_items) for r in got] == brute(rows, items)
    assert [r.bad for r in got] == [h > 0 and 20 * h >= n for n, h, _ in brute(rows, items)]
    assert any(r.bad for r in got) and not all(r.bad for r in got)
    assert all(r.kept.startswith("own") for r in got)


def test_spans_are_cut_out(spark, documents, fixture):
    rows, items = fixture
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    found = decontaminate.contamination(documents(rows), benchmark)
    left = sorted(decontaminate.without_spans(found).collect(), key=lambda r: r.row_key)
    for r, (n, hit, _), (_, text) in zip(left, brute(rows, items), rows):
        assert (r.text is None) == (text is None)
        assert len(words(r.text)) == n - hit
        assert r.text == text or hit


def test_empty_tables(spark, documents):
    nothing = spark.createDataFrame([], "item_id long, text string")
    out = decontaminate.contamination(documents([(1, "a b"), (2, None)]), nothing).collect()
    assert [(r.n_words, r.hit_spans, r.hit_items) for r in out] == [(2, [], []), (0, [], [])]
    empty = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontaminate.contamination(empty, some).collect() == []


def test_query_digest(spark, tmp_path):
    spark.createDataFrame([(1, "x a b"), (2, "c")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(10, "a b"), (9, "b")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = {r.doc_id: r for r in decontaminate.query(spark, str(tmp_path)).collect()}
    assert rows[1].items_sha256 == hashlib.sha256(b"10,9").hexdigest() and rows[1].n_items == 2 and rows[1].contaminated
    assert rows[2].items_sha256 == hashlib.sha256(b"").hexdigest() and not rows[2].contaminated
