"""Benchmark decontamination: broadcast hash sets of test n-grams, scanned over every document.

Words are normalised to lower-case runs of digits, letters and non-ASCII characters. A
window is ``size`` consecutive words of a benchmark item; an item of fewer words is one
window. Items travel in blocks of bounded size (``block_bytes``): one broadcast and one
pass over the documents for each block, so that no broadcast grows with the benchmark.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.llm.common import as_bytes, code_words, table, with_columns

WINDOW = 13
BLOCK_BYTES = 64 << 20
#: An odd multiplier for rolling hashes modulo 2^64, and the bits of the first filter.
BASE, FILTER_BITS = np.uint64(0x9E3779B97F4A7C15), 20


class Windows:
    """The windows of a block of items, by size: hashes to scan with, words to verify with."""

    def __init__(self, items: list[tuple[str, list[bytes]]], size: int):
        self.ids: dict[bytes, int] = {}
        self.items: dict[tuple[int, ...], list[str]] = defaultdict(list)
        for item, words in items:
            row = [self.ids.setdefault(w, len(self.ids) + 1) for w in words]
            m = min(size, len(row))
            for window in {tuple(row[i : i + m]) for i in range(len(row) - m + 1)}:
                self.items[window].append(item)
        by_size = defaultdict(list)
        for window in self.items:
            by_size[len(window)].append(window)
        self.hashes = {m: np.unique(_rolled(np.array(ws, np.uint64), m)[:, 0]) for m, ws in by_size.items()}
        self.filters = {}
        for m, hashes in self.hashes.items():
            self.filters[m] = np.zeros(1 << FILTER_BITS, bool)
            self.filters[m][hashes >> np.uint64(64 - FILTER_BITS)] = True

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Word spans of verified hits, and the items they belong to."""
        found, spans, get = set(), [], self.ids.get
        row = np.fromiter(map(get, words, repeat(0)), np.uint64, len(words))
        for m, hashes in self.hashes.items():
            if len(row) < m:
                continue
            rolled = _rolled(row[None, :], m)[0]
            at = np.flatnonzero(self.filters[m][rolled >> np.uint64(64 - FILTER_BITS)])
            near = np.minimum(np.searchsorted(hashes, rolled[at]), len(hashes) - 1)
            at = at[hashes[near] == rolled[at]]
            for i in at.tolist():
                if items := self.items.get(tuple(row[i : i + m].tolist())):
                    spans.append((i, i + m))
                    found.update(items)
        return _merged(spans), found


def _rolled(rows: np.ndarray, m: int) -> np.ndarray:
    """Hashes of every m consecutive ids, along the last axis."""
    n = rows.shape[1] - m + 1
    out = np.zeros((len(rows), n), np.uint64)
    for j in range(m):
        out = out * BASE + rows[:, j : j + n]
    out ^= out >> np.uint64(29)
    return out * np.uint64(0xBF58476D1CE4E5B9)


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def _blocks(benchmark: DataFrame, item: str, text: str, size: int, limit: int) -> Iterator[list]:
    """Items of at least one word, in blocks of about ``limit`` bytes; a longer item is cut so that no window is lost."""
    block, used = [], 0
    for key, words in benchmark.select(F.col(item).cast("string"), F.col(text).cast("binary")).toLocalIterator():
        words = code_words(bytes(words) if words is not None else None)
        cut = max(size, limit // 64)
        for i in range(0, max(1, len(words) - size + 1), cut):
            part = words[i : i + cut + size - 1]
            if part:
                block.append((key, part))
                used += sum(map(len, part)) + 64 * len(part)
            if used >= limit:
                yield block
                block, used = [], 0
    if block:
        yield block


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    size: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with n_words, hit_spans (start and end words, disjoint and ordered) and hit_items (sorted).

    One row out for each row in; no shuffle. Null and empty texts have no words, an empty
    benchmark hits nothing, and items without words are not looked for. Items with a null id
    hit like others and are one null at the end of hit_items. Texts of any length are scanned whole.
    Equal rows get equal results. Columns of ``docs`` named as a result are replaced.
    """
    fields = "n_words long, hit_spans array<struct<start: int, end: int>>, hit_items array<string>"
    sc = docs.sparkSession.sparkContext
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])

    def first(texts: pa.Array) -> list[pa.Array]:
        counts = [len(code_words(t)) for t in as_bytes(texts)]
        none = [[]] * len(counts)
        return [pa.array(counts, pa.int64()), pa.array(none, pa.list_(span)), pa.array(none, pa.list_(pa.string()))]

    def scanner(windows):
        def scan(texts: pa.Array, *old: pa.Array) -> list[pa.Array]:
            counts, all_spans, all_items = [], [], []
            before = zip(*[c.to_pylist() for c in old]) if old else None
            for t in as_bytes(texts):
                words = code_words(t)
                spans, items = windows.value.scan(words)
                if before:
                    was, known = next(before)
                    spans = _merged([*spans, *((s["start"], s["end"]) for s in was)])
                    items |= set(known)
                counts.append(len(words))
                all_spans.append([{"start": a, "end": b} for a, b in spans])
                all_items.append(sorted(items, key=lambda i: (i is None, i or "")))
            return [
                pa.array(counts, pa.int64()),
                pa.array(all_spans, pa.list_(span)),
                pa.array(all_items, pa.list_(pa.string())),
            ]

        return scan

    out = None
    for block in _blocks(benchmark, item, item_text, size, block_bytes):
        windows = sc.broadcast(Windows(block, size))
        if out is None:
            out = with_columns(docs, [text], fields, scanner(windows))
        else:
            old = out.withColumnsRenamed({"hit_spans": "old_spans", "hit_items": "old_items"})
            out = with_columns(old, [text, "old_spans", "old_items"], fields, scanner(windows))
            out = out.drop("old_spans", "old_items")
    return with_columns(docs, [text], fields, first) if out is None else out


def n_hit() -> F.Column:
    """Words inside the hit spans."""
    return F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]))


def contaminated() -> F.Column:
    """The contract's rule: at least one word in twenty is hit."""
    return (n_hit() > 0) & (20 * n_hit() >= F.col("n_words"))


def without_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` of ``contamination`` with the hit words cut out of ``text``; what stands between words stays."""
    word = _word_pattern()

    def cut(texts: pa.Array, spans: pa.Array) -> list[pa.Array]:
        out = []
        for t, hits in zip(as_bytes(texts), spans.to_pylist()):
            if t is not None and hits:
                at = [m.span() for m in word.finditer(t)]
                for s in reversed(hits):
                    t = t[: at[s["start"]][0]] + t[at[s["end"] - 1][1] :]
            out.append(t.decode() if t is not None else None)
        return [pa.array(out, pa.string())]

    names = docs.columns
    made = with_columns(docs, [text, "hit_spans"], "kept_text string", cut)
    return made.select(*[F.col("kept_text").alias(c) if c == text else F.col(c) for c in names])


def _word_pattern():
    import re

    return re.compile(rb"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def query(spark, sf_dir: str) -> DataFrame:
    """Hits of every benchmark window in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        n_hit().alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "hit_items"), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )
