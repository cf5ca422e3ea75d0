"""Repeated windows of fixed length, exactly, with few rows shuffled.

Both substring operators ask which windows of ``size`` units (bytes or words) stand in more
than one place. Every window is hashed, but not every hash is sent. Each window names the
least of the k-unit hashes inside it, its *anchor*; equal windows have equal anchors.
Consecutive windows with the anchor at the same place form a *run*, and only (anchor, hash
of the run's content) is sent, once per document. Then:

- runs of one content in several documents settle all their windows at once;
- contents that share an anchor without being equal may share some windows. These
  contents, one copy of each, are compared window by window;
- repeats inside one document are found where the document is.

A run never holds a window twice, for the anchor stands at another offset in each. Long
documents are cut into segments; a cut run is another content of its anchor, so nothing is lost.
Hashes have 64 bits and are compared in pairs (anchor and content, anchor and window).
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daygrain.llm.common import Batches, as_bytes, stretches
from daygrain.session import shared_dir

U = np.uint64
#: Windows of a document handled at once; anchors are told apart by their low bits.
SEGMENT, PLACE_BITS = 1 << 18, 20
_BASE = 0x9E3779B97F4A7C15
_powers: dict[str, np.ndarray] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    x = x ^ (x >> U(29))
    x = x * U(0xBF58476D1CE4E5B9)
    return x ^ (x >> U(32))


BYTE_UNITS = mixed(np.arange(1, 257, dtype=U))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's powers and their inverses modulo 2^64."""
    if len(_powers.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            out = np.full(n, base, U)
            out[0] = 1
            _powers[name] = np.multiply.accumulate(out)
    return _powers["up"][:n], _powers["down"][:n]


def prefix(units: np.ndarray) -> np.ndarray:
    """Sums from which the hash of any range follows."""
    out = np.zeros(len(units) + 1, U)
    np.cumsum(units * powers(len(units) + 1)[0][:-1], out=out[1:])
    return out


def ranges(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mixed((sums[ends] - sums[starts]) * powers(len(sums))[1][starts])


def rolled(sums: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of ``size`` units."""
    n = len(sums) - size
    return mixed((sums[size:] - sums[:n]) * powers(len(sums))[1][:n])


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """The least of each w consecutive values."""
    n = len(x)
    if w == 1:
        return x
    padded = np.full(-(-n // w) * w, np.iinfo(U).max, U)
    padded[:n] = x
    blocks = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - w + 1], ahead[w - 1 : n])


@dataclass
class Runs:
    """Runs of a document: first window, number of windows, anchor and content hash of each."""

    first: np.ndarray
    count: np.ndarray
    anchor: np.ndarray
    content: np.ndarray

    def windows(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the chosen runs, for each window: its place, its run and its offset in the run."""
        counts = self.count[which]
        offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        return np.repeat(self.first[which], counts) + offset, np.repeat(which, counts), offset


def _segments(n: int, size: int) -> Iterator[tuple[int, int]]:
    """Unit ranges that share size - 1 units, so that each window is in one."""
    for a in range(0, n - size + 1, SEGMENT):
        yield a, min(n, a + SEGMENT + size - 1)


def runs_of(units: np.ndarray, size: int, k: int) -> Runs:
    parts = []
    for a, b in _segments(len(units), size):
        sums = prefix(units[a:b])
        grams = rolled(sums, k)
        low = U((1 << PLACE_BITS) - 1)
        least = sliding_min((grams & ~low) | np.arange(len(grams), dtype=U), size - k + 1)
        place = (least & low).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(np.diff(place)) + 1])
        count = np.diff(np.append(first, len(place)))
        content = ranges(sums, first, first + count + size - 1) + mixed(count.astype(U))
        parts.append((first + a, count, grams[place[first]], content))
    columns = zip(*parts) if parts else [()] * 4
    kinds = (np.int64, np.int64, U, U)
    return Runs(*[np.concatenate(c) if c else np.empty(0, t) for c, t in zip(columns, kinds)])


def window_hashes(units: np.ndarray, size: int, places: np.ndarray) -> np.ndarray:
    """Hashes of the windows at the given places."""
    out = np.empty(len(places), U)
    for a, b in _segments(len(units), size):
        here = (places >= a) & (places <= b - size)
        if here.any():
            at = places[here] - a
            out[here] = ranges(prefix(units[a:b]), at, at + size)
    return out


def covered(n: int, size: int, windows: np.ndarray) -> np.ndarray:
    """Which of n units lie inside a flagged window."""
    edges = np.zeros(n + 1, np.int32)
    at = np.flatnonzero(windows)
    edges[at] += 1
    np.subtract.at(edges, at + size, 1)
    return np.cumsum(edges[:-1]) > 0


def byte_units(text: bytes) -> np.ndarray:
    return BYTE_UNITS[np.frombuffer(text, np.uint8)]


_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def word_units(text: bytes) -> np.ndarray:
    """A hash of each word between ASCII white space."""
    if not text:
        return np.empty(0, U)
    raw = np.frombuffer(text, np.uint8)
    edges = np.diff(np.concatenate([[True], _BLANK[raw], [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    return ranges(prefix(BYTE_UNITS[raw]), starts, ends)


def bucketed(df: DataFrame, key: str, name: str) -> DataFrame:
    """``df`` staged by the hash of ``key``, so that later joins on it don't move these rows."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    made = f"{name}_{uuid.uuid4().hex}"
    (
        df.repartition(n, key)
        .write.option("compression", "zstd")
        .option("path", f"{shared_dir(spark)}/{made}")
        .bucketBy(n, key)
        .sortBy(key)
        .saveAsTable(made)
    )
    return spark.table(made)


def live_runs(docs: DataFrame, units: Callable[[bytes], np.ndarray], size: int, k: int) -> DataFrame:
    """Runs that may hold repeated windows, once per document (row_key, doc_id, text).

    n_docs: documents with this content, is_first: whether this is the first of them by
    (doc_id, row_key), mixed: whether the anchor has other contents, too.
    """
    key = docs.schema["doc_id"].dataType.simpleString()

    def find(batches: Batches) -> Batches:
        for batch in stretches(batches):
            rows, anchors, contents = [], [], []
            for i, text in enumerate(as_bytes(batch.column("text"))):
                runs = runs_of(units(text or b""), size, k)
                content, at = np.unique(runs.content, return_index=True)
                rows.append(np.full(len(at), i))
                anchors.append(runs.anchor[at].view(np.int64))
                contents.append(content.view(np.int64))
            take = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row_key").take(take),
                    batch.column("doc_id").take(take),
                    pa.array(np.concatenate(anchors)),
                    pa.array(np.concatenate(contents)),
                ],
                names=["row_key", "doc_id", "anchor", "content"],
            )

    runs = docs.select("row_key", "doc_id", "text").mapInArrow(
        find, f"row_key long, doc_id {key}, anchor long, content long"
    )
    same = Window.partitionBy("anchor", "content")
    anchored = Window.partitionBy("anchor")
    return (
        runs.repartition("anchor")
        .withColumn("n_docs", F.count("*").over(same))
        .withColumn("head", F.min(F.struct("doc_id", "row_key")).over(same))
        .withColumn("mixed", F.min("content").over(anchored) != F.max("content").over(anchored))
        .where("n_docs > 1 OR mixed")
        .withColumn("is_first", F.col("head.row_key") == F.col("row_key"))
        .drop("head")
    )


RESULT = "n_units long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start: long, end: long>>"


@dataclass
class Unit:
    """Bytes or words: their hashes in a text, and the text that is left without some of them."""

    hashes: Callable[[bytes], np.ndarray]
    without: Callable[[bytes, np.ndarray], bytes]


def prepared(docs: DataFrame, key: str, text: str, name: str) -> DataFrame:
    """(row_key, doc_id, text, rest) bucketed by row_key; rest holds the other columns."""
    rest = F.struct(*[c for c in docs.columns if c != text])
    return bucketed(
        docs.select(
            F.monotonically_increasing_id().alias("row_key"),
            F.col(key).alias("doc_id"),
            F.col(text).alias("text"),
            rest.alias("rest"),
        ),
        "row_key",
        name,
    )


def picked(docs: DataFrame, live: DataFrame, fn: Callable[..., list], schema: str) -> DataFrame:
    """Rows that ``fn(text, runs the document has in live, row)`` lists for each document of ``live``."""
    wanted = live.groupBy("row_key").agg(F.collect_list("content").alias("contents"))
    joined = docs.select("row_key", "doc_id", "text").join(wanted, "row_key")

    def run(batches: Batches) -> Batches:
        for batch in batches:
            keys, ids = batch.column("row_key"), batch.column("doc_id")
            for i, (text, contents) in enumerate(zip(as_bytes(batch.column("text")), batch.column("contents").to_pylist())):
                yield fn(text, np.array(contents, np.int64), keys.slice(i, 1), ids.slice(i, 1))

    return joined.mapInArrow(run, schema)


def chosen(runs: Runs, contents: np.ndarray) -> np.ndarray:
    """Numbers of one run for each of the contents that the document has."""
    which = np.flatnonzero(np.isin(runs.content.view(np.int64), contents))
    return which[np.sort(np.unique(runs.content[which], return_index=True)[1])]


def local_repeats(units: np.ndarray, runs: Runs, size: int, keep_first: bool) -> np.ndarray:
    """Places of windows that stand in the document more than once; without the first, if kept."""
    _, back, counts = np.unique(runs.anchor, return_inverse=True, return_counts=True)
    places, of, _ = runs.windows(np.flatnonzero(counts[back] > 1))
    if not len(places):
        return places
    hashes = window_hashes(units, size, places) ^ mixed(runs.anchor[of])
    order = np.argsort(hashes, kind="stable")  # places ascend, so the first of equals is the earliest
    same = np.diff(hashes[order]) == 0
    late = np.concatenate([[False], same])
    if not keep_first:
        late |= np.concatenate([same, [False]])
    return places[order[late]]


def removed(
    docs: DataFrame, marks: DataFrame, unit: Unit, size: int, k: int, keep_first: bool, text: str, with_text: bool
) -> DataFrame:
    """The other columns of each document, RESULT, and the text that is left if ``with_text``.

    ``marks``: (row_key, content, place), runs whose windows all go and windows that go.
    """
    by_row = marks.groupBy("row_key").agg(
        F.collect_list("content").alias("contents"), F.collect_list("place").alias("places")
    )
    joined = docs.join(by_row, "row_key", "left").select("rest", "text", "contents", "places")
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Batches) -> Batches:
        for batch in stretches(batches):
            rows, texts = [], []
            columns = (batch.column("contents").to_pylist(), batch.column("places").to_pylist())
            for raw, contents, places in zip(as_bytes(batch.column("text")), *columns):
                body = raw or b""
                units = unit.hashes(body)
                runs = runs_of(units, size, k)
                windows = np.zeros(max(0, len(units) - size + 1), bool)
                if contents:
                    full = np.isin(runs.content.view(np.int64), np.array(contents, np.int64))
                    windows |= np.repeat(full, runs.count)
                if places:
                    windows[np.array(places)] = True
                windows[local_repeats(units, runs, size, keep_first)] = True
                gone = covered(len(units), size, windows)
                edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                kept = unit.without(body, gone)
                spans = [{"start": a, "end": b} for a, b in edges.reshape(-1, 2).tolist()]
                rows.append((len(units), int(gone.sum()), len(spans), hashlib.sha256(kept).hexdigest(), spans))
                texts.append(None if raw is None else kept.decode("utf-8", "ignore"))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(span))
            made = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)] if rows else [pa.array([], t) for t in kinds]
            names = ["rest", "n_units", "n_removed", "n_spans", "kept_sha256", "spans"]
            if with_text:
                made, names = [*made, pa.array(texts, pa.string())], [*names, "kept_text"]
            yield pa.RecordBatch.from_arrays([batch.column("rest"), *made], names=names)

    schema = f"rest {docs.schema['rest'].dataType.simpleString()}, {RESULT}" + ", kept_text string" * with_text
    out = joined.mapInArrow(run, schema)
    new = [c for c in out.columns if c not in ("rest", "kept_text")]
    rest = [F.col("rest")[c].alias(c) for c in docs.schema["rest"].dataType.names if c not in new]
    return out.select(*rest, *new, *([F.col("kept_text").alias(text)] if with_text else []))
