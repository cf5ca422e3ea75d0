"""Suffix-array dedup: every byte under a ``size``-byte string that also starts elsewhere goes.

Suffixes are sorted one bucket at a time. A bucket holds the strings that share an anchor
(see ``repeats``), so equal windows are in one bucket and no task needs the whole corpus.
Inside a bucket the suffixes of a block of text are ordered by their first PERIOD bytes;
longer ties are resolved by the ranks of a difference cover's sample of positions, which
are computed beforehand by prefix doubling: for any two positions there is a shift below
PERIOD that takes both to sampled ones. Neighbours in that order that agree in ``size``
bytes are repeats. Memory is bounded by the block, never by the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.llm import repeats
from daygrain.llm.common import Batches, staged, table

SIZE, GRAM = 400, 64
#: Bytes of strings sorted at once, bytes of one anchor's strings that a task sorts, and suffixes of one bucket.
BLOCK, ANCHOR_BYTES, BUCKET = 4 << 20, 16 << 20, 1 << 18
STEP = 8
PERIOD = STEP * STEP
#: 0..7 and the multiples of 8: every difference modulo 64 is one of the second less one of the first.
COVER = np.unique([*range(STEP), *range(0, PERIOD, STEP)])


def _shifts() -> np.ndarray:
    """For each pair of residues, the least shift that takes both into the cover."""
    inside = np.isin(np.arange(2 * PERIOD) % PERIOD, COVER)
    moved = np.stack([inside[d : d + PERIOD] for d in range(PERIOD)])
    return np.argmax(moved[:, :, None] & moved[:, None, :], axis=0)


SHIFT = _shifts()


class Suffixes:
    """The text of a block, with what its suffixes are compared by."""

    def __init__(self, text: bytes, depth: int):
        self.n = len(text)
        pad = 2 * PERIOD + depth
        raw = np.zeros(self.n + pad + 8, np.uint8)
        raw[: self.n] = np.frombuffer(text, np.uint8)
        self.eights = np.ndarray((self.n + pad,), ">u8", raw.data, strides=(1,))  # the eight bytes from each place on
        sample = np.flatnonzero(np.isin(np.arange(self.n + PERIOD) % PERIOD, COVER))
        self.rank = np.zeros(self.n + pad, np.int32)
        order = np.lexsort([self.words(sample + 8 * j) for j in reversed(range(STEP))])
        rows = sample[order]
        new = np.zeros(len(rows), bool)
        for j in range(STEP):
            new[1:] |= np.diff(self.words(rows + 8 * j)) != 0
        self.rank[rows] = np.cumsum(new) + 1
        reach = PERIOD
        while reach < depth:
            pairs = self.rank[sample].astype(np.int64) * (len(sample) + 2) + self.rank[sample + reach]
            self.rank[sample] = np.unique(pairs, return_inverse=True)[1] + 1
            reach *= 2

    def words(self, places: np.ndarray) -> np.ndarray:
        """The eight bytes at each place as a number that sorts like them."""
        return self.eights[places].astype(np.uint64)

    def ordered(self, places: np.ndarray) -> Iterator[np.ndarray]:
        """The places in the order of their suffixes, bucket by bucket."""
        lead = self.words(places) >> np.uint64(48)
        places = places[np.argsort(lead, kind="stable")]
        ends = np.cumsum(np.bincount(lead.astype(np.int64)))
        at = 0
        while at < len(places):
            # whole leads, as many as a bucket takes; a common lead may fill a bucket alone
            upto = ends[max(np.searchsorted(ends, at + BUCKET, "right") - 1, np.searchsorted(ends, at, "right"))]
            yield self._sorted(places[at:upto])
            at = int(upto)

    def _sorted(self, places: np.ndarray) -> np.ndarray:
        group = np.zeros(len(places), np.int64)
        for j in range(STEP):
            self._refine(places, group, lambda p, _: self.words(p + 8 * j))
        settled = np.zeros(len(places), bool)
        while self._refine(places, group, self._against, settled):
            pass
        return places

    def _against(self, places: np.ndarray, pivots: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 as the suffix comes before, with or after its group's pivot."""
        shift = SHIFT[places % PERIOD, pivots % PERIOD]
        return np.sign(self.rank[places + shift] - self.rank[pivots + shift])

    def _refine(self, places: np.ndarray, group: np.ndarray, key, settled: np.ndarray | None = None) -> bool:
        """Sorts each group of equals by ``key`` in place; a group's number is the place of its first member."""
        sizes = np.bincount(group, minlength=len(group))
        tied = sizes[group] > 1
        if settled is not None:
            tied &= ~settled
        at = np.flatnonzero(tied)
        if not len(at):
            return False
        here, of = places[at], group[at]
        pivots = places[of + sizes[of] // 2]
        keys = key(here, pivots)
        order = np.lexsort((keys, of))
        here, of, keys = here[order], of[order], keys[order]
        new = np.concatenate([[True], (of[1:] != of[:-1]) | (keys[1:] != keys[:-1])])
        places[at] = here
        group[at] = at[np.flatnonzero(new)][np.cumsum(new) - 1]
        if settled is not None:
            settled[at] = keys == 0  # with the pivot: equal to the full depth
        return True


def repeated(bodies: list[bytes], size: int) -> np.ndarray:
    """Which windows of the bodies, end to end, stand in them more than once. Windows cross no border."""
    text = b"".join(bodies)
    counts = np.array([len(b) - size + 1 for b in bodies])
    starts = np.cumsum([0, *map(len, bodies[:-1])])
    within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    places = np.repeat(starts, counts) + within
    suffixes = Suffixes(text, size + PERIOD)
    hashes = np.empty(len(text), np.uint64)
    for at in range(0, len(text) - size + 1, repeats.SEGMENT):
        part = repeats.rolled(repeats.prefix(repeats.byte_units(text[at : at + repeats.SEGMENT + size - 1])), size)
        hashes[at : at + len(part)] = part
    flags = np.zeros(len(text), bool)
    for order in suffixes.ordered(places):
        same = hashes[order[1:]] == hashes[order[:-1]]
        flags[order[1:][same]] = True
        flags[order[:-1][same]] = True
    return flags[places]


BYTES = repeats.Unit(repeats.byte_units, lambda text, gone: np.frombuffer(text, np.uint8)[~gone].tobytes())


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE, gram: int = GRAM, with_text: bool = True
) -> DataFrame:
    """``docs`` with every byte of a repeated window taken out of ``text``, and n_units (bytes),
    n_removed, n_spans, kept_sha256 and spans (maximal intervals of removed bytes).

    All copies of a repeated string go, the first too. Windows cross no documents and are
    judged on the input. Null texts stay null and count as empty; texts shorter than
    ``size`` lose nothing. Equal rows are documents of their own, so they repeat one
    another. Where a cut leaves part of a character, the text drops the part, the digest
    keeps it. Columns named as a result are replaced. Without ``with_text`` the text is
    left out.
    """
    body = repeats.prepared(docs, key, text, "bytes")
    live = staged(repeats.live_runs(body, repeats.byte_units, size, gram), "runs")

    def strings(raw, contents, row_key, _doc_id):
        runs = repeats.runs_of(repeats.byte_units(raw), size, gram)
        which = repeats.chosen(runs, contents)
        first, count = runs.first[which], runs.count[which]
        parts = [raw[a : a + n + size - 1] for a, n in zip(first.tolist(), count.tolist())]
        columns = [
            pa.array(runs.anchor[which].view(np.int64)),
            row_key.take(pa.array(np.zeros(len(which), np.int32))),
            pa.array(first),
            pa.array(parts, pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["anchor", "row_key", "place", "body"])

    def sort_buckets(batches: Batches) -> Batches:
        """Blocks of whole anchors; the rows come sorted by anchor."""
        held, used = [], 0

        def settle(rows):
            flags = repeated([r[3] for r in rows], size)
            counts = [len(r[3]) - size + 1 for r in rows]
            place = np.concatenate([r[2] + np.arange(n) for r, n in zip(rows, counts)])
            keys = np.repeat([r[1] for r in rows], counts)
            return pa.RecordBatch.from_arrays(
                [pa.array(keys[flags], pa.int64()), pa.array(place[flags], pa.int64())], names=["row_key", "place"]
            )

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if used >= BLOCK and row[0] != held[-1][0]:
                    yield settle(held)
                    held, used = [], 0
                held.append(row)
                used += len(row[3])
        if held:
            yield settle(held)

    def hash_windows(batches: Batches) -> Batches:
        for batch in batches:
            for i, body in enumerate(batch.column("body").to_pylist()):
                hashes = repeats.rolled(repeats.prefix(repeats.byte_units(body)), size)
                at = pa.array(np.full(len(hashes), i))
                place = batch.column("place")[i].as_py() + np.arange(len(hashes))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("anchor").take(at), pa.array(hashes.view(np.int64)),
                     batch.column("row_key").take(at), pa.array(place)],
                    names=["anchor", "window", "row_key", "place"],
                )

    rivals = live.where("mixed AND is_first")
    schema = "anchor long, row_key long, place long, body binary"
    rows = staged(repeats.picked(body, rivals, strings, schema), "strings")
    # an anchor whose strings would not fit a task's memory, as at the start of a very common passage,
    # is compared by counted window hashes, which Spark spreads over the tasks
    sizes = rows.groupBy("anchor").agg(F.sum(F.octet_length("body")).alias("size"))
    many = sizes.where(F.col("size") > ANCHOR_BYTES).select("anchor")
    few = rows.join(many, "anchor", "left_anti").select(*rows.columns)
    found = few.repartition("anchor").sortWithinPartitions("anchor", "row_key", "place")
    found = found.mapInArrow(sort_buckets, "row_key long, place long")
    spread = rows.join(many, "anchor", "left_semi").select(*rows.columns)
    spread = spread.mapInArrow(hash_windows, "anchor long, window long, row_key long, place long")
    common = spread.groupBy("anchor", "window").count().where("count > 1").drop("count")
    found = found.unionByName(spread.join(common, ["anchor", "window"]).select("row_key", "place"))
    marks = live.where("n_docs > 1").selectExpr("row_key", "content", "CAST(NULL AS LONG) AS place")
    marks = marks.unionByName(found.selectExpr("row_key", "CAST(NULL AS LONG) AS content", "place"))
    return repeats.removed(body, marks, BYTES, size, gram, False, text, with_text)


def query(spark, sf_dir: str) -> DataFrame:
    """Every document without the 400-byte strings that stand elsewhere, too."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = remove_repeats(docs, with_text=False)
    return out.select("doc_id", F.col("n_units").alias("n_bytes"), "n_removed", "n_spans", "kept_sha256")
