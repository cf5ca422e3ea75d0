"""Packing of tokenised documents into fixed windows, online, in bounded space.

Each partition keeps ``open_windows`` unfinished windows. A document longer than a window
gives whole windows; its rest goes to the open window that it fills best. If none has the
room, the fullest is emitted, topped up with the head of the rest if at least ``min_cut``
ids fit. The windows left open at the end of a partition meet in groups of
``merge_group`` partitions, are packed once more the same way, and what is open then is
laid end to end: full windows, and a last rest of power-of-two lengths, which need no padding.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.llm.byte_level import ByteLevel
from daygrain.llm.common import Batches, staged, table

WINDOW, OPEN_WINDOWS, MIN_CUT, MERGE_GROUP = 2048, 16, 16, 64
END_ID = 1
PIECES = (
    "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "open boolean, ids binary"
)

@lru_cache(maxsize=1)
def encoder(path: str) -> ByteLevel:
    """Loaded once in a worker; of the size of its file."""
    return ByteLevel(path)


class Packer:
    """Open windows and the finished pieces of one partition or group. A piece is (key, start, ids, doc_tokens)."""

    def __init__(self, size: int, open_windows: int, min_cut: int, first_id: int):
        self.size, self.most, self.min_cut = size, open_windows, min_cut
        self.next_id, self.open, self.done = first_id, [], []

    def add(self, key, start: int, ids: bytes, total: int) -> None:
        n = len(ids) // 4
        whole = n // self.size * self.size if n >= self.size else 0
        for a in range(0, whole, self.size):
            self._emit([(key, start + a, ids[4 * a : 4 * (a + self.size)], total)])
        if whole < n:
            self._place(key, start + whole, ids[4 * whole :], total)

    def _place(self, key, start: int, ids: bytes, total: int) -> None:
        n = len(ids) // 4
        fits = [w for w in self.open if w[0] >= n]
        if not fits and len(self.open) >= self.most:
            fullest = min(self.open, key=lambda w: w[0])
            gap = fullest[0]
            self.open.remove(fullest)
            if gap >= self.min_cut:
                fullest[1].append((key, start, ids[: 4 * gap], total))
                start, ids = start + gap, ids[4 * gap :]
                n -= gap
                fits = [w for w in self.open if w[0] >= n]
            self._emit(fullest[1])
        if fits:
            best = min(fits, key=lambda w: w[0])
        else:
            self.open.append(best := [self.size, []])
        best[0] -= n
        best[1].append((key, start, ids, total))
        if best[0] == 0:
            self.open.remove(best)
            self._emit(best[1])

    def _emit(self, pieces: list, is_open: bool = False) -> None:
        offset = 0
        for key, start, ids, total in pieces:
            n = len(ids) // 4
            self.done.append((key, start, n, zlib.crc32(ids), total, self.next_id, offset, is_open, ids))
            offset += n
        self.next_id += 1

    def leave_open(self) -> None:
        for _, pieces in self.open:
            self._emit(pieces, is_open=True)
        self.open = []

    def lay_out(self) -> None:
        """The open windows end to end; lengths of the last rest are powers of two."""
        pieces = [p for _, window in self.open for p in window]
        left = sum(len(p[2]) // 4 for p in pieces)
        while left:
            room = self.size if left >= self.size else 1 << (left.bit_length() - 1)
            left -= room
            taken = []
            while room:
                key, start, ids, total = pieces.pop(0)
                n = min(room, len(ids) // 4)
                taken.append((key, start, ids[: 4 * n], total))
                if 4 * n < len(ids):
                    pieces.insert(0, (key, start + n, ids[4 * n :], total))
                room -= n
            self._emit(taken)
        self.open = []


def pack(
    docs: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    size: int = WINDOW,
    open_windows: int = OPEN_WINDOWS,
    min_cut: int = MIN_CUT,
    merge_group: int = MERGE_GROUP,
    keep_ids: bool = False,
) -> DataFrame:
    """Pieces of documents in sequences: key, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    With ``keep_ids`` also ``ids`` (little-endian uint32). A document is its ids and a
    closing id 1; a null or empty text is that id alone, and the special tokens' strings in a text are
    their ids. Rows with equal or null keys are
    separate documents, an empty table gives no rows, other columns play no part.
    The sequence ids depend on the
    partitions of the input, not on the order of tasks; ids of documents reach other tasks
    only for windows left open, at most ``open_windows`` a partition.
    """
    named = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    key_type = named.schema["key"].dataType.simpleString()
    end = struct.pack("<I", END_ID)

    def run(batches: Batches) -> Batches:
        vocabulary = encoder(tokenizer)
        packer = Packer(size, open_windows, min_cut, TaskContext.get().partitionId() << 33)
        types = None
        for batch in batches:
            types = batch.schema.field("key").type
            for k, t in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                ids = (vocabulary.packed_ids(t) if t else b"") + end
                packer.add(k, 0, ids, len(ids) // 4)
                if len(packer.done) >= 1024:
                    yield out(packer, types)
        packer.leave_open()
        if types is not None:
            yield out(packer, types)

    def out(packer: Packer, key_type: pa.DataType) -> pa.RecordBatch:
        rows, packer.done = packer.done, []
        columns = list(zip(*rows)) if rows else [[]] * 9
        kinds = [key_type, *[pa.int64()] * 6, pa.bool_(), pa.binary()]
        ids = [x if is_open or keep_ids else None for x, is_open in zip(columns[8], columns[7])]
        arrays = [pa.array(c, t) for c, t in zip([*columns[:8], ids], kinds)]
        names = ["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "open", "ids"]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def merge(group: tuple, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        left = pd.concat(list(frames)).sort_values(["sequence_id", "offset"])
        packer = Packer(size, open_windows, min_cut, (group[0] * merge_group << 33) + (1 << 32))
        fill = left.groupby("sequence_id")["length"].sum().sort_values(ascending=False, kind="stable")
        rows = {s: f for s, f in left.groupby("sequence_id")}
        for s in fill.index:
            for r in rows[s].itertuples():
                packer.add(r.key if pd.notna(r.key) else None, r.start, r.ids, r.doc_tokens)
        packer.lay_out()
        made = pd.DataFrame(packer.done, columns=left.columns[:9])
        made["open"] = False
        if not keep_ids:
            made["ids"] = None
        made["key"] = made["key"].astype(left["key"].dtype)
        yield made

    pieces = staged(named.mapInArrow(run, f"key {key_type}, {PIECES}"), "pieces")
    left = pieces.where("open").withColumn("part", F.expr(f"shiftright(sequence_id, 33) div {merge_group}"))
    merged = left.groupBy("part").applyInPandas(merge, pieces.schema)
    whole = pieces.where("not open").unionByName(merged)
    columns = [F.col("key").alias(key), *whole.columns[1:7]]
    return whole.select(*columns, *(["ids"] if keep_ids else []))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def query(spark, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of at most 2048 ids."""
    return pack(table(spark, sf_dir, "documents"), tokenizer_path())
