"""Cross-tokenizer alignment: tokens of two vocabularies that cover the same bytes.

Texts are shuffled whole, and each distinct one is tokenised and aligned once. An id
pair's count over the corpus weights each text by its number of documents; the measures of
a text then go to its documents by the SHA-256 of the text.

Both tokenizers of the registered query treat the words between single spaces apart from
each other, so each such chunk is aligned once in a task and remembered, within a bound in
characters. A tokenizer for which that doesn't hold has to be given ``whole=True``.

The most frequent pairs, whose number is bounded by the share of all links that each
has, are broadcast; the others are joined by pair, and each has too few links to burden a
task. Nothing else but the vocabularies reaches all tasks.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property, lru_cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.llm.byte_level import ByteLevel
from daygrain.llm.common import Batches, staged, table

#: Characters of the chunks that a task remembers, what each counts for beside them, and characters handled at once.
REMEMBERED, OVERHEAD, BLOCK = 1 << 23, 32, 1 << 20
#: Chunks tokenised at once, and texts of an Arrow batch.
CHUNKS, TEXTS = 1 << 14, 64
#: A pair with at least this share of all links is broadcast: there are at most its inverse.
COMMON = 1 / (1 << 18)
#: Pairs counted at once in a task.
COUNTED = 1 << 22
#: A text with more than this share of all documents gets its measures by a broadcast.
HOT_SHARE = 1 / 256
_SAFE = re.compile(r"(?<=\S) (?=\S)")
_BLANK_BESIDE = re.compile(r"\s\s|^\s|\s$")


class Vocabulary:
    """The bytes of each id, and their numbers."""

    bytes: list[bytes]

    @cached_property
    def lengths(self) -> np.ndarray:
        return np.fromiter(map(len, self.bytes), np.int64, len(self.bytes))


class Spaced(Vocabulary):
    """Texts with a space before them to ids of a byte-level vocabulary; special tokens' strings are ordinary text."""

    def __init__(self, path: str):
        self.model = ByteLevel(path, special=False)
        self.bytes = self.model.bytes

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.model.ids(" " + t) for t in texts]


class Pieces(Vocabulary):
    """Texts to ids of a piece vocabulary."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [
            bytes([int(s[3:5], 16)]) if self.model.is_byte(i) else s.replace("▁", " ").encode() for i, s in enumerate(names)
        ]

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text, before which the model sets a space itself."""
        return self.model.encode(texts, num_threads=1)


@lru_cache(maxsize=2)
def _tokenizers(path_a: str, path_b: str) -> tuple[Spaced, Pieces]:
    """Loaded once in a worker; of the size of their files."""
    return Spaced(path_a), Pieces(path_b)


#: A chunk's groups as text, its linked pairs as int64 (a << 32 | b) in bytes, and its numbers of tokens.
Aligned = tuple[str, bytes, int, int]


def align(text: bytes, a: list[int], b: list[int], bytes_a: list[bytes], bytes_b: list[bytes]) -> Aligned | None:
    """Groups and links of the tokens of ``text``; None if either side doesn't give its bytes.

    No token of either vocabulary is without bytes, so an offset ends one token a side at most.
    """
    tokens_a, tokens_b = [bytes_a[i] for i in a], [bytes_b[i] for i in b]
    if b"".join(tokens_a) != text or b"".join(tokens_b) != text:
        return None
    nth_b = dict(zip(accumulate(map(len, tokens_b)), range(len(b))))
    groups, pairs, at_a, at_b = [], [], 0, 0
    for n, end in enumerate(accumulate(map(len, tokens_a))):
        if end in nth_b:
            m = nth_b[end]
            groups.append(f"{','.join(map(str, a[at_a : n + 1]))}|{','.join(map(str, b[at_b : m + 1]))}")
            pairs.append(a[n] << 32 | b[m])
            at_a, at_b = n + 1, m + 1
    return ";".join(groups), struct.pack(f"<{len(pairs)}q", *pairs), len(a), len(b)


def align_all(texts: list[bytes], a: list[list[int]], b: list[list[int]], of_a: Vocabulary, of_b: Vocabulary) -> list:
    """``align`` of each of ``texts``, all at once where the tokens give all of their bytes."""
    flat_a, flat_b = list(chain.from_iterable(a)), list(chain.from_iterable(b))
    ids_a, ids_b = np.array(flat_a, np.int64), np.array(flat_b, np.int64)
    ends_a, ends_b = of_a.lengths[ids_a].cumsum(), of_b.lengths[ids_b].cumsum()
    last_a, last_b = (np.fromiter(map(len, x), np.int64, len(x)).cumsum() - 1 for x in (a, b))
    ends = np.fromiter(map(len, texts), np.int64, len(texts)).cumsum()
    whole = b"".join(texts)
    if not (
        all(a) and all(b)
        and b"".join(map(of_a.bytes.__getitem__, flat_a)) == whole == b"".join(map(of_b.bytes.__getitem__, flat_b))
        and (ends_a[last_a] == ends).all() and (ends_b[last_b] == ends).all()
    ):
        return [align(t, x, y, of_a.bytes, of_b.bytes) for t, x, y in zip(texts, a, b)]
    at = np.searchsorted(ends_b, ends_a)  # both sides end at the end of the last text
    link_a = np.flatnonzero(ends_b[at] == ends_a)
    link_b = at[link_a]
    pairs = (ids_a[link_a] << 32 | ids_b[link_b]).astype("<i8").tobytes()
    named_a, named_b = list(map(str, flat_a)), list(map(str, flat_b))
    cuts = zip(*[x.tolist() for x in (np.r_[0, link_a + 1], link_a + 1, np.r_[0, link_b + 1], link_b + 1)])
    groups = [f"{','.join(named_a[i:j])}|{','.join(named_b[k:n])}" for i, j, k, n in cuts]
    stops = np.searchsorted(link_a, last_a, "right").tolist()
    return [
        (";".join(groups[i:j]), pairs[8 * i : 8 * j], len(x), len(y)) for i, j, x, y in zip([0, *stops], stops, a, b)
    ]


class Aligner:
    """Aligns texts chunk by chunk; what it remembers lives as long as a task."""

    def __init__(self, a: Spaced, b: Pieces, whole: bool = False):
        self.a, self.b, self.whole = a, b, whole
        self.known: dict[str, Aligned | None] = {}
        self.held = 0

    def __call__(self, texts: list[str]) -> list[Aligned]:
        """What each text comes to; nothing if its bytes don't come back. Each batch of texts is tokenised at once."""
        out, held = [], []
        for text in texts:
            blocks = list(self._blocks(text)) or [[]]
            if len(blocks) == 1:
                held += blocks
            if len(blocks) > 1 or sum(map(len, held)) > CHUNKS:
                out += map(_joined, self._aligned(held))
                held = []
            if len(blocks) > 1:  # a long text, block by block
                out.append(_joined([x for block in blocks for x in self._aligned([block])[0]]))
        return [*out, *map(_joined, self._aligned(held))]

    def _blocks(self, text: str) -> Iterator[list[str]]:
        """The chunks of a text, in stretches of bounded length where it has single spaces."""
        if self.whole:
            yield [text]
            return
        at = 0
        while at < len(text):
            cut = _SAFE.search(text, at + BLOCK) if len(text) - at > BLOCK else None
            end = cut.start() if cut else len(text)
            block = text[at:end]
            yield _SAFE.split(block) if _BLANK_BESIDE.search(block) else block.split(" ")
            at = end + 1

    def _aligned(self, lists: Sequence[list[str]]) -> list[list[Aligned | None]]:
        """What the chunks of each list come to."""
        if self.held > REMEMBERED:
            self.known.clear()
            self.held = 0
        if new := list(set().union(*lists).difference(self.known)):
            spaced = [b" " + chunk.encode() for chunk in new]
            self.known.update(zip(new, align_all(spaced, self.a.encode(new), self.b.encode(new), self.a, self.b)))
            self.held += sum(map(len, new)) + OVERHEAD * len(new)
        return [list(map(self.known.__getitem__, chunks)) for chunks in lists]


def _joined(found: list[Aligned | None]) -> Aligned:
    if not found or None in found:
        return "", b"", 0, 0
    groups, pairs, n_a, n_b = zip(*found)
    return ";".join(groups), b"".join(pairs), sum(n_a), sum(n_b)


@dataclass(frozen=True)
class Alignment:
    """``texts``: text_sha and the measures of each distinct text. ``pairs``: pair (a << 32 | b), n, best."""

    texts: DataFrame
    pairs: DataFrame


def _distinct(docs: DataFrame, text: str) -> DataFrame:
    """``text, documents``; a copied text reaches the shuffle once a task."""
    return docs.where(F.length(F.col(text)) > 0).groupBy(F.col(text).alias("text")).agg(F.count("*").alias("documents"))


def _aligned(texts: DataFrame, path_a: str, path_b: str, whole: bool) -> DataFrame:
    """``text_sha, documents, n_a, n_b, n_groups, groups_sha256`` and the linked ``pairs`` with their ``times``."""

    def run(batches: Batches) -> Batches:
        aligner = Aligner(*_tokenizers(path_a, path_b), whole)
        for batch in batches:
            rows, held = [], 0
            sha, documents = batch.column("text_sha").to_pylist(), batch.column("documents").to_pylist()
            texts = batch.column("text")
            slices = (texts.slice(at, TEXTS).to_pylist() for at in range(0, len(texts), TEXTS))
            of = chain.from_iterable(map(aligner, slices))
            for key, n, (groups, links, n_a, n_b) in zip(sha, documents, of):
                pairs, times = np.unique(np.frombuffer(links, "<i8"), return_counts=True)
                digest = hashlib.sha256(groups.encode()).hexdigest() if n_a else ""
                rows.append((key, n, n_a, n_b, len(links) // 8, digest, pairs, times))
                held += len(pairs)
                if held > BLOCK:
                    yield made(rows)
                    rows, held = [], 0
            yield made(rows)

    def made(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [[]] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values())], names=list(kinds))

    kinds = {
        "text_sha": pa.binary(), "documents": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(),
        "groups_sha256": pa.string(), "pairs": pa.list_(pa.int64()), "times": pa.list_(pa.int32()),
    }
    return texts.select("text_sha", "documents", "text").mapInArrow(
        run,
        "text_sha binary, documents long, n_a long, n_b long, n_groups long, groups_sha256 string, "
        "pairs array<long>, times array<int>",
    )


def _counted(aligned: DataFrame) -> DataFrame:
    """``pair, n``: links over all documents. Tasks add up their own pairs before the shuffle."""

    def add(batches: Batches) -> Batches:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            pairs, times = batch.column("pairs"), batch.column("times")
            sizes = np.diff(pairs.offsets.to_numpy())
            weight = np.repeat(batch.column("documents").to_numpy(), sizes) * times.flatten().to_numpy()
            held = [total([*held, (pairs.flatten().to_numpy(), weight)])]
            if len(held[0][0]) > COUNTED:
                yield out(*held.pop())
        if held:
            yield out(*held.pop())

    def total(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        pairs, back = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
        sums = np.zeros(len(pairs), np.int64)
        np.add.at(sums, back, np.concatenate([h[1] for h in held]))
        return pairs, sums

    def out(pairs: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(pairs, pa.int64()), pa.array(sums, pa.int64())], names=["pair", "n"])

    partial = aligned.select("documents", "pairs", "times").mapInArrow(add, "pair long, n long")
    return partial.groupBy("pair").agg(F.sum("n").alias("n"))


def _measured(aligned: DataFrame, pairs: DataFrame) -> DataFrame:
    """``aligned`` without its pairs, with ``n_best`` and ``count_sum``."""
    spark = aligned.sparkSession
    links = pairs.agg(F.sum("n")).first()[0] or 0
    bound = COMMON * links
    common = pairs.where(F.col("n") >= bound).toArrow().sort_by("pair")  # 1 / COMMON rows at most
    shared = spark.sparkContext.broadcast([common.column(c).to_numpy() for c in ("pair", "n", "best")])

    def look_up(batches: Batches) -> Batches:
        keys, counts, best = shared.value
        kept = ["text_sha", "documents", "n_a", "n_b", "n_groups", "groups_sha256"]
        for batch in batches:
            column, times = batch.column("pairs"), batch.column("times").flatten().to_numpy().astype(np.int64)
            offsets = column.offsets.to_numpy() - column.offsets[0].as_py()
            own = column.flatten().to_numpy()
            at = np.searchsorted(keys, own)
            known = np.zeros(len(own), bool)
            inside = at < len(keys)
            known[inside] = keys[at[inside]] == own[inside]
            at[~known] = 0
            text = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            sums = np.zeros((2, batch.num_rows), np.int64)
            if len(keys):
                np.add.at(sums[0], text[known], (times * best[at])[known])
                np.add.at(sums[1], text[known], (times * counts[at])[known])
            rest = np.flatnonzero(~known)
            ends = np.concatenate([[0], np.bincount(text[rest], minlength=batch.num_rows).cumsum()]).astype(np.int32)
            rare = pa.StructArray.from_arrays(
                [pa.array(own[rest], pa.int64()), pa.array(times[rest], pa.int64())], names=["pair", "times"]
            )
            columns = [*map(batch.column, kept), pa.array(sums[0]), pa.array(sums[1]), pa.ListArray.from_arrays(ends, rare)]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "n_best", "count_sum", "rare"])

    looked_up = staged(
        aligned.mapInArrow(
            look_up,
            "text_sha binary, documents long, n_a long, n_b long, n_groups long, groups_sha256 string, "
            "n_best long, count_sum long, rare array<struct<pair:long,times:long>>",
        ),
        "measures",
    )
    rare = looked_up.select("text_sha", F.inline("rare")).join(pairs.where(F.col("n") < bound), "pair")
    rare = rare.groupBy("text_sha").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("times") * F.col("n")).alias("more_sum"),
    )
    whole = looked_up.drop("rare").join(rare, "text_sha", "left")
    more = {a: F.col(a) + F.coalesce(b, F.lit(0)) for a, b in (("n_best", "more_best"), ("count_sum", "more_sum"))}
    return whole.withColumns(more).drop("more_best", "more_sum")


def align_corpus(docs: DataFrame, path_a: str, path_b: str, text: str = "text", whole: bool = False) -> Alignment:
    """Alignment of all distinct texts of ``docs`` between the vocabularies in two files.

    A is a byte-level vocabulary and gets a space before the text, B is one of pieces and sets
    it itself. Texts whose bytes either side doesn't give back have zeros; null and empty ones
    have no row. A text of any length is aligned block by block. An empty table
    gives no rows.
    """
    texts = _distinct(docs, text).withColumn("text_sha", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    aligned = staged(_aligned(texts, path_a, path_b, whole), "aligned")
    pairs = staged(_counted(aligned), "pairs")
    # one row per id of B, of which its vocabulary file sets the number
    highest = pairs.groupBy(F.col("pair").bitwiseAND((1 << 32) - 1).alias("b")).agg(F.max("n").alias("most"))
    best = pairs.join(F.broadcast(highest), F.col("pair").bitwiseAND((1 << 32) - 1) == F.col("b"))
    pairs = staged(best.select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pairs")
    return Alignment(staged(_measured(aligned, pairs), "texts"), pairs)


MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def measures_of(docs: DataFrame, alignment: Alignment, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: its key and the measures of its text, zeros and '' without tokens.

    Rows with equal or null keys are rows of their own. Measures of texts with a great share of
    all documents, fewer than 256, are broadcast; those of others meet their documents in a shuffle.
    """
    sha = F.when(F.length(F.col(text)) > 0, F.unhex(F.sha2(F.col(text).cast("binary"), 256)))
    of = staged(docs.select(F.col(key).alias("key"), sha.alias("sha")), "documents")
    texts = alignment.texts.withColumn("n_links", F.col("n_groups"))  # every group ends with one link
    bound = HOT_SHARE * (texts.agg(F.sum("documents")).first()[0] or 0)
    hot, cold = texts.where(F.col("documents") > bound), texts.where(F.col("documents") <= bound)
    same = F.col("sha") == F.col("text_sha")
    near = of.join(F.broadcast(hot), same)
    rest = of.where("sha IS NOT NULL").join(F.broadcast(hot.select("text_sha")), same, "left_anti").join(cold, same, "left")
    none = of.where("sha IS NULL")
    for name in (*MEASURES, "groups_sha256"):
        none = none.withColumn(name, F.lit(None))
    columns = ["key", *MEASURES, "groups_sha256"]
    every = near.select(*columns).unionByName(rest.select(*columns)).unionByName(none.select(*columns))
    zeros = [F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long")).alias(c) for c in MEASURES]
    return every.select(F.col("key").alias(key), *zeros, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))


def tokenizer_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def query(spark, sf_dir: str) -> DataFrame:
    """Alignment measures of every document."""
    docs = table(spark, sf_dir, "documents")
    return measures_of(docs, align_corpus(docs, *tokenizer_paths()))
