"""Approximate nearest neighbours by an inverted multi-index.

Both halves of a vector are quantised by codebooks of their own, so that K centroids a
half make K * K cells. A query meets the cells in the order of its summed distance to their two
centroids, from a heap, until the cells met hold enough entries; those are reranked by
their true distance.

How many are enough depends on the data: a few hundred where vectors form clusters, a
great share of all where they lie as in a random cloud. So it is measured: a bounded sample of the
queries is compared with every entry, and the number is taken with which the wanted
share of their true neighbours would have been met.

Equal vectors are one entry with its smallest keys, of which no result can hold more than
its length and the query itself. Entries are dealt in blocks of whole cells, or parts of a
cell that is larger than a block; a block and the queries that visit it, however many, are one
stretch of sorted rows, of which only the block is held in memory. A query goes to a
block once, with the list of cells that it visits there.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daygrain.llm.common import Batches, keyed, staged, table

QUERIES, NEIGHBOURS = "vec_id % 100 = 0", 10
#: Share of the sampled queries' true neighbours that the cells must hold, and the number of those queries.
RECALL, SAMPLED = 0.96, 128
#: Entries per cell on average, and centroids of a half at most.
CELL, MOST_CENTROIDS = 12, 1024
#: Vectors from which the codebooks are fitted: so many per centroid, but no more components than this in all.
PER_CENTROID, FITTED, STEPS = 256, 1 << 22, 8
#: Entries held at once when queries are reranked.
BLOCK = 1024


@dataclass(frozen=True)
class Index:
    """Codebooks of both halves and the size of every cell; at most 1024 * 1024 cells."""

    left: np.ndarray
    right: np.ndarray
    sizes: np.ndarray

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances of the halves of ``x`` to all centroids."""
        cut = self.left.shape[1]
        return _squares(x[:, :cut], self.left), _squares(x[:, cut:], self.right)

    def cells(self, x: np.ndarray) -> np.ndarray:
        left, right = self.distances(x)
        return left.argmin(axis=1) * len(self.right) + right.argmin(axis=1)

    def visited(self, left: np.ndarray, right: np.ndarray, enough: int) -> list[int]:
        """Cells with entries in the order of the summed distance, until they hold ``enough``."""
        i_th, j_th = left.argsort(kind="stable"), right.argsort(kind="stable")
        a, b, wide = left[i_th].tolist(), right[j_th].tolist(), len(right)
        first, second = (i_th * wide).tolist(), j_th.tolist()
        heap, found, held = [(a[0] + b[0], 0, 0)], [], 0
        while heap and held < enough:
            _, i, j = heapq.heappop(heap)
            # each cell is reached once: along its row, and rows from their first cell
            if j + 1 < len(b):
                heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
            if j == 0 and i + 1 < len(a):
                heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))
            cell = first[i] + second[j]
            if size := self.sizes[cell]:
                found.append(cell)
                held += int(size)
        return found

    def needed(self, left: np.ndarray, right: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """How many entries a query meets until each of ``cells`` is done."""
        sums = np.add.outer(left, right).ravel()
        order = sums.argsort(kind="stable")
        met = self.sizes[order].cumsum()
        return met[np.searchsorted(sums[order], sums[cells], "right") - 1]


def _squares(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.maximum(0.0, (x * x).sum(axis=1)[:, None] - 2 * x @ centroids.T + (centroids * centroids).sum(axis=1))


def codebook(x: np.ndarray, k: int, steps: int = STEPS) -> np.ndarray:
    """Centroids of the rows of ``x``, starting from the first different ones."""
    centroids = x[np.sort(np.unique(x, axis=0, return_index=True)[1])[:k]]
    for _ in range(steps):
        nearest = _squares(x, centroids).argmin(axis=1)
        n = np.bincount(nearest, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, x)
        centroids = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centroids)
    return centroids


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of equally long lists as doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _rows(vectors: DataFrame, key: str, embedding: str, queries: str) -> DataFrame:
    """Rows that take part: ``row_key, id, asked, v``."""
    named = vectors.select(F.col(key).cast("long").alias("id"), F.col(embedding).alias("v"), F.expr(queries).alias("asked"))
    zero = F.lit(0).cast(named.schema["v"].dataType.elementType)
    sound = "size(v) > 0 AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    rows = named.where(f"{sound} AND exists(v, x -> x <> 0)").withColumn("v", F.transform("v", lambda x: x + zero))
    rows = keyed(rows, "vectors")  # with one zero
    length = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (length["n"] if length else 0))


def _entries(rows: DataFrame, most: int) -> DataFrame:
    """Different vectors with their ``most`` smallest keys: ``v, members``, an array of (id, row_key)."""
    order = Window.partitionBy("v").orderBy(F.col("id").asc_nulls_last(), "row_key")
    first = rows.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= most)
    members = F.sort_array(F.collect_list(F.struct("nth", "id", "row_key")))
    members = F.transform(members, lambda m: F.struct(m["id"].alias("id"), m["row_key"].alias("row_key")))
    return first.groupBy("v").agg(members.alias("members"))


def _fitted(entries: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Codebooks of the halves from a sample by hash, of a size that is bounded whatever ``n`` is."""
    length = entries.select(F.size("v")).first()[0]
    k = max(1, min(MOST_CENTROIDS, round(math.sqrt(n / CELL)), FITTED // (8 * length)))
    most = max(1, min(PER_CENTROID * k, FITTED // length))
    # only entries with a small hash, about twice as many as are drawn, are sorted
    low = -(1 << 63) + min((1 << 64) - 1, (2 * most + 1000) * (1 << 64) // n)
    few = entries.where(F.xxhash64("v") <= F.lit(low))
    drawn = few.orderBy(F.xxhash64("v"), "v").limit(most).select("v").toArrow()
    x = _matrix(drawn.column("v").combine_chunks())
    return codebook(x[:, : length // 2], k), codebook(x[:, length // 2 :], k)


def build(entries: DataFrame, n: int) -> tuple[DataFrame, Index]:
    """The index over all ``entries``, and those with the number of their ``cell``."""
    spark = entries.sparkSession
    left, right = _fitted(entries, n)
    shared = spark.sparkContext.broadcast(Index(left, right, np.zeros(0, np.int64)))

    def place(batches: Batches) -> Batches:
        for batch in batches:
            cells = shared.value.cells(_matrix(batch.column(batch.schema.get_field_index("v"))))
            yield batch.append_column("cell", pa.array(cells, pa.int32()))

    kinds = ", ".join(f"{name} {kind}" for name, kind in entries.dtypes)
    placed = staged(entries.mapInArrow(place, f"{kinds}, cell int"), "cells")
    sizes = np.zeros(len(left) * len(right), np.int64)
    for cell, size in placed.groupBy("cell").count().collect():  # one row per cell
        sizes[cell] = size
    return placed, Index(left, right, sizes)


def enough_entries(placed: DataFrame, index: Index, queries: DataFrame, k: int, recall: float, sampled: int) -> int:
    """The number of entries to meet so that a share ``recall`` of sampled queries' neighbours is among them."""
    drawn = queries.orderBy(F.xxhash64("row_key"), "row_key").limit(sampled).select("v").toArrow()
    if not drawn.num_rows:
        return 1
    asked = _matrix(drawn.column("v").combine_chunks())
    shared = placed.sparkSession.sparkContext.broadcast(asked)

    def closest(batches: Batches) -> Batches:
        for batch in batches:
            q = shared.value
            cells = batch.column(batch.schema.get_field_index("cell")).to_numpy()
            squares = _squares(q, _matrix(batch.column(batch.schema.get_field_index("v"))))
            # the query's own entry is always met first
            squares[squares <= 1e-12 * (q * q).sum(axis=1)[:, None]] = np.inf
            least = np.argpartition(squares, min(k, squares.shape[1]) - 1, axis=1)[:, :k]
            number = np.repeat(np.arange(len(q)), least.shape[1])
            found = [number, squares[number, least.ravel()], cells[least.ravel()]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(found, (pa.int32(), pa.float64(), pa.int32()))], names=["q", "d", "cell"]
            )

    near = placed.select("v", "cell").mapInArrow(closest, "q int, d double, cell int").where("d < double('infinity')")
    ranked = near.withColumn("nth", F.row_number().over(Window.partitionBy("q").orderBy("d", "cell")))
    by_query: dict[int, list[int]] = {}
    for q, cell in ranked.where(F.col("nth") <= k).select("q", "cell").collect():  # k rows per sampled query
        by_query.setdefault(q, []).append(cell)
    left, right = index.distances(asked)
    needed = [n for q, cells in by_query.items() for n in index.needed(left[q], right[q], np.array(cells))]
    return int(sorted(needed)[math.ceil(recall * len(needed)) - 1]) if needed else 1


def blocks(sizes: np.ndarray, most: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """For each cell its first block and the number of its blocks; small neighbours share one."""
    first, parts = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    at, held = 0, 0
    for cell in np.flatnonzero(sizes):
        n = int(sizes[cell])
        if held and held + n > most:
            at, held = at + 1, 0
        first[cell], parts[cell] = at, -(-n // most)
        if n > most:
            at += parts[cell]
        else:
            held += n
    return first, parts


def _visits(queries: DataFrame, index: Index, first: np.ndarray, parts: np.ndarray, enough: int) -> DataFrame:
    """One row per query and block that it visits, with the cells it visits there."""
    shared = queries.sparkSession.sparkContext.broadcast((index, first, parts))

    def walk(batches: Batches) -> Batches:
        for batch in batches:
            index, first, parts = shared.value
            left, right = index.distances(_matrix(batch.column(batch.schema.get_field_index("v"))))
            which, at, cells = [], [], []
            for row in range(batch.num_rows):
                visited = np.array(index.visited(left[row], right[row], enough), np.int64)
                block = np.repeat(first[visited], parts[visited])
                step = np.arange(len(block)) - np.repeat(parts[visited].cumsum() - parts[visited], parts[visited])
                block, cell = block + step, np.repeat(visited, parts[visited])
                order = np.lexsort((cell, block))
                block, cell = block[order], cell[order]
                starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])[: len(block)]
                which += [row] * len(starts)
                at += block[starts].tolist()
                cells += np.split(cell, starts[1:]) if len(starts) else []
            kept = batch.take(pa.array(which, pa.int64()))
            made = [pa.array(at, pa.int64()), pa.array(cells, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([*kept.columns, *made], names=[*batch.schema.names, "block", "cells"])

    kinds = ", ".join(f"{name} {kind}" for name, kind in queries.dtypes)
    return queries.mapInArrow(walk, f"{kinds}, block long, cells array<int>")


def _reranked(rows: DataFrame, k: int) -> DataFrame:
    """Per query and block its ``k + 1`` nearest entries among those in the visited cells.

    ``rows`` stand in stretches of one block: its entries in the order of their cells, then the queries.
    """
    members = rows.schema["members"].dataType.simpleString()

    def rerank(batches: Batches) -> Batches:
        block, held, ready = None, [], None
        for batch in batches:
            get = lambda name: batch.column(batch.schema.get_field_index(name))  # noqa: B023, E731
            number, asked = get("block").to_numpy(), get("query").is_valid().to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(np.r_[True, (number[1:] != number[:-1]) | (asked[1:] != asked[:-1])])
            for start, end in zip(edges, [*edges[1:], batch.num_rows]):
                piece = batch.slice(start, end - start)
                if number[start] != block:
                    block, held, ready = number[start], [], None
                if not asked[start]:
                    held.append(piece.select(["cell", "v", "members"]))
                    continue
                if not held:  # a part of a large cell that no entry fell to
                    continue
                if ready is None:
                    whole = pa.Table.from_batches(held).combine_chunks()
                    matrix = _matrix(whole.column("v").chunk(0))
                    ids = [m[0]["id"] for m in whole.column("members").to_pylist()]
                    ids = np.array([np.iinfo(np.int64).max if i is None else i for i in ids], np.int64)
                    ready = matrix, whole.column("cell").to_numpy(), ids, whole.column("members").chunk(0)
                yield from answers(piece, *ready)

    def answers(queries, matrix, cells, ids, of):
        asked = _matrix(queries.column("v"))
        which, squares, rows = [], [], []
        for q, visited in enumerate(queries.column("cells").to_pylist()):
            low, high = np.searchsorted(cells, visited, "left"), np.searchsorted(cells, visited, "right")
            here = np.concatenate([np.arange(a, b) for a, b in zip(low, high)])
            if not len(here):
                continue
            d = ((matrix[here] - asked[q]) ** 2).sum(axis=1)
            if len(d) > k + 1:
                near = d <= np.partition(d, k)[k]  # ties included
                here, d = here[near], d[near]
            best = np.lexsort((ids[here], d))[: k + 1]
            which.append(np.full(len(best), q))
            squares.append(d[best])
            rows.append(here[best])
        if which:
            which, squares, rows = (np.concatenate(c) for c in (which, squares, rows))
            query = queries.column("query").take(pa.array(which))
            query_id = queries.column("query_id").take(pa.array(which))
            columns = [query, query_id, pa.array(squares, pa.float64()), of.take(pa.array(rows))]
            yield pa.RecordBatch.from_arrays(columns, names=["query", "query_id", "square", "members"])

    return rows.mapInArrow(rerank, f"query long, query_id long, square double, members {members}")


def search(
    vectors: DataFrame,
    key: str = "vec_id",
    embedding: str = "embedding",
    queries: str = QUERIES,
    k: int = NEIGHBOURS,
    recall: float = RECALL,
    sampled: int = SAMPLED,
    enough: int | None = None,
) -> DataFrame:
    """``query_id, rank, <key>, score``: the ``k`` nearest found for each row that ``queries`` (SQL) selects.

    Nearest by Euclidean distance (``score``), equal ones by the smaller key, null keys
    last; keys are whole numbers; a row is no candidate of its own, other rows with its vector or key are. A query
    gets as many rows as there are candidates if those are fewer than ``k``. Rows take no part whose vector is
    null, empty, zero, holds a null or non-finite component, or has another length than
    most rows (the shorter of equally frequent lengths stands). An empty table gives no rows, other columns
    play no part. ``enough`` sets the number of entries that a query meets; if it is not
    given, ``sampled`` queries decide it for the wanted ``recall``.
    """
    rows = _rows(vectors, key, embedding, queries)
    entries = staged(_entries(rows, k + 1), "entries")
    asked = rows.where("asked").select(F.col("row_key").alias("query"), F.col("id").alias("query_id"), "v")
    n = entries.count()
    if not n:
        found = asked.selectExpr("query_id", "0 AS rank", f"query_id AS `{key}`", "0d AS score")
        return found.where("false")
    placed, index = build(entries, n)
    if enough is None:
        enough = enough_entries(placed, index, rows.where("asked"), k, recall, sampled)
    # a query with less than k neighbours in its cells goes on
    first, parts = blocks(index.sizes)
    visits = _visits(asked, index, first, parts, max(enough, k + 1))

    spark = vectors.sparkSession
    used = np.flatnonzero(parts)
    places = pa.table({"cell": pa.array(used, pa.int32()), "first": first[used], "parts": parts[used]})
    places = spark.createDataFrame(places)  # one row per cell
    block = F.col("first") + F.pmod(F.xxhash64("v"), "parts")
    dealt = placed.join(F.broadcast(places), "cell").withColumn("block", block)
    none = {"query": "long", "query_id": "long", "cells": "array<int>"}
    dealt = dealt.withColumns({name: F.lit(None).cast(kind) for name, kind in none.items()}).drop("first", "parts")
    visits = visits.withColumns({"cell": F.lit(None).cast("int"), "members": F.lit(None).cast(placed.schema["members"].dataType)})
    both = dealt.unionByName(visits).repartition("block")
    both = both.sortWithinPartitions("block", F.col("query").asc_nulls_first(), "cell")

    found = _reranked(both, k).select("query", "query_id", "square", F.explode("members").alias("m"))
    found = found.where(F.col("m.row_key") != F.col("query"))
    order = Window.partitionBy("query").orderBy("square", F.col("m.id").asc_nulls_last(), "m.row_key")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("m.id").alias(key), F.sqrt("square").alias("score"))


def query(spark, sf_dir: str) -> DataFrame:
    """The ten nearest neighbours of every hundredth embedding among all others."""
    return search(table(spark, sf_dir, "embeddings"))
