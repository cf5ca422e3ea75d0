"""Vector code compression: product codes by Lloyd's rounds over parts that stay with their entry.

A vector of whole numbers is cut into parts, one per position, and each position has a
codebook. Every part is a row of its own that resides with its entry: rows are dealt by
(position, entry, salt), where the salt, a hash of the row, spreads an entry that holds
a great share of all parts. A round is three steps.

1. The owners add up their resident members, (position, entry, salt) by (position, entry,
   salt); the few sums of the salts give the new entries.
2. Each part is assigned in the place where it resides. Rows whose entry stays are written
   next to each other, rows whose entry changes apart.
3. Only the latter are shuffled to their new owner, and join its residents as a further
   set of files.

All arithmetic is on whole numbers: in doubles while they are exact, else in Python's
integers, so entries and ties don't depend on the order of rows or on the number of tasks.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.llm.common import Batches, keyed, staged, table
from daygrain.session import shared_dir

SCALE, POSITIONS, ENTRIES, ROUNDS = 1024, 4, 256, 4
#: Whole numbers beyond this are taken as this: their squares could not be returned anyway.
LARGEST = 1 << 62
MOST_LONG = (1 << 63) - 1
#: A label with more than this share of the rows counts as hot; there are fewer than its inverse.
HOT_SHARE = 1 / 256
#: Rows assigned at once: their distances to all entries are held in memory.
ROWS = 4096

#: position -> its entries, as lists of whole numbers in the order of their index.
Codebooks = dict[int, list[list[int]]]


@dataclass(frozen=True)
class Compressed:
    """Codes of a table of vectors.

    ``codes`` has the key, ``label`` and ``row_key`` of each kept row with its ``entries``
    (array<int> by position) and its ``error`` (long).
    """

    codes: DataFrame
    codebooks: Codebooks


def usable(v: str) -> str:
    """SQL: the vector is there, has components, and all are finite numbers."""
    return f"size({v}) > 0 AND forall({v}, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"


def _whole(vectors: DataFrame, key: str, embedding: str, label: str, scale: int, positions: int) -> DataFrame:
    """Kept rows: ``row_key, id, label, v``, the components being whole numbers."""
    named = vectors.select(F.col(key).alias("id"), F.col(embedding).alias("v"), F.col(label).alias("label"))
    kept = named.where(usable("v")).where(F.size("v") % positions == 0)
    # scaling by a power of two is exact; a double beyond the bounds of a long has no fraction
    scaled = f"floor(double(x) * {scale}d)"
    long = f"""transform(v, x -> CASE WHEN double(x) * {scale}d >= {LARGEST}d THEN {LARGEST}L
        WHEN double(x) * {scale}d <= -{LARGEST}d THEN -{LARGEST}L ELSE bigint({scaled}) END)"""
    rows = keyed(kept.withColumn("v", F.expr(long)), "vectors")
    length = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (length["n"] if length else 0))


def _first_entries(rows: DataFrame, positions: int, entries: int) -> Codebooks:
    """The parts of the rows with the smallest keys. At most ``entries`` rows reach the driver."""
    first = rows.orderBy(F.col("id").asc_nulls_last(), "v", "row_key").limit(entries).select("v").collect()
    return {p: [list(np.array_split(np.array(r["v"], object), positions)[p]) for r in first] for p in range(positions)}


def nearest(parts: np.ndarray, entries: list[list[int]]) -> tuple[np.ndarray, list[int] | np.ndarray]:
    """The index of each part's nearest entry, the lower of equally near ones, and the squared distance."""
    book = np.array(entries, object).reshape(len(entries), -1)
    reach = max(int(abs(parts).max(initial=0)), max((abs(int(x)) for x in book.flat), default=0))
    if parts.shape[1] * (2 * reach) ** 2 < 1 << 53:  # then every term and sum below is a whole number in a double
        book = book.astype(np.float64)
        halves = (book * book).sum(axis=1) - 2.0 * (parts.astype(np.float64) @ book.T)
        index = halves.argmin(axis=1)
        own = (parts * parts).sum(axis=1)
        return index, halves[np.arange(len(parts)), index].astype(np.int64) + own
    index, errors = [], []
    for part in parts.astype(object):
        squares = ((book - part) ** 2).sum(axis=1)
        index.append(min(range(len(book)), key=lambda i: squares[i]))  # noqa: B023
        errors.append(min(int(squares[index[-1]]), MOST_LONG))
    return np.array(index, np.int32), errors


def _assigned(rows: DataFrame, codebooks: Codebooks) -> DataFrame:
    """``rows`` (row_key, position, entry, salt, part) with ``to``, the nearest entry now, ``error`` and ``moved``."""
    shared = rows.sparkSession.sparkContext.broadcast(codebooks)  # as large as ``entries`` vectors

    def run(batches: Batches) -> Batches:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                column = batch.column(batch.schema.get_field_index("part"))
                parts = column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                position = batch.column(batch.schema.get_field_index("position")).to_numpy()
                to = np.zeros(batch.num_rows, np.int32)
                error = np.zeros(batch.num_rows, np.int64)
                for p in np.unique(position):
                    here = np.flatnonzero(position == p)
                    to[here], error[here] = nearest(parts[here], shared.value[int(p)])
                home = batch.column(batch.schema.get_field_index("entry")).to_numpy()
                made = [pa.array(to), pa.array(error), pa.array(to != home)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, *made], names=[*batch.schema.names, "to", "error", "moved"]
                )

    fields = "row_key long, position int, entry int, salt int, part array<long>, to int, error long, moved boolean"
    return rows.select("row_key", "position", "entry", "salt", "part").mapInArrow(run, fields)


def _settled(rows: DataFrame, codebooks: Codebooks) -> DataFrame:
    """The assigned rows with those that stay left in place and those that move dealt to their new owners.

    The rows are read once and written where they are; the second write is of movers alone.
    """
    spark = rows.sparkSession
    path = f"{shared_dir(spark)}/parts-{uuid.uuid4().hex}"
    assigned = _assigned(rows, codebooks)
    # by folder, so that neither side reads the other's files
    assigned.write.partitionBy("moved").option("compression", "zstd").parquet(path)
    written = spark.read.schema(assigned.schema).parquet(path)
    kept = ["row_key", "position", F.col("to").alias("entry"), "salt", "part", "error"]
    movers = written.where("moved").select(*kept)
    arrived = staged(movers.repartition("position", "entry", "salt"), "arrived")
    return written.where("NOT moved").select(*kept).unionByName(arrived)


def _updated(members: DataFrame, codebooks: Codebooks, kind: str) -> Codebooks:
    """Entries moved to the floor of their members' mean; unused ones stay.

    The sums have the type ``kind``. One row per entry reaches the driver.
    """
    width = len(codebooks[0][0])
    sums = [f"sum(cast(part[{i}] AS {kind})) AS s{i}" for i in range(width)]
    totals = [f"sum(s{i}) AS s{i}" for i in range(width)]
    sql = members.sparkSession.sql
    owners = sql(
        f"SELECT position, entry, salt, count(*) AS n, {', '.join(sums)} FROM {{members}} GROUP BY position, entry, salt",
        members=members,
    )
    of = sql(
        f"SELECT position, entry, sum(n) AS n, {', '.join(totals)} FROM {{owners}} GROUP BY position, entry", owners=owners
    )
    updated = {p: [list(e) for e in book] for p, book in codebooks.items()}
    for r in of.collect():  # one row per entry
        updated[r["position"]][r["entry"]] = [int(r[f"s{i}"]) // r["n"] for i in range(width)]
    return updated


def compress(
    vectors: DataFrame,
    key: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    scale: int = SCALE,
    positions: int = POSITIONS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> Compressed:
    """Codes and codebooks of ``vectors``; component x counts as the whole number floor(scale * x).

    Rows are dropped whose vector is null, empty, holds a null or non-finite component, or
    has a length that ``positions`` doesn't divide; of several lengths the most frequent
    one is kept, the shorter of equally frequent ones. The codebooks start from the
    ``entries`` smallest keys (null keys last, equal keys in the order of their vectors), or
    from all rows if there are fewer. Rows with equal keys are rows of their own. Whole numbers beyond 2^62 count as
    that, errors beyond a long's range as its largest value. An empty table gives no rows.
    Other columns play no part.
    """
    rows = _whole(vectors, key, embedding, label, scale, positions)
    n, reach = rows.agg(F.count("*"), F.max(F.array_max(F.transform("v", lambda x: F.abs(x))))).first()
    kind = "bigint" if n * (reach or 0) < LARGEST else "decimal(38,0)"
    codebooks = _first_entries(rows, positions, entries)
    if not n:
        none = rows.selectExpr("row_key", "id", "label", "cast(NULL AS array<int>) AS entries", "0L AS error")
        return Compressed(none.select(F.col("id").alias(key), *none.columns[2:], "row_key"), codebooks)
    width = len(codebooks[0][0])
    salts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    pieces = ", ".join(f"slice(v, {p * width + 1}, {width})" for p in range(positions))
    parts = rows.selectExpr(
        "row_key", f"posexplode(array({pieces})) AS (position, part)", "-1 AS entry",
        f"int(pmod(xxhash64(row_key), {salts})) AS salt",
    )
    members = _settled(parts, codebooks)
    for number in range(1, rounds + 1):
        codebooks = _updated(members, codebooks, kind)
        if number < rounds:
            members = _settled(members, codebooks)
    final = _assigned(members, codebooks)
    by_position = F.transform(F.sort_array(F.collect_list(F.struct("position", "to"))), lambda x: x["to"])
    # the rows of one vector: as many as there are positions
    coded = final.groupBy("row_key").agg(by_position.alias("entries"), _long_sum("error").alias("error"))
    codes = rows.select(F.col("id").alias(key), "label", "row_key").join(coded, "row_key")
    return Compressed(codes.select(key, "label", "entries", "error", "row_key"), codebooks)


def _long_sum(column: str) -> F.Column:
    """The sum as a long, or the largest long if it is beyond."""
    return F.least(F.sum(F.col(column).cast("decimal(38,0)")), F.lit(MOST_LONG).cast("decimal(38,0)")).cast("long")


def digest(codebooks: Codebooks) -> str:
    numbers = (str(x) for p in sorted(codebooks) for entry in codebooks[p] for x in entry)
    return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def with_label_error(codes: DataFrame) -> DataFrame:
    """``codes`` and ``label_error``: the error summed over the rows of an equal label, nulls being one.

    The sums of hot labels, fewer than 256, are broadcast; any other label has too few rows
    to burden the task in which its rows meet their sum.
    """
    sums = codes.groupBy("label").agg(_long_sum("error").alias("label_error"), F.count("*").alias("n"))
    sums = staged(sums, "labels")
    bound = HOT_SHARE * (sums.agg(F.sum("n")).first()[0] or 0)
    sums = sums.withColumnRenamed("label", "of")
    hot, cold = sums.where(F.col("n") > bound).drop("n"), sums.where(F.col("n") <= bound).drop("n")
    same = F.col("label").eqNullSafe(F.col("of"))
    near = codes.join(F.broadcast(hot), same).drop("of")
    rest = codes.join(F.broadcast(hot.select("of")), same, "left_anti")
    return near.unionByName(rest.join(cold, same).drop("of"))


def query(spark, sf_dir: str) -> DataFrame:
    """Codes of all embeddings, 256 entries for each of four parts."""
    made = compress(table(spark, sf_dir, "embeddings"))
    codes = with_label_error(staged(made.codes, "codes"))
    code = F.array_join(F.transform("entries", lambda x: F.lower(F.lpad(F.hex(x), 2, "0"))), "")
    return codes.select(
        "vec_id", code.alias("code"), "error", "label_error", F.lit(digest(made.codebooks)).alias("codebooks_sha256")
    )
