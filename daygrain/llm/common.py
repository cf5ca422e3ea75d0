"""What the operators share: row keys, stage tables, Arrow passes, words and components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daygrain.session import shared_dir

Batches = Iterator[pa.RecordBatch]
#: Rows of a batch that are handed on at once: a whole one of long texts takes a worker and its JVM some 100 MB more.
ROWS_AT_ONCE = 1000

#: Bytes to lower-cased word bytes: A-Z become a-z, 0-9, a-z and all above 7F stay, the rest separates.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256)
)


def code_words(text: bytes | None) -> list[bytes]:
    """Words of digits, letters and non-ASCII characters, A-Z in lower case; none for null."""
    return text.translate(WORD_BYTES).split() if text else []


def blank_words(text: bytes | None) -> list[bytes]:
    """Runs without ASCII white space, unchanged; none for null."""
    return text.split() if text else []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back.

    Cuts the lineage with files that every executor can read, so that a lost executor costs
    a reread and no recomputation.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keyed(df: DataFrame, name: str) -> DataFrame:
    """``df`` staged with ``row_key``, a number that tells equal rows apart."""
    return staged(df.withColumn("row_key", F.monotonically_increasing_id()), name)


def crc_fold(key: str, folds: int = 5) -> F.Column:
    """crc32 of the key as text, modulo ``folds``; null for a null key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % folds


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column."""
    return column.cast(pa.large_binary()).to_pylist()


def stretches(batches: Batches) -> Batches:
    """The batches in parts of at most ROWS_AT_ONCE rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)


def with_columns(df: DataFrame, inputs: list[str], fields: str, fn: Callable[..., list[pa.Array]]) -> DataFrame:
    """``df`` and the columns that ``fn`` computes, row by row, from stretches of ``inputs``, without a shuffle.

    ``fields`` is their DDL. A column of ``df`` that has the name of a new one gives way to it,
    unless it is an input: that is an error.
    """
    new = df.sparkSession.createDataFrame([], fields).schema
    names = [f.name for f in new]
    if clash := set(names) & set(inputs):
        raise ValueError(f"inputs {sorted(clash)} have names of results")
    kept = df.drop(*names)

    def run(batches: Batches) -> Batches:
        for rows in stretches(batches):
            made = fn(*[rows.column(c) for c in inputs])
            yield pa.RecordBatch.from_arrays([*rows.columns, *made], names=[*rows.schema.names, *names])

    return kept.mapInArrow(run, StructType([*kept.schema.fields, *new.fields]))


def components(edges: DataFrame, src: str, dst: str, name: str) -> DataFrame:
    """(node, component): the smallest node that each node of ``edges`` reaches.

    Large-star and small-star steps in turn until no edge changes: every edge is drawn to
    the least neighbour of one of its ends. A hub's neighbours are never gathered in one
    place: its least neighbour is an aggregate, joined back to the edges.
    """
    def step(pairs: DataFrame, large: bool) -> DataFrame:
        """pairs (a > b). Large: every larger neighbour of a node, small: every smaller one, goes to the least."""
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else pairs
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        linked = both.join(least, "a")
        if large:
            out = linked.where("b > a").selectExpr("b AS a", "m AS b")
        else:
            out = linked.selectExpr("b AS a", "m AS b").unionByName(linked.selectExpr("a", "m AS b"))
        return out.where("a <> b").distinct()

    def mark(pairs: DataFrame) -> tuple:
        row = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return row[0], row[1]

    pairs = edges.select(F.greatest(src, dst).alias("a"), F.least(src, dst).alias("b")).where("a <> b").distinct()
    pairs = staged(pairs, name)
    state = mark(pairs)
    while state[0]:
        pairs = staged(step(step(pairs, large=True), large=False), name)
        before, state = state, mark(pairs)
        if before == state:
            break
    roots = pairs.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return pairs.selectExpr("a AS node", "b AS component").unionByName(roots)
