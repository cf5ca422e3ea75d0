"""Gaps between a user's consecutive rows in file order.

The statistics come from the day table as long as the days of a user, in whatever order, don't
mix. Of the other users, each split of the log is reduced to one ordered summary a user, and the
summaries are folded in file order: a user may hold a third of a log, but has few
summaries. If the splits themselves interleave, rows are dealt by ranges of (log, user, seq)
that Spark draws from the rows, so every range has about as many rows, however they
cluster. The gaps inside a range come from a window over the user's rows in it, and the one
gap that spans two ranges is filled in from their last and first days.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daygrain.functions.stats import aggregate, sample_skewness
from daygrain.operators.day_stats import gap_stats, summarise_windows
from daygrain.operators.day_table import GROUP, cut_days, day_table, mixed_days, tasks_for
from daygrain.operators.intervals import Interval, assign_intervals
from daygrain.session import staged

Batches = Iterator[pa.RecordBatch]

USER = ("log", "user_id")
# Rows of a split summarised at once, and the number of users up to which they are broadcast as a filter.
SUMMARISED, FEW_USERS = 1 << 20, 1 << 17


def split_rows(stacked: DataFrame, pieces: int | None = None) -> DataFrame:
    """``log, user_id, day, seq, piece``: rows with the number of the range they are in.

    There are ``pieces`` ranges, by default as many as Spark's shuffle partitions.
    """
    rows = stacked.select(*USER, "day", "seq")
    order = [*USER, "seq"]
    dealt = rows.repartitionByRange(pieces, *order) if pieces else rows.repartitionByRange(*order)
    return dealt.withColumn("piece", F.spark_partition_id())


def _gaps_in_pieces(rows: DataFrame, intervals: Sequence[Interval]) -> DataFrame:
    """The cut rows with ``gap`` to the previous row of the piece; NULL on its first row."""
    order = Window.partitionBy(*GROUP, "piece").orderBy("seq")
    return (
        assign_intervals(rows, "day", intervals)
        .withColumnRenamed("log", "part")
        .withColumn("gap", F.col("day") - F.lag("day").over(order))
    )


def day_gaps(stacked: DataFrame, intervals: Sequence[Interval], pieces: int | None = None) -> DataFrame:
    """Each cut row with its gap in days to the user's previous row; 0 on the first row.

    One plan without a branch, since ranges drawn twice need not agree. The second window
    meets a user's first rows of all ranges, at most one a range; other rows pass it in
    groups of their range.
    """
    rows = _gaps_in_pieces(split_rows(stacked, pieces), intervals)
    whole = Window.partitionBy(*GROUP, "piece")
    rows = rows.withColumn("last_of_piece", F.max_by("day", "seq").over(whole))
    rows = rows.withColumn("slot", F.when(F.col("gap").isNull(), -1).otherwise(F.col("piece")))
    before = F.lag("last_of_piece").over(Window.partitionBy(*GROUP, "slot").orderBy("seq"))
    gap = F.coalesce(F.col("gap"), F.col("day") - before, F.lit(0))
    return rows.select(*GROUP, "seq", "day", gap.alias("gap"))


def row_gap_stats(stacked: DataFrame, intervals: Sequence[Interval], pieces: int | None = None) -> DataFrame:
    """Gap statistics per (interval, user, part), from the rows.

    Each piece is reduced to its sums and end points; the gap that enters a piece is
    added from the end of the piece before.
    """
    gap = F.col("gap").cast("long")
    reduced = (
        _gaps_in_pieces(split_rows(stacked, pieces), intervals)
        .groupBy(*GROUP, "piece")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(gap).alias("s1"),
            F.sum(gap * gap).alias("s2"),
            F.sum(gap * gap * gap).alias("s3"),
            F.max("gap").alias("largest"),
            F.min("gap").alias("smallest"),
            F.max_by("gap", "seq").alias("last_gap"),
            F.min_by("day", "seq").alias("first_day"),
            F.max_by("day", "seq").alias("last_day"),
        )
    )
    order = Window.partitionBy(*GROUP).orderBy("piece")
    entry = F.coalesce(F.col("first_day") - F.lag("last_day").over(order), F.lit(0)).cast("long")
    joined = reduced.withColumn("entry", entry)

    sums = [f"sum(coalesce(s{power}, 0) + {' * '.join(['entry'] * power)})" for power in (1, 2, 3)]
    return aggregate(
        joined,
        GROUP,
        [
            "bigint(max(greatest(largest, entry))) AS diff_max",
            "bigint(min(least(smallest, entry))) AS diff_min",
            f"{sums[0]} / sum(n) AS diff_mean",
            f"{sample_skewness('sum(n)', *sums)} AS diff_ske",
            # a piece of one row has no gap of its own: its only gap is the entry
            "bigint(max_by(coalesce(last_gap, entry), piece)) AS diff_last",
        ],
    )


def out_of_order_users(days: DataFrame) -> DataFrame:
    """(log, user_id) of which rows of two days mix in file order, from the day table."""
    by_file = f"PARTITION BY {', '.join(USER)} ORDER BY first_seq"
    sql = f"""
        SELECT DISTINCT {', '.join(USER)} FROM (
          SELECT {', '.join(USER)}, {mixed_days(by_file)} AS mixed FROM {{days}} WHERE log <> 'register')
        WHERE mixed
    """
    return days.sparkSession.sql(sql, days=days)


_SUMS = "n long, s1 long, s2 long, s3 long, largest int, smallest int, last_gap int, first_day int, last_day int"


def split_summaries(stacked: DataFrame, intervals: Sequence[Interval], rows: int = SUMMARISED) -> DataFrame:
    """An ordered summary of each user's rows of a split, per interval; no row is shuffled.

    ``n`` rows from ``first_seq`` to ``last_seq``, their first and last day, and the power
    sums, the largest, smallest and last of the gaps between them (NULL for one row). Two
    summaries of which one ends before the other begins add up to that of all their rows.
    A split's rows are sorted where they are and summarised up to ``rows`` at a time, so a
    user has one summary a split, or a few of a large one.
    """
    seq = stacked.schema["seq"].dataType.simpleString()

    bounds = [(iv.interval_id, iv.begin, iv.end) for iv in intervals]
    sorted_rows = stacked.where("log <> 'register'").select(*USER, "day", "seq").sortWithinPartitions(*USER, "seq")
    return sorted_rows.mapInArrow(
        _summariser(bounds, rows),
        f"interval_id int, user_id long, part string, first_seq {seq}, last_seq {seq}, {_SUMS}",
    )


def _summariser(bounds: list[tuple[int, int, int]], rows: int) -> Callable[[Batches], Batches]:
    """The summaries of batches of rows in the order of (log, user_id, seq).

    Workers get this function whole: they need not import the library.
    """

    def run(batches: Batches) -> Batches:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= rows:
                yield from summaries(pa.Table.from_batches(held).combine_chunks())
                held, n = [], 0
        if n:
            yield from summaries(pa.Table.from_batches(held).combine_chunks())

    def summaries(table: pa.Table) -> Batches:
        log = table.column("log").chunk(0).dictionary_encode().indices.to_numpy()
        user, day = table.column("user_id").to_numpy(), table.column("day").to_numpy()
        for interval_id, begin, end in bounds:
            at = np.flatnonzero((day >= begin) & (day <= end))
            if not len(at):
                continue
            starts = np.r_[True, (user[at][1:] != user[at][:-1]) | (log[at][1:] != log[at][:-1])]
            first = np.flatnonzero(starts)
            last = np.r_[first[1:], len(at)] - 1
            gap = np.r_[0, np.diff(day[at].astype(np.int64))]
            gap[first] = 0
            # the first row has no gap inside the split: it must not count as one of 0
            far = np.iinfo(np.int32).max
            extremes = {
                "largest": np.maximum.reduceat(np.where(starts, -far, gap), first),
                "smallest": np.minimum.reduceat(np.where(starts, far, gap), first),
                "last_gap": gap[last],
            }
            ends = [pa.array(at[x], pa.int64()) for x in (first, last)]
            columns = {
                "interval_id": pa.array(np.full(len(first), interval_id, np.int32)),
                "user_id": table.column("user_id").take(ends[0]),
                "part": table.column("log").take(ends[0]),
                "first_seq": table.column("seq").take(ends[0]),
                "last_seq": table.column("seq").take(ends[1]),
                "n": pa.array(last - first + 1, pa.int64()),
                **{f"s{p}": pa.array(np.add.reduceat(gap**p, first), pa.int64()) for p in (1, 2, 3)},
                **{name: pa.array(x.astype(np.int32), mask=first == last) for name, x in extremes.items()},
                "first_day": pa.array(day[at[first]], pa.int32()),
                "last_day": pa.array(day[at[last]], pa.int32()),
            }
            yield from pa.table(columns).combine_chunks().to_batches()

    return run


def folded_gap_stats(summaries: DataFrame) -> DataFrame:
    """Gap statistics per (interval, user, part) from its summaries in file order.

    ``interleaved``: some summaries overlap in the file, and the statistics don't hold.
    """
    order = f"PARTITION BY {', '.join(GROUP)} ORDER BY first_seq"
    joined = summaries.sparkSession.sql(
        f"""SELECT *, bigint(coalesce(first_day - lag(last_day) OVER ({order}), 0)) AS entry,
              coalesce({mixed_days(order)}, false) AS overlaps
            FROM {{summaries}}""",
        summaries=summaries,
    )
    sums = [f"sum(s{power} + {' * '.join(['entry'] * power)})" for power in (1, 2, 3)]
    return aggregate(
        joined,
        GROUP,
        [
            "bigint(max(greatest(largest, entry))) AS diff_max",
            "bigint(min(least(smallest, entry))) AS diff_min",
            f"{sums[0]} / sum(n) AS diff_mean",
            f"{sample_skewness('sum(n)', *sums)} AS diff_ske",
            "bigint(max_by(coalesce(last_gap, entry), last_seq)) AS diff_last",
            "max(overlaps) AS interleaved",
        ],
    )


def late_gap_stats(
    stacked: DataFrame, days: DataFrame, intervals: Sequence[Interval], pieces: int | None = None
) -> DataFrame | None:
    """Gap statistics of the users whose days mix in file order; None if there are none.

    Splits of a file follow each other, so one summary per split and user is shuffled and
    folded. Only users whose splits interleave, as after a shuffle of the log, have their rows
    dealt by ranges. The users and the summaries are staged, since each step decides about the next.
    """
    late = staged(out_of_order_users(days), "late")
    n = late.count()
    if not n:
        return None
    few = n <= FEW_USERS
    rows = stacked.join(F.broadcast(late), list(USER), "left_semi") if few else stacked
    summaries = split_summaries(rows, intervals)
    if not few:
        summaries = summaries.join(late.withColumnRenamed("log", "part"), ["part", "user_id"], "left_semi")
    folded = staged(folded_gap_stats(summaries), "gaps")
    scattered = folded.where("interleaved").select(F.col("part").alias("log"), "user_id").distinct()
    if scattered.isEmpty():
        return folded.drop("interleaved")
    from_rows = row_gap_stats(stacked.join(scattered, list(USER), "left_semi"), intervals, pieces)
    kept = folded.join(scattered.withColumnRenamed("log", "part"), ["part", "user_id"], "left_anti")
    return kept.select(*from_rows.columns).unionByName(from_rows)


GAP_STATS = ("diff_max", "diff_min", "diff_mean", "diff_ske", "diff_last")


def complete_gap_stats(stacked: DataFrame, intervals: Sequence[Interval], pieces: int | None = None) -> DataFrame:
    """Gap statistics of every (interval, user, part): from the staged day table where it tells, else from the rows."""
    days = staged(day_table(stacked), "days")
    cut = cut_days(days, intervals)
    from_days = summarise_windows(cut, gap_stats(), tasks_for(cut)).drop("out_of_order")
    late = late_gap_stats(stacked, days, intervals, pieces)
    if late is None:
        return from_days.select(*GROUP, *GAP_STATS)
    late = late.withColumnsRenamed({s: f"late_{s}" for s in GAP_STATS})
    filled = [F.coalesce(s, f"late_{s}").alias(s) for s in GAP_STATS]
    return from_days.join(late, list(GROUP), "left").select(*GROUP, *filled)
