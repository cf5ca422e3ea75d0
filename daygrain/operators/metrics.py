"""ROC AUC and log loss as relational jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def auc(scored: DataFrame, score: str, label: str, by: Sequence[str] = (), ranges: int | None = None) -> DataFrame:
    """Exact area under the ROC curve, ties counted half; NULL without both classes.

    Rows are first counted per score. The scores are dealt into ranges that Spark draws
    from the counted scores, so each has about as many, however close they lie; a running
    sum of negatives inside each range and a second one over the ranges replace a single
    window over all scores. ``ranges`` is their number, by default the shuffle partitions.
    """
    by = list(by)
    counts = scored.groupBy(*by, F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    order = [*by, "score"]
    counts = counts.repartitionByRange(ranges, *order) if ranges else counts.repartitionByRange(*order)
    counts = counts.withColumn("range", F.spark_partition_id())
    inside = Window.partitionBy(*by, "range").orderBy("score")
    below = F.sum("neg").over(inside) - F.col("neg")
    totals = (
        counts.withColumn("won", F.col("pos") * (below + F.col("neg") / 2))
        .groupBy(*by, "range")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum("won").alias("won"))
    )
    # at most one row per group and range is left here
    over_ranges = Window.partitionBy(*(by or [F.lit(0)])).orderBy("range")
    below_range = F.sum("neg").over(over_ranges) - F.col("neg")
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return (
        totals.withColumn("won", F.col("won") + F.col("pos").cast("double") * below_range)
        .groupBy(*by)
        .agg((F.sum("won") / F.nullif(pairs, F.lit(0.0))).alias("auc"))
    )


def log_loss(scored: DataFrame, score: str, label: str, by: Sequence[str] = (), eps: float = 2.0**-52) -> DataFrame:
    """Mean negative log likelihood of 0/1 labels, scores clipped away from 0 and 1."""
    p = F.least(F.greatest(F.col(score), F.lit(eps)), F.lit(1 - eps))
    loss = -F.when(F.col(label) == 1, F.ln(p)).otherwise(F.ln(1 - p))
    return scored.groupBy(*by).agg(F.avg(loss).alias("log_loss"))
