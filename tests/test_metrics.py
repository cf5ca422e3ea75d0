import math
import random

import pytest
from daygrain.operators.metrics import auc, log_loss
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F


def brute_auc(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    return sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))


def frame(spark, rows):
    return spark.createDataFrame([(float(s), float(y)) for s, y in rows], "score double, label double")


def test_ties_count_half(spark):
    df = frame(spark, [(0.1, 0), (0.4, 0), (0.4, 1), (0.8, 1)])
    assert auc(df, "score", "label").first().auc == 0.875


@pytest.mark.parametrize("ranges", [1, 3, None])
def test_auc_matches_brute_force_and_evaluator(spark, ranges):
    rng = random.Random(3)
    rows = [(rng.choice([rng.random(), round(rng.random(), 1)]), rng.randint(0, 1)) for _ in range(400)] + [(0.0, 1), (1.0, 0)]
    df = frame(spark, rows)
    got = auc(df, "score", "label", ranges=ranges).first().auc
    assert math.isclose(got, brute_auc(rows), rel_tol=1e-12)
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    assert math.isclose(got, evaluator.evaluate(df), rel_tol=1e-9)


def test_one_class_gives_null(spark):
    assert auc(frame(spark, [(0.1, 1), (0.2, 1)]), "score", "label").first().auc is None


def test_log_loss_clips(spark):
    df = frame(spark, [(0.5, 1), (0.25, 0), (0.0, 0)])
    want = -(math.log(0.5) + math.log(0.75)) / 3
    assert math.isclose(log_loss(df, "score", "label").first().log_loss, want, abs_tol=1e-12)
    assert math.isfinite(log_loss(frame(spark, [(0.0, 1)]), "score", "label").first().log_loss)


def test_close_scores_are_dealt_evenly(spark):
    """All scores inside 1e-6: no window meets more than a few ranges' share, and the area is right."""
    df = spark.range(40_000).selectExpr("0.5 + double(id) / 4e10 AS score", "int(id % 3 = 0) AS label")
    assert math.isclose(auc(df, "score", "label", ranges=40).first().auc, brute_of_thirds(40_000), rel_tol=1e-12)
    dealt = df.select("score").repartitionByRange(40, "score").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in dealt) < 4 * 40_000 / 40


def brute_of_thirds(n):
    below = won = pos = 0
    for i in range(n):
        if i % 3 == 0:
            won, pos = won + below, pos + 1
        else:
            below += 1
    return won / (pos * below)
