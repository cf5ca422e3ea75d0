"""A small ensemble of trees with given splits, run through the rules of the model stage.

The trained trees have no counterpart in SQL. These do, so that the choice of rounds, the
scoring and the split counts can be checked on the same feature matrix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daygrain.operators.metrics import auc, log_loss
from daygrain.plans import model

# A node is (feature, threshold, left, right): up to the threshold, or missing, goes left. A number is a leaf;
# leaves are multiples of 1/16, so that sums are exact and equal scores are equal in any order of addition.
TREES = (
    ("register_days", 7.5, ("activity_day_uni", 1.5, -0.3125, 0.375), 0.625),
    ("launch_day_count", 1.5, -0.1875, ("activity_day_count", 3.5, 0.125, 0.5)),
    ("last_act_time", 4.5, ("activity_day_diff_mean", 1.25, 0.3125, 0.1875), -0.4375),
    ("create_day_uni", 0.5, -0.125, 0.1875),
    ("act_max_lx_days", 1.5, 0.0625, ("last_act_time", 0.5, 0.125, -0.125)),
    ("ls_day3_activity_cout", 0.7, -0.25, 0.375),
    ("activity_day_count", 6.5, ("register_days", 20.5, -0.125, 0.3125), -0.1875),
    ("launch_day_diff_max", 5.5, 0.125, -0.125),
)
PATIENCE = 3
FEATURES = tuple(sorted({"activity_day_uni", *model.MODEL_FEATURES}))


def tree_sql(node) -> str:
    """SQL of a tree's output over the matrix."""
    if not isinstance(node, tuple):
        return f"{node}d"
    feature, threshold, left, right = node
    return f"IF(coalesce({feature}, {model.MISSING}d) <= {threshold}d, {tree_sql(left)}, {tree_sql(right)})"


def splits(node) -> list[str]:
    return [node[0], *splits(node[2]), *splits(node[3])] if isinstance(node, tuple) else []


def scored(matrix: DataFrame, interval: int, trees: int = len(TREES)) -> DataFrame:
    """``user_id, label, scores`` of an interval: the probability after each tree."""
    rows = matrix.where(F.col("interval_id") == interval)
    return model.prefix_scores(rows, [tree_sql(t) for t in TREES[:trees]]).select("user_id", "label", "scores")


def round_auc(matrix: DataFrame) -> DataFrame:
    """``round, auc`` on the validation interval."""
    long = scored(matrix, model.VALIDATION).select("label", F.posexplode("scores").alias("round", "score"))
    return auc(long, "score", "label", by=["round"]).select((F.col("round") + 1).alias("round"), "auc")


def best_round(matrix: DataFrame) -> int:
    return model.pick_round(model.auc_of_rounds(scored(matrix, model.VALIDATION)), PATIENCE)


def choice(matrix: DataFrame) -> DataFrame:
    """One row: ``best_round, auc, log_loss``."""
    best = best_round(matrix)
    chosen = scored(matrix, model.VALIDATION, best).select(
        "label", F.element_at("scores", -1).alias("result"), F.lit(best).alias("best_round")
    )
    by = ["best_round"]
    return auc(chosen, "result", "label", by).join(log_loss(chosen, "result", "label", by), by)


def submission(matrix: DataFrame) -> DataFrame:
    """``user_id, result`` of the score interval, by all trees."""
    return scored(matrix, model.SCORE).select("user_id", F.element_at("scores", -1).alias("result"))


def importances(matrix: DataFrame) -> DataFrame:
    """``feature, important, place`` by the chosen trees; ``place`` counts from the fewest splits."""
    spark = matrix.sparkSession
    position = {name: i for i, name in enumerate(FEATURES)}
    nodes = [(number, position[name]) for number, tree in enumerate(TREES) for name in splits(tree)]
    counted = model.split_counts(
        spark.createDataFrame(nodes, "tree int, position int"),
        spark.createDataFrame([(i, name) for name, i in position.items()], "position int, feature string"),
        best_round(matrix),
    )
    # one row per input
    return counted.withColumn("place", F.row_number().over(Window.orderBy("important", "feature")))
