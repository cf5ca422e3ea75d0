"""Train on interval 1, validate on interval 2, refit on both, score interval 3.

Training goes round by round, each tree fitted to the gradient of the logistic loss at the
margins carried so far, and stops when the validation AUC has not risen for a while: trees
that would not be used are not fitted. A model is scored by its trees or, to the same
numbers, by a walk over its node table.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.operators.metrics import auc, log_loss
from daygrain.plans.features import MODEL_FEATURES
from daygrain.session import shared_dir, staged
from daygrain.sources.logs import LOGS

TRAIN, VALIDATION, SCORE = 1, 2, 3

# Trees fitted between two looks at the validation rows, which evaluate them in one pass.
BLOCK = 10
# Rounds, patience of the AUC watch, and tree settings.
ROUNDS = 57
PATIENCE = 20
TREE = {"stepSize": 0.1, "maxDepth": 5, "maxBins": 255, "minInstancesPerNode": 20}

# The trees take no missing values: this stands below every real one, offsets and skewness included.
MISSING = -9999.0
INPUTS = (*MODEL_FEATURES, *[f"{log}_missing" for log in LOGS])


@dataclass(frozen=True)
class Trained:
    """A fitted model, the number of leading trees in use, and the AUC after each round."""

    model: GBTClassificationModel
    best_round: int
    auc_by_round: tuple[float, ...]


def assemble(matrix: DataFrame) -> DataFrame:
    """Keys, label and the input vector: missing values filled, one missing flag per log."""
    filled = [f"double(coalesce({name}, {MISSING}d)) AS {name}" for name in MODEL_FEATURES]
    flags = [f"double({log}_day_count IS NULL) AS {log}_missing" for log in LOGS]
    inputs = matrix.selectExpr("interval_id", "user_id", "double(label) AS label", *filled, *flags)
    assembled = VectorAssembler(inputCols=list(INPUTS), outputCol="features").transform(inputs)
    return assembled.select("interval_id", "user_id", "label", "features")


def fit(assembled: DataFrame, rounds: int = ROUNDS, seed: int = 7) -> GBTClassificationModel:
    """Boosted trees on the logistic loss. The shared folder also takes the trainer's checkpoints."""
    shared_dir(assembled.sparkSession)
    gbt = GBTClassifier(featuresCol="features", labelCol="label", maxIter=rounds, seed=seed, **TREE)
    return gbt.fit(assembled)


def prefix_scores(df: DataFrame, outputs: Sequence[str], margin: str = "0d") -> DataFrame:
    """``df`` with ``margins`` and ``scores``: after one more of the tree outputs (SQL) each, starting from ``margin``."""
    running = f"""aggregate(array({', '.join(outputs)}),
        named_struct('m', double({margin}), 'all', cast(array() AS array<double>)),
        (s, x) -> named_struct('m', s.m + x, 'all', array_append(s.all, s.m + x)), s -> s.all) AS margins"""
    return df.selectExpr("*", running).selectExpr("*", "transform(margins, m -> 1 / (1 + exp(-2 * m))) AS scores")


def _with_outputs(model: GBTClassificationModel, assembled: DataFrame, start: int, end: int) -> tuple[DataFrame, list[str]]:
    """``assembled`` with the predictions of the trees from ``start`` to before ``end``, and their weighted outputs as SQL."""
    for i in range(start, end):
        assembled = model.trees[i].setPredictionCol(f"tree_{i}").transform(assembled)
    return assembled, [f"{model.treeWeights[i]}d * tree_{i}" for i in range(start, end)]


def scores_by_round(model: GBTClassificationModel, assembled: DataFrame, rounds: int | None = None) -> DataFrame:
    """Each row with ``scores``: the probability after the first 1, 2, ... ``rounds`` trees."""
    scored, outputs = _with_outputs(model, assembled, 0, rounds or len(model.trees))
    return prefix_scores(scored, outputs).select(*assembled.columns, "scores")


def auc_of_rounds(scored: DataFrame) -> list[float | None]:
    """AUC after each tree, of rows with ``label`` and ``scores``."""
    long = scored.select("label", F.posexplode("scores").alias("round", "score"))
    by_round = auc(long, "score", "label", by=["round"]).orderBy("round")
    return [row["auc"] for row in by_round.collect()]  # one row per boosting round


def boost(
    training: DataFrame,
    validation: DataFrame,
    rounds: int = ROUNDS,
    patience: int = PATIENCE,
    block: int = BLOCK,
    seed: int = 7,
) -> tuple[GBTClassificationModel, list[float | None]]:
    """Boosted trees on the logistic loss, and the validation AUC after each, until ``patience`` rounds bring no gain.

    The trees are those of ``fit``: the first is fitted to the labels as -1 and 1, each later one to
    the negative gradient of the loss at the margin so far, and enters with the step size.
    Margins of both tables are carried from block to block in stored tables, so that no tree is
    evaluated twice; a block is finished before the rule is asked, so at most ``block`` - 1 trees
    more than it needs are fitted.
    """
    spark, keys = training.sparkSession, ["label", "features"]
    learner = DecisionTreeRegressor(
        featuresCol="features", labelCol="target", predictionCol="output", seed=seed, **_without_step(TREE)
    )
    carried = {"train": training.selectExpr("features", "2 * label - 1 AS y", "0d AS margin")}
    carried["watch"] = validation.select(*keys, F.lit(0.0).alias("margin"))
    trees: list[DecisionTreeRegressionModel] = []
    values: list[float | None] = []
    while len(trees) < rounds and len(trees) - pick_round(values, patience) < patience:
        margins, start = staged(carried["train"], "margins"), len(trees)
        while len(trees) < min(start + block, rounds):
            target = "4 * y / (1 + exp(2 * y * margin))" if trees else "y"
            tree = learner.fit(margins.selectExpr("features", f"{target} AS target"))
            after = f"margin + {_weight(len(trees))}d * output AS margin"
            margins = tree.transform(margins).selectExpr("features", "y", after)
            trees.append(tree)
        carried["train"] = margins
        scored, outputs = _with_outputs(_ensemble(trees, spark), carried["watch"], start, len(trees))
        scored = prefix_scores(scored, outputs, "margin")
        watched = staged(scored.select(*keys, "scores", F.element_at("margins", -1).alias("margin")), "rounds")
        values += auc_of_rounds(watched)
        carried["watch"] = watched.drop("scores")
    return _ensemble(trees, spark), values


def _without_step(tree: dict) -> dict:
    return {name: value for name, value in tree.items() if name != "stepSize"}


def _weight(number: int) -> float:
    """The weight of a tree, counted from 0."""
    return TREE["stepSize"] if number else 1.0


def _ensemble(trees: Sequence[DecisionTreeRegressionModel], spark: SparkSession) -> GBTClassificationModel:
    """The trees as one model, which Spark can score with, save and load."""
    gateway = spark.sparkContext._gateway
    jvm = gateway.jvm.org.apache.spark.ml
    fitted = gateway.new_array(jvm.regression.DecisionTreeRegressionModel, len(trees))
    weights = gateway.new_array(gateway.jvm.double, len(trees))
    for number, tree in enumerate(trees):
        fitted[number], weights[number] = tree._java_obj, _weight(number)
    uid = f"GBTClassifier_{uuid.uuid4().hex[:12]}"
    return GBTClassificationModel(jvm.classification.GBTClassificationModel(uid, fitted, weights, len(INPUTS), 2))


def pick_round(auc_by_round: list[float | None], patience: int = PATIENCE) -> int:
    """Best round (1-based) among those run before ``patience`` rounds pass without gain."""
    best, best_auc = 1, float("-inf")
    for number, value in enumerate(auc_by_round, start=1):
        if value is not None and value > best_auc:
            best, best_auc = number, value
        elif number - best >= patience:
            break
    return best


def train(assembled: DataFrame, rounds: int = ROUNDS, patience: int = PATIENCE, block: int = BLOCK) -> Trained:
    """Fit on the training interval while the validation AUC rises, and choose the number of trees by it."""
    training, validation = (assembled.where(F.col("interval_id") == i) for i in (TRAIN, VALIDATION))
    model, values = boost(training, validation, rounds, patience, block)
    return Trained(model, pick_round(values, patience), tuple(values))


def node_table(model: GBTClassificationModel, spark) -> DataFrame:
    """One row per node: ``tree, weight, node, feature`` (position of the input, -1 for a leaf), ``threshold, left,
    right, prediction, gain`` and the training ``rows`` that reach it. The model is saved to the shared folder and
    read as a table.
    """
    path = f"{shared_dir(spark)}/model-{uuid.uuid4().hex}"
    model.write().save(path)
    weights = [(number, float(weight)) for number, weight in enumerate(model.treeWeights)]
    weights = spark.createDataFrame(weights, "tree int, weight double")
    nodes = spark.read.parquet(f"{path}/data").selectExpr(
        "treeID AS tree", "nodeData.id AS node", "nodeData.split.featureIndex AS feature",
        "get(nodeData.split.leftCategoriesOrThreshold, 0) AS threshold", "nodeData.leftChild AS left",
        "nodeData.rightChild AS right", "nodeData.prediction", "nodeData.gain", "nodeData.rawCount AS rows",
    )
    return nodes.join(F.broadcast(weights), "tree").select("tree", "weight", *nodes.columns[1:])  # one row per tree


def walked_scores(rows: DataFrame, nodes: DataFrame, key: str = "user_id", depth: int = TREE["maxDepth"]) -> DataFrame:
    """``key, result``: the probability of each row by a walk down the node table, from the roots to the leaves.

    A row is at one node of each tree; each level is a join with the nodes, of which there are at most 2^(depth + 1)
    a tree, so they are broadcast. The rows of a key are its trees, and combine before the shuffle.
    """
    split = nodes.selectExpr("tree", "node", "feature", "threshold", "left", "right")
    at = rows.select(key, vector_to_array("features").alias("x")).join(
        F.broadcast(nodes.where("node = 0").selectExpr("tree", "node AS at"))
    )
    for _ in range(depth):
        met = at.join(F.broadcast(split.withColumnRenamed("tree", "of")), F.expr("tree = of AND at = node"))
        at = met.selectExpr(key, "x", "tree", "IF(feature < 0, at, IF(get(x, feature) <= threshold, left, right)) AS at")
    leaves = nodes.selectExpr("tree AS of", "node", "weight * prediction AS output")
    margins = at.join(F.broadcast(leaves), F.expr("tree = of AND at = node")).groupBy(key).agg(F.sum("output").alias("m"))
    return margins.selectExpr(key, "1 / (1 + exp(-2 * m)) AS result")


def node_gains(nodes: DataFrame) -> DataFrame:
    """``position, gain``: the share of each input in the impurity gain of all splits, weighted by the rows they part."""
    gains = nodes.where("feature >= 0").groupBy("feature").agg(F.sum(F.col("gain") * F.col("rows")).alias("g"))
    total = F.broadcast(gains.agg(F.sum("g").alias("all_gain")))  # one row
    return gains.join(total).selectExpr("feature AS position", "g / all_gain AS gain")


def validation_scores(trained: Trained, assembled: DataFrame) -> DataFrame:
    """``user_id, label, result`` on the validation interval, with the chosen trees."""
    validation = assembled.where(F.col("interval_id") == VALIDATION)
    scored, outputs = _with_outputs(trained.model, validation, 0, trained.best_round)
    result = f"1 / (1 + exp(-2 * ({' + '.join(outputs)}))) AS result"
    return scored.selectExpr("user_id", "label", result)


def evaluate(trained: Trained, assembled: DataFrame) -> DataFrame:
    """One row: best round, ROC AUC and log loss on the validation interval."""
    scored = validation_scores(trained, assembled).withColumn("best_round", F.lit(trained.best_round))
    by = ["best_round"]
    return auc(scored, "result", "label", by).join(log_loss(scored, "result", "label", by), by)


def importances(trained: Trained, spark) -> DataFrame:
    """``feature, important, gain``: splits per input in the chosen trees, fewest first.

    ``gain`` is the normalised impurity gain over all trees of the model. Both are counted in its node table.
    """
    nodes = staged(node_table(trained.model, spark), "nodes")
    named = spark.createDataFrame(list(enumerate(INPUTS)), "position int, feature string")  # one row per model input
    inputs = named.join(node_gains(nodes), "position", "left").fillna(0.0, ["gain"])
    return split_counts(nodes.withColumnRenamed("feature", "position"), inputs, trained.best_round)


def split_counts(nodes: DataFrame, inputs: DataFrame, best_round: int) -> DataFrame:
    """``inputs`` (position, feature, ...) with ``important``: their splits in the first trees, fewest first.

    ``nodes`` has the tree and the input's position of each node, negative for a leaf.
    """
    splits = nodes.where((F.col("tree") < best_round) & (F.col("position") >= 0)).groupBy("position").count()
    more = [c for c in inputs.columns if c not in ("position", "feature")]
    return (
        inputs.join(splits, "position", "left")
        .select("feature", F.coalesce("count", F.lit(0)).alias("important"), *more)
        .orderBy("important", "feature")
    )


def train_and_evaluate(matrix: DataFrame) -> DataFrame:
    assembled = assemble(matrix)
    return evaluate(train(assembled), assembled)


def train_importances(matrix: DataFrame) -> DataFrame:
    return importances(train(assemble(matrix)), matrix.sparkSession)


def refit(assembled: DataFrame, rounds: int = ROUNDS) -> GBTClassificationModel:
    """A model of all rounds on both labelled intervals."""
    return fit(assembled.where(F.col("interval_id").isin(TRAIN, VALIDATION)), rounds)


def scored_rows(assembled: DataFrame) -> DataFrame:
    return assembled.where(F.col("interval_id") == SCORE)


def refit_and_score(matrix: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``user_id, result`` of the score interval, by a model fitted on both labelled ones."""
    assembled = assemble(matrix)
    scored = refit(assembled, rounds).transform(scored_rows(assembled))
    return scored.select("user_id", vector_to_array("probability")[1].alias("result"))


def score_agreement(matrix: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``user_id, agrees``: whether the refitted model's score and the walk down its node table give one number."""
    assembled = assemble(matrix)
    model = refit(assembled, rounds)
    rows = scored_rows(assembled)
    scores = model.transform(rows).select("user_id", vector_to_array("probability")[1].alias("score"))
    walked = walked_scores(rows, staged(node_table(model, matrix.sparkSession), "nodes"))
    return scores.join(walked, "user_id", "full").selectExpr("user_id", "coalesce(abs(score - result) < 1e-9, false) AS agrees")


def importance_agreement(matrix: DataFrame) -> DataFrame:
    """``feature, agrees``: whether the gain counted in the node table is that which Spark reports of the model."""
    spark = matrix.sparkSession
    trained = train(assemble(matrix))
    gains = trained.model.featureImportances.toArray()
    reported = spark.createDataFrame([(n, float(g)) for n, g in zip(INPUTS, gains)], "feature string, reported double")
    counted = importances(trained, spark)
    return counted.join(reported, "feature", "full").selectExpr(
        "feature", "coalesce(abs(gain - reported) < 1e-9 AND (important > 0 OR gain >= 0), false) AS agrees"
    )
