import pytest
from daygrain.plans import model
from daygrain.plans.features import FEATURES, feature_matrix
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

import helpers


@pytest.fixture(scope="module")
def matrix(spark):
    logs = helpers.random_logs(11, users=120, rows=900, in_order=True)
    return feature_matrix(helpers.stacked(spark, logs), helpers.frames(spark, logs)["register"])


@pytest.fixture(scope="module")
def trained(matrix):
    return model.train(model.assemble(matrix), rounds=4)


def test_pick_round_stops_after_patience():
    assert model.pick_round([0.5, 0.7, 0.6, 0.6, 0.9], patience=2) == 2
    assert model.pick_round([0.5, 0.7, 0.6, 0.9], patience=3) == 4
    assert model.pick_round([None, None], patience=20) == 1
    assert model.pick_round([0.5, 0.5, 0.5]) == 1


def test_missing_values_are_filled(matrix):
    assert matrix.where("create_day_count IS NULL").count() > 0
    vectors = model.assemble(matrix).select(vector_to_array("features").alias("v"))
    assert vectors.where(F.exists("v", lambda x: F.isnan(x) | x.isNull())).isEmpty()
    assert vectors.first().v.__len__() == len(model.INPUTS) == 125


def test_scores_of_all_rounds_end_at_the_model(matrix, trained):
    assembled = model.assemble(matrix).where("interval_id = 2")
    ours = model.scores_by_round(trained.model, assembled).select("user_id", F.element_at("scores", -1).alias("ours"))
    theirs = trained.model.transform(assembled).select("user_id", vector_to_array("probability")[1].alias("theirs"))
    assert ours.join(theirs, "user_id").where("abs(ours - theirs) > 1e-9").isEmpty()
    assert len(trained.auc_by_round) == 4 and all(0 <= a <= 1 for a in trained.auc_by_round)


def test_evaluation_is_the_chosen_round(matrix, trained):
    row = model.evaluate(trained, model.assemble(matrix)).first()
    assert row.best_round == trained.best_round
    assert abs(row.auc - trained.auc_by_round[trained.best_round - 1]) < 1e-12
    assert row.log_loss > 0


def test_importances_count_splits(spark, trained):
    rows = model.importances(trained, spark).collect()
    assert [r.important for r in rows] == sorted(r.important for r in rows)
    text = trained.model.toDebugString.split("Tree ")[1 : trained.best_round + 1]
    assert sum(r.important for r in rows) == sum(part.count("If (") for part in text)
    assert set(model.INPUTS) == {r.feature for r in rows}


def test_training_is_deterministic(matrix, trained):
    again = model.train(model.assemble(matrix), rounds=4)
    assert again.auc_by_round == trained.auc_by_round


def test_refit_scores_every_registered_user(matrix):
    scores = model.refit_and_score(matrix, rounds=2)
    assert scores.columns == ["user_id", "result"]
    assert scores.count() == 120
    assert scores.where("result <= 0 OR result >= 1").isEmpty()


def test_features_cover_model_inputs():
    assert set(model.MODEL_FEATURES) <= set(FEATURES)


def test_stops_while_training(matrix):
    """A patience of one round in blocks of two: training ends long before the last round."""
    trained = model.train(model.assemble(matrix), patience=1, block=2)
    fitted = len(trained.model.trees)
    assert fitted < model.ROUNDS and fitted % 2 == 0
    assert len(trained.auc_by_round) == fitted and trained.best_round <= fitted
    # the rule held only at the end of the last block
    assert len(trained.auc_by_round[:-2]) - model.pick_round(list(trained.auc_by_round[:-2]), 1) < 1


@pytest.mark.parametrize("block", [1, 3, 10])
def test_blocks_give_the_trees_of_one_fit(matrix, block):
    assembled = model.assemble(matrix)
    whole = model.fit(assembled.where("interval_id = 1"), rounds=4)
    blocks, values = model.boost(*(assembled.where(f"interval_id = {i}") for i in (1, 2)), rounds=4, block=block)
    assert list(blocks.treeWeights) == list(whole.treeWeights) and len(values) == 4
    scores = [
        m.transform(assembled).select("interval_id", "user_id", vector_to_array("probability")[1].alias(name))
        for m, name in ((blocks, "a"), (whole, "b"))
    ]
    assert scores[0].join(scores[1], ["interval_id", "user_id"]).where("a <> b").isEmpty()


def test_node_walk_equals_transform(spark, matrix):
    assembled = model.assemble(matrix)
    fitted = model.refit(assembled, rounds=6)
    rows = assembled.where("interval_id = 3")
    walked = model.walked_scores(rows, model.node_table(fitted, spark))
    scores = fitted.transform(rows).select("user_id", vector_to_array("probability")[1].alias("score"))
    both = walked.join(scores, "user_id")
    assert both.count() == rows.count() == 120
    assert both.where("abs(score - result) > 1e-9").isEmpty()
    agreed = model.score_agreement(matrix, rounds=2)
    assert agreed.count() == 120 and agreed.where("NOT agrees").isEmpty()


def test_node_walk_tells_other_scores_apart(spark, matrix):
    assembled = model.assemble(matrix)
    fitted = model.refit(assembled, rounds=3)
    rows = assembled.where("interval_id = 3")
    nodes = model.node_table(fitted, spark)
    other = nodes.withColumn("prediction", F.expr("IF(feature < 0 AND tree = 2, prediction + 0.01, prediction)"))
    scores = fitted.transform(rows).select("user_id", vector_to_array("probability")[1].alias("score"))
    assert model.walked_scores(rows, other).join(scores, "user_id").where("abs(score - result) < 1e-9").isEmpty()


def test_gains_of_the_node_table_are_those_reported(spark, trained):
    reported = trained.model.featureImportances.toArray()
    counted = {r.position: r.gain for r in model.node_gains(model.node_table(trained.model, spark)).collect()}
    assert all(abs(counted.get(i, 0.0) - g) < 1e-9 for i, g in enumerate(reported))
    assert abs(sum(counted.values()) - 1) < 1e-9
