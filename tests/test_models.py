"""Split, metrics, slot names and bounds of the classifiers."""

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from checks import views
from colloquy.operators import evaluation, models
from colloquy.operators.model_base import model_input
from colloquy.schema import NUMERIC_FEATURES
from colloquy.staging import stage


@pytest.fixture(scope="module")
def base(spark, sf_dir):
    return model_input(views.features(spark, sf_dir))


@pytest.fixture(scope="module")
def trained(base):
    return models.train_models(base)


def test_split_is_complete_disjoint_and_stable(base):
    train, test = evaluation.split(base)
    again, _ = evaluation.split(base.repartition(5).orderBy(F.desc("id")))
    ids = [{r.id for r in side.select("id").collect()} for side in (train, test, again)]
    assert ids[0] & ids[1] == set()
    assert len(ids[0] | ids[1]) == base.count()
    assert ids[0] == ids[2]
    assert 0.72 < len(ids[0]) / base.count() < 0.88


def test_seed_and_fraction_matter(base):
    one, _ = evaluation.split(base, seed=1)
    two, _ = evaluation.split(base, seed=2)
    half, _ = evaluation.split(base, frac=0.5)
    assert not one.select("id").exceptAll(two.select("id")).isEmpty()
    assert half.count() < one.count()


def test_metrics_equal_the_evaluators(trained):
    for t in trained:
        row = t.metrics().first()
        for name, metric in (("accuracy", "accuracy"), ("f1", "f1"), ("weighted_precision", "weightedPrecision"),
                             ("weighted_recall", "weightedRecall")):
            evaluator = MulticlassClassificationEvaluator(labelCol="label", metricName=metric)
            assert row[name] == pytest.approx(evaluator.evaluate(t.predictions), abs=5.1e-5)
        assert 0.5 < row.auc_roc <= 1


def test_metrics_of_a_class_never_predicted(spark):
    df = spark.createDataFrame([(0, 0.0)] * 3 + [(1, 0.0)], "label int, prediction double")
    row = evaluation.classification_metrics(evaluation.confusion(df)).first()
    assert tuple(row) == (0.75, 0.6429, 0.5625, 0.75)


def test_confusion_covers_the_test_side(base, trained):
    _, test = evaluation.split(base)
    for t in trained:
        assert t.confusion().agg(F.sum("count")).first()[0] == test.count()
        s = t.summary().first()
        assert s.true_negatives + s.false_positives + s.false_negatives + s.true_positives == test.count()


def test_slots_are_communities_then_numbers(base, trained):
    for t in trained:
        assert len(t.slots) == base.select("subreddit").distinct().count() + len(NUMERIC_FEATURES)
        assert tuple(t.slots[-len(NUMERIC_FEATURES):]) == NUMERIC_FEATURES
        assert t.slots[0].startswith("subreddit_ohe_")


def test_weights(trained):
    lr, rf = (t.weights() for t in trained)
    sizes = [r.abs_coefficient for r in lr.collect()]
    assert sizes == sorted(sizes, reverse=True)
    assert rf.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    shares = [r.importance for r in rf.collect()]
    assert shares == sorted(shares, reverse=True)


def test_long_metrics(trained):
    long = models.metrics_long(trained[0].metrics())
    assert [r.metric for r in long.collect()] == list(models.METRICS)


def test_unknown_community_keeps_its_row(spark, trained, base):
    strange = base.limit(1).withColumn("subreddit", F.lit("never seen"))
    assert trained[0].model.transform(strange).count() == 1


def test_models_fit_on_comments_with_gaps(spark, sf_dir):
    """Authors, communities and labels are missing; rows without a label are left out."""
    base = model_input(views.features(spark, sf_dir, nulls=True))
    gaps = base.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in ("label", "subreddit", "total_comments_per_user")]).first()
    assert all(gaps)
    for t in models.train_models(base):
        _, test = evaluation.split(base.filter("label is not null"))
        assert t.confusion().agg(F.sum("count")).first()[0] == test.count()


def test_unknown_features_option(spark, sf_dir):
    features = views.features(spark, sf_dir)
    train_only = model_input(features, "train")
    _, test = evaluation.split(train_only)
    known = evaluation.split(train_only)[0].agg(F.count_if(F.col("total_comments_per_user").isNull())).first()[0]
    assert known == 0 and test.filter("total_comments_per_user is null").count() > 0
    with pytest.raises(ValueError, match="features_from"):
        model_input(features, "test")


def test_roc_area_uses_every_score(spark):
    """Many different scores: the down-sampled curve would differ."""
    rows = spark.range(20000).select((F.pmod(F.hash("id"), F.lit(3)) == 0).cast("int").alias("label"), F.col("id").cast("double").alias("rawPrediction"))
    rows = rows.withColumn("rawPrediction", F.col("rawPrediction") + 4000 * F.col("label"))
    collected = sorted(((r.rawPrediction, r.label) for r in rows.collect()))
    below, wins, ties = 0, 0.0, {}
    for score, label in collected:
        ties.setdefault(score, [0, 0])[label] += 1
    for score in sorted(ties):
        negative, positive = ties[score]
        wins += positive * (below + negative / 2)
        below += negative
    positives = sum(label for _, label in collected)
    assert models.roc_area(rows) == pytest.approx(wins / (positives * below), abs=6e-5)


def test_test_rows_weigh_one(base):
    _, test = evaluation.split(base)
    assert {r[0] for r in evaluation.with_class_weights(test, train=False).select("classWeightCol").distinct().collect()} == {1.0}


@pytest.fixture(scope="module")
def model_rows(spark, sf_dir):
    return stage(model_input(views.features(spark, sf_dir)), "model-rows")


def test_forest_is_the_same_in_any_placement(model_rows):
    """Rows in other files, in another order, over other numbers of partitions."""
    found = []
    for placed in (model_rows.repartition(1), model_rows.repartition(5, "subreddit"), model_rows.orderBy(F.desc("id")).repartition(13)):
        found.append(models.train_models(stage(placed, "placed"), [models.FOREST])[0].model.stages[-1])
    assert len({tuple(m.featureImportances.toArray().tolist()) for m in found}) == 1
    assert len({m.toDebugString.partition("\n")[2] for m in found}) == 1


def test_rows_in_fixed_place(spark):
    rows = [(str(i), i % 2) for i in range(1000)]
    df = spark.createDataFrame(rows, "id string, label int")
    placed = [models.in_fixed_place(df.repartition(parts)).rdd.glom().collect() for parts in (1, 9)]
    assert placed[0] == placed[1]


def test_regression_is_at_the_optimum_of_its_loss(model_rows):
    (lr,) = models.train_models(model_rows, [models.LOGISTIC])
    fitted = lr.model.stages[-1]
    slopes = models.ridge_gradient(fitted, lr.train).collect()
    assert len(slopes) == len(lr.slots) + 1
    assert max(abs(r.slope) for r in slopes) < 1e-3
    # Elsewhere the slopes are not near 0.
    other = models.ridge_gradient(fitted, lr.train, penalty=10 * models.RIDGE).collect()
    assert max(abs(r.slope) for r in other) > 1e-2
