"""Logistic regression and random forest on the model table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.operators.evaluation import (
    classification_metrics,
    confusion,
    confusion_summary,
    split,
    with_class_weights,
)
from colloquy.schema import CATEGORY_FEATURES, NUMERIC_FEATURES
from colloquy.staging import stage

LOGISTIC = "Logistic Regression"
FOREST = "Random Forest"
RIDGE = 0.01
# Rows of a partition that a forest is grown from.
ROWS_IN_PLACE = 500_000
METRICS = ("auc_roc", "accuracy", "f1", "weighted_precision", "weighted_recall")


def feature_stages(
    categories: Sequence[str] = CATEGORY_FEATURES, numbers: Sequence[str] = NUMERIC_FEATURES
) -> list:
    """Index (unknown values get an index of their own), one-hot, assemble."""
    index = StringIndexer(
        inputCols=list(categories), outputCols=[f"{c}_idx" for c in categories], handleInvalid="keep"
    )
    one_hot = OneHotEncoder(inputCols=index.getOutputCols(), outputCols=[f"{c}_ohe" for c in categories])
    assemble = VectorAssembler(
        inputCols=one_hot.getOutputCols() + list(numbers), outputCol="features", handleInvalid="keep"
    )
    return [index, one_hot, assemble]


def fill_inputs(rows: DataFrame) -> DataFrame:
    """Model inputs without gaps. A numeric feature that is absent, as those of a comment
    without an author, counts as 0: no history. An absent category becomes a value of its
    own in the index. Labels stay as they are."""
    numbers = {c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)).cast(t) for c, t in rows.dtypes if c in NUMERIC_FEATURES}
    return rows.withColumns(numbers)


def fitted_index(rows: DataFrame, column: str) -> DataFrame:
    """The category index a model learns from ``rows``: ``value`` and its ``position``, the most
    frequent first, then by the alphabet."""
    labels = StringIndexer(inputCol=column, outputCol="position", handleInvalid="keep").fit(rows).labels
    return rows.sparkSession.createDataFrame(list(enumerate(labels)), "position int, value string")


def fit_lr(train: DataFrame) -> Model:
    """Ridge logistic regression over assembled features; ``train`` carries the class weights."""
    return LogisticRegression(
        labelCol="label", weightCol="classWeightCol", maxIter=30, regParam=RIDGE, elasticNetParam=0.0
    ).fit(train)


def in_fixed_place(rows: DataFrame, key: str = "id") -> DataFrame:
    """``rows`` (a written table) in partitions, and an order within them, that follow from their keys alone. Bagging and the
    sampling of split points draw by partition and place: so a seed means the same however the table came to be stored."""
    parts = max(1, -(-rows.count() // ROWS_IN_PLACE))
    return rows.repartition(parts, F.md5(F.col(key).cast("string"))).sortWithinPartitions(key, *[c for c, t in rows.dtypes if c != key and t != "vector"])


def fit_rf(train: DataFrame) -> Model:
    """Unweighted forest over assembled features, the same for any placement of the rows."""
    return RandomForestClassifier(labelCol="label", numTrees=50, maxDepth=8, seed=42).fit(in_fixed_place(train))


FITTERS = {LOGISTIC: fit_lr, FOREST: fit_rf}


@dataclass
class Trained:
    """A fitted pipeline, its feature slot names, its written test predictions and training side."""

    name: str
    model: PipelineModel
    slots: list[str]
    predictions: DataFrame
    train: DataFrame

    def confusion(self) -> DataFrame:
        return confusion(self.predictions)

    def summary(self) -> DataFrame:
        return confusion_summary(self.confusion(), self.name)

    def metrics(self) -> DataFrame:
        return evaluate(self.predictions, self.name)

    def weights(self) -> DataFrame:
        return feature_weights(self.predictions.sparkSession, self.model, self.slots)


def train_models(base: DataFrame, names: Sequence[str] = (LOGISTIC, FOREST)) -> list[Trained]:
    """Fit on the training side and predict the test side, for each named model.
    ``base`` is a written table: it is passed over often. Absent inputs are filled by
    :func:`fill_inputs`; rows without a label are neither fitted nor judged."""
    train, test = split(fill_inputs(base.filter(F.col("label").isNotNull())))
    # Index and slots are the same for all models: they are fitted once, and both sides written with them.
    shared = Pipeline(stages=feature_stages()).fit(train)
    train = stage(shared.transform(with_class_weights(train)).select("id", "label", "classWeightCol", "features"), "train-side")
    test = stage(shared.transform(with_class_weights(test, train=False)).select("id", "label", "classWeightCol", "features"), "test-side")
    slots = slot_names(shared.transform(base.limit(0).transform(fill_inputs)))
    trained = []
    for name in names:
        model = PipelineModel([*shared.stages, FITTERS[name](train)])
        predicted = model.stages[-1].transform(test)
        written = stage(predicted.select("label", "rawPrediction", "prediction"), "predictions")
        trained.append(Trained(name, model, slots, written, train))
    return trained


def ridge_gradient(fitted: Model, train: DataFrame, penalty: float = RIDGE) -> DataFrame:
    """``slot`` and ``slope`` of the weighted ridge loss at a fitted regression's coefficients, the intercept last. The
    penalty is on coefficients of features scaled by their deviation, and so are the slopes; all are 0 at the optimum."""
    deviations = train.select(Summarizer.metrics("std").summary(F.col("features"), F.col("classWeightCol")).alias("s")).first()["s"]["std"].toArray().tolist()
    coefficients = [*fitted.coefficients.toArray().tolist(), 0.0]
    spread = [*deviations, 1.0]
    off = F.col("classWeightCol") * (vector_to_array("probability")[1] - F.col("label"))
    values = F.concat(vector_to_array("features"), F.array(F.lit(1.0)))
    parts = fitted.transform(train).select(off.alias("off"), "classWeightCol", F.posexplode(values).alias("slot", "value"))
    sums = parts.groupBy("slot").agg(F.sum(F.col("off") * F.col("value")).alias("sum"), F.sum("classWeightCol").alias("weight"))
    at = F.col("slot") + 1
    scale, now = F.element_at(F.array(*map(F.lit, spread)), at), F.element_at(F.array(*map(F.lit, coefficients)), at)
    return sums.select("slot", F.coalesce(F.try_divide(F.col("sum") / F.col("weight"), scale), F.lit(0.0)).alias("loss"), (penalty * now * scale).alias("pull")).select(
        "slot", (F.col("loss") + F.col("pull")).alias("slope")
    )


def roc_area(predictions: DataFrame) -> float:
    """Area under the whole ROC curve, every different score a point of it."""
    evaluator = BinaryClassificationEvaluator(
        labelCol="label", rawPredictionCol="rawPrediction", metricName="areaUnderROC", numBins=0
    )
    return round(float(evaluator.evaluate(predictions)), 4)


def evaluate(predictions: DataFrame, name: str) -> DataFrame:
    """One metric row: area under the ROC curve plus the confusion-based metrics."""
    auc = roc_area(predictions)
    rest = classification_metrics(confusion(predictions))
    return rest.select(F.lit(name).alias("model"), F.lit(auc).alias("auc_roc"), *METRICS[1:])


def metrics_long(metrics: DataFrame) -> DataFrame:
    """One row per model and metric."""
    return metrics.unpivot(["model"], [m for m in METRICS if m in metrics.columns], "metric", "value")


def slot_names(assembled: DataFrame) -> list[str]:
    """Names of the feature vector's slots, from the column's metadata."""
    groups = assembled.schema["features"].metadata["ml_attr"]["attrs"].values()
    slots = {attr["idx"]: attr["name"] for group in groups for attr in group}
    return [slots[i] for i in sorted(slots)]


def feature_weights(spark: SparkSession, model: PipelineModel, slots: Sequence[str]) -> DataFrame:
    """Coefficients by absolute size, or importances, largest first. The vector has
    one slot per community and numeric feature, so this is driver-sized."""
    fitted = model.stages[-1]
    linear = hasattr(fitted, "coefficients")
    values = (fitted.coefficients if linear else fitted.featureImportances).toArray().tolist()
    column = "coefficient" if linear else "importance"
    rows = spark.createDataFrame(
        list(zip(range(len(values)), slots, values, strict=True)),
        f"feature_index int, feature string, {column} double",
    )
    if linear:
        rows = rows.withColumn("abs_coefficient", F.abs(column))
    return rows.orderBy(F.desc("abs_coefficient" if linear else column), "feature_index")
