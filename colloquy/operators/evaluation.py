"""Split, class weights, confusion counts and the metrics that follow from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.functions.numbers import safe_share

BUCKETS = 10_000


def split_bucket(key: str, seed: int) -> Column:
    """0 <= bucket < BUCKETS from the row's key, the same in every engine and on
    every recomputation, however the table is partitioned."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % BUCKETS


def split(df: DataFrame, frac: float = 0.8, seed: int = 42, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """(train, test) by the hash of the row's key."""
    cut = round(frac * BUCKETS)
    bucket = split_bucket(key, seed)
    return df.filter(bucket < cut), df.filter(bucket >= cut)


def split_counts(df: DataFrame, frac: float = 0.8, seed: int = 42, key: str = "id") -> DataFrame:
    """Rows per side and label."""
    side = F.when(split_bucket(key, seed) < round(frac * BUCKETS), "train").otherwise("test")
    return df.groupBy(side.alias("side"), "label").count()


def class_weights(train: DataFrame, label: str = "label") -> DataFrame:
    """Two rows (label, rows, weight) with weight = total / (2 * rows of the class).
    A class without rows counts as one row."""
    sizes = train.agg(
        *[F.greatest(F.count_if(F.col(label) == c), F.lit(1)).alias(str(c)) for c in (0, 1)]
    )
    return sizes.select(F.inline(F.array(*[_weight_row(c) for c in (0, 1)])))


def _weight_row(c: int) -> Column:
    rows = F.col(str(c))
    weight = (F.col("0") + F.col("1")) / (2 * rows)
    return F.struct(F.lit(c).alias("label"), rows.alias("rows"), weight.alias("weight"))


def with_class_weights(rows: DataFrame, out: str = "classWeightCol", train: bool = True) -> DataFrame:
    """Rows labelled 1 get that class's weight, all others the weight of class 0; test rows weigh 1.
    The two weights are one scalar subquery; nothing comes back to the driver."""
    if not train:
        return rows.withColumn(out, F.lit(1.0))

    def of(c: int) -> Column:
        return F.max(F.when(F.col("label") == c, F.col("weight"))).alias(f"w{c}")

    pair = class_weights(rows).agg(of(0), of(1)).select(F.struct("w0", "w1")).scalar()
    weight = F.when(F.col("label") == 1, pair.getField("w1")).otherwise(pair.getField("w0"))
    return rows.withColumn(out, weight)


def confusion(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("label", "prediction").count().orderBy("label", "prediction")


def confusion_summary(counts: DataFrame, model: str) -> DataFrame:
    """One row of cells and positive-class ratios from confusion counts."""

    def cell(label: int, prediction: int) -> Column:
        here = (F.col("label") == label) & (F.col("prediction") == prediction)
        return F.coalesce(F.sum(F.when(here, F.col("count"))), F.lit(0))

    tn, fp, fn, tp = (F.col(c) for c in ("true_negatives", "false_positives", "false_negatives", "true_positives"))
    return counts.agg(
        F.lit(model).alias("model"),
        cell(0, 0).alias("true_negatives"),
        cell(0, 1).alias("false_positives"),
        cell(1, 0).alias("false_negatives"),
        cell(1, 1).alias("true_positives"),
    ).select(
        "*",
        safe_share(tp, tp + fp).alias("positive_precision"),
        safe_share(tp, tp + fn).alias("positive_recall"),
        safe_share(tn, tn + fp).alias("specificity"),
    )


def classification_metrics(counts: DataFrame) -> DataFrame:
    """Accuracy and support-weighted F1, precision and recall of all classes.

    They follow from the confusion counts, so one aggregate over the predictions
    replaces a pass per metric. Classes are those that occur as labels; a class
    never predicted has precision 0.
    """
    cells = counts.select(F.col("label").cast("double"), F.col("prediction").cast("double"), "count")
    hit = F.when(F.col("label") == F.col("prediction"), F.col("count")).otherwise(0)
    actual = cells.groupBy("label").agg(F.sum("count").alias("support"), F.sum(hit).alias("hits"))
    predicted = cells.groupBy(F.col("prediction").alias("label")).agg(F.sum("count").alias("predicted"))
    recall = F.col("hits") / F.col("support")
    precision = F.coalesce(F.try_divide("hits", "predicted"), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * F.col("p") * F.col("r"), F.col("p") + F.col("r")), F.lit(0.0))
    per_class = (
        actual.join(predicted, "label", "left")
        .select("support", "hits", precision.alias("p"), recall.alias("r"))
        .withColumn("f", f1)
    )

    def weighted(name: str, out: str) -> Column:
        return F.round(F.sum(F.col(name) * F.col("support")) / F.sum("support"), 4).alias(out)

    return per_class.agg(
        F.round(F.sum("hits") / F.sum("support"), 4).alias("accuracy"),
        weighted("f", "f1"),
        weighted("p", "weighted_precision"),
        weighted("r", "weighted_recall"),
    )
