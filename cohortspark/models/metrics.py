"""Classification metrics. Rows are reduced to counts or sums on the executors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from cohortspark.functions.scalars import quote
from cohortspark.operators.numbering import ordered_row_id
from cohortspark.session import ensure_checkpoint_dir


def _pairs(df: DataFrame, actual: str, predicted: str, count: str | None = None) -> DataFrame:
    n = F.lit(1).cast("bigint") if count is None else F.col(quote(count)).cast("bigint")
    pairs = df.select(
        F.col(quote(actual)).alias("actual"), F.col(quote(predicted)).alias("predicted"), n.alias("count")
    )
    return pairs.where("actual IS NOT NULL AND predicted IS NOT NULL")


def confusion_matrix(df: DataFrame, actual: str, predicted: str, count: str | None = None) -> DataFrame:
    """Rows per (actual, predicted); ``count`` names the row count of an input that is already grouped."""
    pairs = _pairs(df, actual, predicted, count)
    return pairs.groupBy("actual", "predicted").agg(F.sum("count").alias("count"))


def collected_confusion(df: DataFrame, actual: str, predicted: str, count: str | None = None) -> DataFrame:
    """The confusion matrix computed once, so that several metrics share one scan; it stays distributed."""
    matrix = confusion_matrix(df, actual, predicted, count)
    ensure_checkpoint_dir(df.sparkSession)
    return matrix.checkpoint()


def accuracy(df: DataFrame, actual: str, predicted: str, count: str | None = None) -> DataFrame:
    hits = F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("count")).otherwise(0))
    return _pairs(df, actual, predicted, count).agg(F.try_divide(hits, F.sum("count")).alias("accuracy"))


def _or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))


def classification_report(df: DataFrame, actual: str, predicted: str, count: str | None = None) -> DataFrame:
    """Precision, recall, F1 and support per class, then ``accuracy``, ``macro avg`` and ``weighted avg``.

    One scan: each confusion count is credited to its actual and to its predicted class, and each class
    to its own line and to the averages. The accuracy line carries its value as F1, as usual in print.
    """
    n, hit = F.col("count"), F.col("actual") == F.col("predicted")
    zero = F.lit(0).cast("bigint")
    roles = F.array(
        F.struct(
            F.col("actual").alias("class"),
            n.alias("support"),
            zero.alias("assigned"),
            F.when(hit, n).otherwise(zero).alias("hits"),
        ),
        F.struct(F.col("predicted").alias("class"), zero.alias("support"), n.alias("assigned"), zero.alias("hits")),
    )
    classes = (
        confusion_matrix(df, actual, predicted, count)
        .select(F.inline(roles))
        .groupBy("class")
        .agg(*[F.sum(c).alias(c) for c in ("support", "assigned", "hits")])
        .withColumn("precision", _or_zero(F.col("hits"), F.col("assigned")))
        .withColumn("recall", _or_zero(F.col("hits"), F.col("support")))
        .withColumn("f1", _or_zero(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    )

    def line(label: Column, weight: Column, order: int) -> Column:
        return F.struct(
            F.lit(order).alias("section"),
            label.alias("label"),
            *[F.col(c) for c in ("precision", "recall", "f1", "support", "hits")],
            weight.cast("double").alias("weight"),
        )

    lines = F.array(
        line(F.col("class").cast("string"), F.lit(1), 0),
        line(F.lit("accuracy"), F.lit(1), 1),
        line(F.lit("macro avg"), F.lit(1), 2),
        line(F.lit("weighted avg"), F.col("support"), 3),
    )
    is_accuracy = F.col("label") == "accuracy"

    def weighted(c: str) -> Column:
        exact = F.sum((F.col(c) * F.col("weight")).cast("decimal(38,15)")).cast("double")  # whatever the order of rows
        return _or_zero(exact, F.sum("weight"))

    overall = _or_zero(F.sum("hits"), F.sum("support"))
    return (
        classes.select(F.inline(lines))
        .groupBy("section", "label")
        .agg(
            weighted("precision").alias("precision"),
            weighted("recall").alias("recall"),
            weighted("f1").alias("f1"),
            overall.alias("overall"),
            F.sum("support").alias("support"),
        )
        .select(
            "section",
            "label",
            F.when(~is_accuracy, F.col("precision")).alias("precision"),
            F.when(~is_accuracy, F.col("recall")).alias("recall"),
            F.when(is_accuracy, F.col("overall")).otherwise(F.col("f1")).alias("f1"),
            "support",
        )
        .orderBy("section", "label")
    )


def quadratic_kappa(
    df: DataFrame, actual: str, predicted: str, labels: Sequence | None = None, count: str | None = None
) -> DataFrame:
    """Quadratic-weighted kappa, one row.

    Distances are between places in the sorted class list (the classes that occur, unless given).
    Both disagreement sums follow from five sums over the confusion counts, so no table of class pairs
    is needed: expected disagreement = sum a^2 + sum p^2 - 2 * sum a * sum p / n. NULL when that is 0.
    """
    spark = df.sparkSession
    counts = collected_confusion(df, actual, predicted, count)
    if labels is None:
        classes = counts.select(F.explode(F.array("actual", "predicted")).alias("c")).distinct()
        places = ordered_row_id(classes, ["c"], "place")
    else:
        rows = [(label, i) for i, label in enumerate(labels)]
        places = spark.createDataFrame(rows, StructType([StructField("c", counts.schema["actual"].dataType), StructField("place", LongType())]))
    a, p, n = F.col("a"), F.col("p"), F.col("n")
    of_actual = places.select(F.col("c").alias("actual"), F.col("place").cast("double").alias("a"))
    of_predicted = places.select(F.col("c").alias("predicted"), F.col("place").cast("double").alias("p"))
    placed = counts.withColumnRenamed("count", "n").join(of_actual, "actual", "left").join(of_predicted, "predicted", "left")
    sums = placed.where("a IS NOT NULL AND p IS NOT NULL").agg(
        F.sum(n * (a - p) * (a - p)).alias("observed"),
        F.sum(n * (a * a + p * p)).alias("squares"),
        F.sum(n * a).alias("sum_a"),
        F.sum(n * p).alias("sum_p"),
        F.sum(n).alias("n"),
    )
    expected = F.col("squares") - 2 * F.try_divide(F.col("sum_a") * F.col("sum_p"), n)
    return sums.select((1 - F.try_divide(F.col("observed"), expected)).alias("kappa"))
