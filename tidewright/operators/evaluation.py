"""Classifier evaluation as aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def misclassified(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Rows whose labels differ; a missing label differs from everything, also from another one."""
    same = F.coalesce(F.col(actual) == F.col(predicted), F.lit(False))
    return df.where(~same)


def error_rate(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    same = F.coalesce(F.col(actual) == F.col(predicted), F.lit(False))
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(~same).alias("n_wrong"),
        F.try_divide(F.count_if(~same), F.count(F.lit(1))).alias("error_rate"),
    )


def cell_counts(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """Counts of the (label, prediction) cells that occur, per value of ``by``."""
    label, prediction = F.col(actual).cast("int"), F.col(predicted).cast("int")
    return (
        df.where(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
        .groupBy(*by, label.alias("label"), prediction.alias("prediction"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def full_matrix(counts: DataFrame, classes: int = 3, by: Sequence[str] = ()) -> DataFrame:
    """Complete the counted cells with empty ones."""
    keys = counts.select(*by).distinct() if by else counts.sparkSession.range(1).select()
    cells = keys.select(*by, F.explode(F.sequence(F.lit(0), F.lit(classes * classes - 1))).alias("cell")).select(
        *by, F.floor(F.col("cell") / classes).cast("int").alias("label"), (F.col("cell") % classes).alias("prediction")
    )
    return cells.join(counts, [*by, "label", "prediction"], "left").select(
        *by, "label", "prediction", F.coalesce("n", F.lit(0)).alias("n")
    )


def confusion_matrix(df: DataFrame, actual: str, predicted: str, classes: int = 3) -> DataFrame:
    """Counts of every (label, prediction) cell, empty cells included."""
    return full_matrix(cell_counts(df, actual, predicted), classes)


def class_scores(matrix: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support per class; undefined scores are 0."""
    n, none = F.col("n"), F.lit(0)
    hit = F.when(F.col("label") == F.col("prediction"), n).otherwise(none)
    # Each cell counts once for its label (support, hits) and once for its prediction (claims).
    views = F.array(
        F.struct(F.col("label").alias("class"), hit.alias("tp"), n.alias("support"), none.alias("claimed")),
        F.struct(F.col("prediction").alias("class"), none.alias("tp"), none.alias("support"), n.alias("claimed")),
    )
    sums = (
        matrix.select(*by, F.inline(views))
        .groupBy(*by, "class")
        .agg(*[F.sum(c).alias(c) for c in ("tp", "support", "claimed")])
    )
    zero = F.lit(0.0)
    precision = F.coalesce(F.try_divide("tp", "claimed"), zero)
    recall = F.coalesce(F.try_divide("tp", "support"), zero)
    p, r = F.col("precision"), F.col("recall")
    f1 = F.coalesce(F.try_divide(2 * p * r, p + r), zero)
    return (
        sums.withColumns({"precision": precision, "recall": recall})
        .withColumn("f1", f1)
        .select(*by, "class", "support", "tp", "precision", "recall", "f1")
    )


def overall_scores(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, macro F1 (over all classes) and support-weighted F1."""
    weighted = F.coalesce(F.try_divide(F.sum(F.col("f1") * F.col("support")), F.sum("support")), F.lit(0.0))
    return scores.groupBy(*by).agg(
        F.try_divide(F.sum("tp"), F.sum("support")).alias("accuracy"),
        F.avg("f1").alias("macro_f1"),
        weighted.alias("weighted_f1"),
    )


def evaluate(df: DataFrame, actual: str, predicted: str, classes: int = 3) -> DataFrame:
    return overall_scores(class_scores(confusion_matrix(df, actual, predicted, classes)))
