"""Accuracy, agreement and distribution tables.

Each is one aggregate: counts and sums are merged map-side, so shuffles carry one row per
group and task.  Long forms are made from the single aggregated row, not from the input rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseweave import fixed
from caseweave.functions.text import preview


def same(a: Column, b: Column) -> Column:
    """Equality in which a missing value equals nothing, not even another one."""
    return F.coalesce(a == b, F.lit(False))


def share(condition: Column) -> Column:
    return F.avg(F.coalesce(condition, F.lit(False)).cast("double"))


def accuracy(
    results: DataFrame,
    models: list[str] = ["trivial", "simple", "pipeline"],
    targets: dict[str, str] = {"intent": "true_intent", "escalate": "true_escalate"},
) -> DataFrame:
    """``(model, n_rows, intent_accuracy, ...)``; predictions are columns ``<model>_<target>``."""
    aggregates = [F.count(F.lit(1)).alias("n_rows")]
    for model in models:
        for target, truth in targets.items():
            hit = same(F.col(f"{model}_{target}"), F.col(truth))
            aggregates.append(share(hit).alias(f"{model}_{target}"))
    rows = [
        F.struct(
            F.lit(model).alias("model"),
            F.col("n_rows"),
            *[F.col(f"{model}_{target}").alias(f"{target}_accuracy") for target in targets],
        )
        for model in models
    ]
    return results.agg(*aggregates).select(F.inline(F.array(*rows)))


def majority_value(df: DataFrame, column: str) -> DataFrame:
    """The most frequent value as a one-row table; on a tie the smallest."""
    counts = (
        df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    )
    return counts.orderBy(F.col("n").desc(), column).limit(1).select(column)


def majority_labels(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row, one struct: the most frequent value of each label column, from a single pass.

    For columns with few distinct values, of which every task keeps the counts.
    """
    modes = [F.mode(c, True).alias(c) for c in columns]
    return df.agg(*modes).select(F.struct(*columns).alias("majority"))


def mean_scores(
    scores: DataFrame, dimensions: list[str] = fixed.RUBRIC_DIMENSIONS
) -> DataFrame:
    """``(dimension, n_rows, mean_score)``."""
    means = scores.agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.avg(d).alias(d) for d in dimensions]
    )
    rows = [
        F.struct(
            F.lit(d).alias("dimension"), F.col("n_rows"), F.col(d).alias("mean_score")
        )
        for d in dimensions
    ]
    return means.select(F.inline(F.array(*rows)))


def rater_agreement(
    paired: DataFrame,
    dimensions: list[str] = fixed.RUBRIC_DIMENSIONS,
    raters: tuple[str, str] = ("judge", "my"),
) -> DataFrame:
    """``(dimension, n_rows, exact_match, within_one)`` of columns ``<rater>_<dimension>``."""
    a, b = raters
    aggregates = [F.count(F.lit(1)).alias("n_rows")]
    for d in dimensions:
        left, right = F.col(f"{a}_{d}"), F.col(f"{b}_{d}")
        aggregates.append(share(left == right).alias(f"exact_{d}"))
        aggregates.append(share(F.abs(left - right) <= 1).alias(f"within_{d}"))
    rows = [
        F.struct(
            F.lit(d).alias("dimension"),
            F.col("n_rows"),
            F.col(f"exact_{d}").alias("exact_match"),
            F.col(f"within_{d}").alias("within_one"),
        )
        for d in dimensions
    ]
    return paired.agg(*aggregates).select(F.inline(F.array(*rows)))


def label_agreement(paired: DataFrame) -> DataFrame:
    """Agreement rates of a spot check: ``(n_rows, intent_agreement, escalate_agreement)``."""
    return paired.agg(
        F.count(F.lit(1)).alias("n_rows"),
        share(F.col("intent_agree")).alias("intent_agreement"),
        share(F.col("escalate_agree")).alias("escalate_agreement"),
    )


def disagreements(paired: DataFrame, message: str = "message") -> DataFrame:
    """Rows of a spot check in which intent or decision differ, with a preview of the text."""
    return paired.where(~(F.col("intent_agree") & F.col("escalate_agree"))).withColumn(
        "preview", preview(F.col(message))
    )


def score_distribution(
    paired: DataFrame,
    dimensions: list[str] = fixed.RUBRIC_DIMENSIONS,
    raters: tuple[str, ...] = ("judge", "my"),
) -> DataFrame:
    """``(rater, dimension, score, n_rows)``: how often each score occurs."""
    scores = [
        F.struct(
            F.lit(r).alias("rater"),
            F.lit(d).alias("dimension"),
            F.col(f"{r}_{d}").cast("int").alias("score"),
        )
        for r in raters
        for d in dimensions
    ]
    return (
        paired.select(F.inline(F.array(*scores)))
        .groupBy("rater", "dimension", "score")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def score_ranges(distribution: DataFrame) -> DataFrame:
    """Lowest and highest score per rater and dimension, from the distribution."""
    return distribution.groupBy("rater", "dimension").agg(
        F.min("score").alias("min_score"), F.max("score").alias("max_score")
    )


def confusion(results: DataFrame, truth: str, predicted: str) -> DataFrame:
    """``(truth, predicted, n_rows)``: which values are taken for which."""
    return results.groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def confusion_matrix(pairs: DataFrame, values: list[str]) -> DataFrame:
    """The confusion table with one column per predicted value."""
    return (
        pairs.groupBy("truth").pivot("predicted", values).agg(F.sum("n_rows")).na.fill(0, values)
    )
