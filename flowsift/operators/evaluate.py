"""Classifier evaluation without collecting predictions.

Confusion counts are the only pass over the rows for everything that needs just actual and predicted class.
Curves need scores: they are first summed per class and distinct score, then ranked in score ranges.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowsift.functions.columns import c, lookup_side, pct
from flowsift.session import materialize

#: Ranges of scores that are ranked apart from each other: so many at least, and more if a range would hold more points.
SCORE_RANGES, RANGE_POINTS = 256, 200_000


def _ratio(top: Column, bottom: Column) -> Column:
    """Division in which 0 / 0 is 0."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def confusion_counts(df: DataFrame, actual: str = "label_index", predicted: str = "prediction") -> DataFrame:
    return df.groupBy(c(actual).alias("actual"), c(predicted).alias("predicted")).agg(F.count(F.lit(1)).alias("n_rows"))


def confusion(df: DataFrame, actual: str = "label_index", predicted: str = "prediction") -> DataFrame:
    """Rows per pair of classes with the share within the actual class; pairs without rows are 0."""
    counts = confusion_counts(df, actual, predicted)
    seen = counts.agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.array("actual", "predicted"))))).alias("_classes")
    )
    pairs = seen.select(F.explode("_classes").alias("actual"), "_classes").select(
        "actual", F.explode("_classes").alias("predicted")
    )
    full = pairs.join(counts, ["actual", "predicted"], "left").fillna(0, subset=["n_rows"])
    in_class = F.sum("n_rows").over(Window.partitionBy("actual"))
    return full.withColumn("share", _ratio(F.col("n_rows"), in_class))


def top_confusions(counts: DataFrame, k: int = 15) -> DataFrame:
    """The `k` most frequent mistakes with their percentage of the actual class. Takes `confusion_counts`."""
    in_class = F.sum("n_rows").over(Window.partitionBy("actual"))
    wrong = counts.withColumn("pct_of_actual", pct(F.col("n_rows"), in_class)).filter("actual <> predicted AND n_rows > 0")
    return wrong.orderBy(F.desc("n_rows"), "actual", "predicted").limit(k)


def per_class(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support per class from `confusion_counts`."""
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n_rows")).otherwise(F.lit(0).cast("long"))
    sides = counts.select(
        *[c(b) for b in by],
        F.inline(
            F.array(
                F.struct(F.col("actual").alias("class"), F.col("n_rows").alias("_a"), F.lit(0).cast("long").alias("_p"), hit.alias("_h")),
                F.struct(F.col("predicted").alias("class"), F.lit(0).cast("long").alias("_a"), F.col("n_rows").alias("_p"), F.lit(0).cast("long").alias("_h")),
            )
        ),
    )
    sums = sides.groupBy(*[c(b) for b in by], "class").agg(F.sum("_a").alias("support"), F.sum("_p").alias("_p"), F.sum("_h").alias("_h"))
    precision, recall = _ratio(F.col("_h"), F.col("_p")), _ratio(F.col("_h"), F.col("support"))
    return sums.select(
        *[c(b) for b in by],
        "class",
        precision.alias("precision"),
        recall.alias("recall"),
        _ratio(2 * precision * recall, precision + recall).alias("f1"),
        "support",
        F.col("_h").alias("n_correct"),
    )


def averages(classes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, macro and weighted averages from `per_class`."""
    n = F.sum("support")

    def weighted(name: str) -> Column:
        return _ratio(F.sum(F.col(name) * F.col("support")), n)

    return classes.groupBy(*[c(b) for b in by]).agg(
        _ratio(F.sum("n_correct"), n).alias("accuracy"),
        *[F.avg(m).alias(f"macro_{m}") for m in ("precision", "recall", "f1")],
        *[weighted(m).alias(f"weighted_{m}") for m in ("precision", "recall", "f1")],
        n.alias("support"),
    )


def global_metrics(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy and the weighted F1, precision and recall."""
    table = averages(per_class(counts, by), by)
    return table.select(
        *[c(b) for b in by],
        "accuracy",
        F.col("weighted_f1").alias("f1"),
        F.col("weighted_precision").alias("weightedPrecision"),
        F.col("weighted_recall").alias("weightedRecall"),
    )


def compare_global(counts: DataFrame, models: Sequence[str], model: str = "model") -> DataFrame:
    """One row per metric, one column per model."""
    names = ["accuracy", "f1", "weightedPrecision", "weightedRecall"]
    long = global_metrics(counts, [model]).select(
        c(model), F.inline(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("_v")) for n in names]))
    )
    return long.groupBy("metric").pivot(model, list(models)).agg(F.first("_v"))


def compare_f1(counts: DataFrame, models: Sequence[str], model: str = "model") -> DataFrame:
    """F1 per class, one column per model; 0 where a model knows no such class."""
    table = per_class(counts, [model]).groupBy("class").pivot(model, list(models)).agg(F.first("f1"))
    return table.fillna(0.0, subset=list(models)).orderBy(models[-1], "class")


def scores_long(df: DataFrame, scores: str = "probability", actual: str = "label_index") -> DataFrame:
    """One row per row and class: the class number, its score and whether it is the actual class.

    `scores` may be a vector (`probability`, or `rawPrediction` of one-vs-rest) or an array.
    """
    column = c(scores)
    if not isinstance(df.schema[scores].dataType, T.ArrayType):
        column = vector_to_array(column)
    long = df.select(c(actual).alias("_y"), F.posexplode(column).alias("class", "score"))
    return long.select("class", "score", (F.col("_y") == F.col("class")).alias("positive"))


def _score_points(long: DataFrame, digits: int | None) -> DataFrame:
    score = F.col("score") if digits is None else F.round("score", digits)
    positive = F.when(F.col("positive"), 1).otherwise(0).cast("long")
    bad = F.col("score").isNull() | F.isnan("score")
    sound = F.when(bad, F.raise_error(F.lit("a score is null or NaN")).cast("double")).otherwise(score)
    return (
        long.groupBy("class", sound.alias("score"))
        .agg(F.sum(positive).alias("pos"), F.sum(1 - positive).alias("neg"))
    )


def ranked_scores(long: DataFrame, digits: int | None = None, ranges: int | None = None) -> DataFrame:
    """Running positives `tp` and negatives `fp` per class from the highest score down, ties as one point.

    Scores are cut into ranges of about equal size. Rows are ranked inside a range and start from the totals of
    the ranges above it, so no task holds all scores of a class. `digits` rounds the scores first if wanted.
    The number of ranges grows with the points. The points, far fewer than the predictions, are written once, because they
    are read three times. A null or NaN score has no place on a curve and is an error.
    """
    points = materialize(_score_points(long, digits), "scores")
    ranges = ranges or max(SCORE_RANGES, -(-points.count() // RANGE_POINTS))
    wanted = [i / ranges for i in range(1, ranges)]
    marks = points.agg(F.approx_percentile("score", wanted, max(10_000, 20 * ranges))).first()[0] or []
    edges = [-math.inf, *sorted(set(marks)), math.inf]
    if len(edges) < 3:
        edges = [-math.inf, 0.0, math.inf]
    cut = Bucketizer(splits=edges, inputCol="score", outputCol="_range").transform(points)
    sums = cut.groupBy("class", "_range").agg(F.sum("pos").alias("_pos"), F.sum("neg").alias("_neg"))
    above = Window.partitionBy("class").orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("class")
    offsets = sums.select(
        F.col("class").alias("_c"),
        F.col("_range").alias("_r"),
        F.coalesce(F.sum("_pos").over(above), F.lit(0)).alias("_tp0"),
        F.coalesce(F.sum("_neg").over(above), F.lit(0)).alias("_fp0"),
        F.sum("_pos").over(whole).alias("n_pos"),
        F.sum("_neg").over(whole).alias("n_neg"),
    )
    side = lookup_side(offsets, max_rows=50_000)
    joined = cut.join(side, (F.col("class") == F.col("_c")) & (F.col("_range") == F.col("_r")))
    inside = Window.partitionBy("class", "_range").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    return joined.select(
        "class",
        "score",
        "pos",
        "neg",
        (F.col("_tp0") + F.sum("pos").over(inside)).alias("tp"),
        (F.col("_fp0") + F.sum("neg").over(inside)).alias("fp"),
        "n_pos",
        "n_neg",
    )


def roc_points(ranked: DataFrame) -> DataFrame:
    """False and true positive rate per class and threshold, with the origin."""
    curve = ranked.select(
        "class",
        F.col("score").alias("threshold"),
        F.try_divide(F.col("fp").cast("double"), F.col("n_neg")).alias("fpr"),
        F.try_divide(F.col("tp").cast("double"), F.col("n_pos")).alias("tpr"),
    )
    origin = ranked.groupBy("class").agg(
        F.lit(math.inf).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return curve.unionByName(origin)


def pr_points(ranked: DataFrame) -> DataFrame:
    """Precision and recall per class and threshold, with the end point (recall 0, precision 1)."""
    curve = ranked.select(
        "class",
        F.col("score").alias("threshold"),
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.try_divide(F.col("tp").cast("double"), F.col("n_pos")).alias("recall"),
    )
    end = ranked.groupBy("class").agg(
        F.lit(math.inf).alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return curve.unionByName(end)


def roc_auc(ranked: DataFrame) -> DataFrame:
    """Area under the ROC curve per class (trapezoids); null where a class has no positives or no negatives."""
    area = F.sum(F.col("neg") * (2 * F.col("tp") - F.col("pos")).cast("double"))
    top = F.max(F.col("n_pos").cast("double") * F.col("n_neg") * 2)
    return ranked.groupBy("class").agg(F.try_divide(area, top).alias("auc"))


def average_precision(ranked: DataFrame) -> DataFrame:
    """Σ (Rₙ − Rₙ₋₁)·Pₙ per class."""
    step = F.col("pos") * (F.col("tp") / (F.col("tp") + F.col("fp")))
    return ranked.groupBy("class").agg(F.try_divide(F.sum(step), F.max("n_pos")).alias("ap"))


def macro(scores: DataFrame, name: str) -> DataFrame:
    """Mean over classes of a per-class score."""
    return scores.agg(F.avg(name).alias(f"macro_{name}"), F.count(name).alias("n_classes"))
