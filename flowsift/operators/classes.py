"""Class distribution, rankings and set operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import StringIndexer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowsift.functions.columns import c, finite, join_on, lookup_side, pct

OTHER = "other"


def class_counts(df: DataFrame, label: str = "Label") -> DataFrame:
    return (
        df.groupBy(c(label).alias("Label"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .orderBy(F.desc("n_rows"), "Label")
    )


def _counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(c(label).alias("Label")).agg(F.count(F.lit(1)).alias("n_rows"))


def class_share(df: DataFrame, label: str = "Label", digits: int = 4) -> DataFrame:
    """Rows and percentage per class."""
    counts = _counts(df, label)
    total = counts.agg(F.sum("n_rows")).scalar()
    return counts.withColumn("pct", pct(F.col("n_rows"), total, digits)).orderBy(F.desc("n_rows"), "Label")


def fold_long_tail(df: DataFrame, label: str = "Label", below_pct: float = 2.0, other: str = OTHER) -> DataFrame:
    """Classes below `below_pct` percent become one row `other`, which lists how many it holds."""
    counts = _counts(df, label)
    total = counts.agg(F.sum("n_rows")).scalar()
    share = F.try_divide(F.col("n_rows").cast("double"), total) * 100
    parts = counts.select(F.when(share < below_pct, other).otherwise(F.col("Label")).alias("Label"), "n_rows", share.alias("_p"))
    return (
        parts.groupBy("Label")
        .agg(
            F.sum("n_rows").alias("n_rows"),
            F.round(F.sum("_p"), 4).alias("pct"),
            F.count(F.lit(1)).alias("n_classes"),
        )
        .orderBy(F.desc("n_rows"), "Label")
    )


def long_tail(df: DataFrame, label: str = "Label", below_pct: float = 2.0) -> DataFrame:
    """The classes that `fold_long_tail` folds."""
    counts = _counts(df, label)
    total = counts.agg(F.sum("n_rows")).scalar()
    share = F.try_divide(F.col("n_rows").cast("double"), total) * 100
    small = counts.filter(share < below_pct).withColumn("pct", pct(F.col("n_rows"), total, 4))
    return small.orderBy(F.desc("n_rows"), "Label")


def n_classes(df: DataFrame, label: str = "Label") -> DataFrame:
    return df.agg(F.count_distinct(c(label)).alias("n_classes"))


def label_index_map(df: DataFrame, label: str = "Label", index: str = "label_index") -> DataFrame:
    return df.select(c(label).alias("Label"), c(index).alias("label_index")).distinct().orderBy("label_index")


def class_id(df: DataFrame, label: str = "Label", target: str = "class_id") -> DataFrame:
    """0-based number of the class in alphabetical order."""
    model = StringIndexer(inputCol=label, outputCol=target, stringOrderType="alphabetAsc").fit(df)
    return model.transform(df).withColumn(target, c(target).cast("int"))


def top_classes(df: DataFrame, k: int, label: str = "Label") -> DataFrame:
    return class_counts(df, label).limit(k)


def keep_top_classes(df: DataFrame, k: int, label: str = "Label") -> DataFrame:
    """Rows of the `k` largest classes."""
    top = lookup_side(top_classes(df, k, label).select(F.col("Label").alias(label)))
    return join_on(df, top, [label], "left_semi")


def median_class_size(df: DataFrame, label: str = "Label") -> DataFrame:
    """Median of the rows per class, and the whole number below it."""
    sizes = _counts(df, label).groupBy("n_rows").agg(F.count(F.lit(1)).alias("_m"))
    return sizes.agg(F.percentile("n_rows", F.lit(0.5), F.col("_m")).alias("median")).withColumn(
        "target", F.floor("median").cast("long")
    )


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; a column missing in one frame is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def consensus(left: DataFrame, right: DataFrame, name: str = "feature") -> DataFrame:
    """Names in both rankings."""
    return left.select(c(name)).intersect(right.select(c(name))).orderBy(name)


def anti_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `left` whose key is not in `right`. `right` is cut to distinct keys before the shuffle."""
    return left.join(right.select(*[c(k) for k in keys]).distinct(), list(keys), "left_anti")


def class_mean_std(df: DataFrame, names: Sequence[str], label: str = "Label") -> DataFrame:
    """Mean and sample deviation of the finite values per class and column."""
    stats = F.array(
        *[
            F.struct(
                F.lit(n).alias("column"),
                F.avg(finite(c(n).cast("double"))).alias("mean"),
                F.stddev_samp(finite(c(n).cast("double"))).alias("stddev"),
            )
            for n in names
        ]
    )
    return df.groupBy(c(label).alias("Label")).agg(stats.alias("_s")).select("Label", F.inline("_s"))


def class_profile(df: DataFrame, names: Sequence[str], label: str = "Label", classes: Sequence[str] | None = None):
    """Class means scaled to 0…1 across classes; a column with equal means keeps them unscaled."""
    means = class_mean_std(df if classes is None else df.filter(c(label).isin(list(classes))), names, label)
    across = Window.partitionBy("column")
    low, high = F.min("mean").over(across), F.max("mean").over(across)
    scaled = F.when(high > low, (F.col("mean") - low) / (high - low)).otherwise(F.col("mean"))
    return means.select("Label", "column", scaled.alias("profile"))
