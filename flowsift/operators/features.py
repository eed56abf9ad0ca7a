"""Feature preparation and selection."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowsift.functions.columns import c, number_or_zero, per_column
from flowsift.functions.hashing import fast_uniform, row_key
from flowsift.operators.distribution import high_pairs
from flowsift.operators.moments import correlation, gram
from flowsift.operators.training import sized_forest, store_for_fit

CORRELATION_LIMIT, VIF_LIMIT, VARIANCE_SHARE = 0.95, 10.0, 0.95


def label_index(df: DataFrame, label: str = "Label", target: str = "label_index") -> DataFrame:
    """Class number by falling frequency, ties by name; a null or unseen label is an error."""
    return StringIndexer(inputCol=label, outputCol=target, handleInvalid="error").fit(df).transform(df)


def assemble(df: DataFrame, names: Sequence[str], target: str = "features") -> DataFrame:
    """Columns to one vector; rows with a null or NaN among them are skipped."""
    return VectorAssembler(inputCols=list(names), outputCol=target, handleInvalid="skip").transform(df)


def fit_scaler(train: DataFrame, source: str = "features_raw", target: str = "features"):
    """Standard scaler on the training side only; transform both sides with the model it returns."""
    return StandardScaler(inputCol=source, outputCol=target, withMean=True, withStd=True).fit(train)


def standard_scale(df: DataFrame, names: Sequence[str], train: DataFrame | None = None) -> DataFrame:
    """Column form of the scaler: (x − mean) / sample deviation of `train`; constant columns become 0."""
    base = df if train is None else train
    aggs = []
    for i, n in enumerate(names):
        value = c(n).cast("double")
        aggs += [F.avg(value).alias(f"m{i}"), F.stddev_samp(value).alias(f"s{i}")]
    row = base.agg(*aggs).first()
    out = {}
    for i, n in enumerate(names):
        mean, sd = row[f"m{i}"], row[f"s{i}"]
        out[n] = (c(n).cast("double") - F.lit(mean)) / F.lit(sd) if sd else c(n).cast("double") * 0.0
    return df.withColumns(out)


def to_arrays(df: DataFrame, vector: str = "features", target: str | None = None) -> DataFrame:
    return df.withColumn(target or vector, vector_to_array(c(vector)))


def correlated_features(matrix: DataFrame, threshold: float = CORRELATION_LIMIT) -> DataFrame:
    """The later column of every pair above the threshold, even when its partner goes too."""
    return (
        high_pairs(matrix, threshold)
        .groupBy(F.col("y").alias("feature"))
        .agg(F.count(F.lit(1)).alias("n_pairs"), F.max(F.abs("r")).alias("max_r"))
    )


def prune_correlated(df: DataFrame, names: Sequence[str], threshold: float = CORRELATION_LIMIT) -> list[str]:
    """Names left after dropping `correlated_features`, in their order."""
    gone = {r["feature"] for r in correlated_features(correlation(df, names), threshold).collect()}
    return [n for n in names if n not in gone]


def rf_importance(
    df: DataFrame,
    names: Sequence[str],
    label: str = "label_index",
    trees: int = 30,
    depth: int = 10,
    seed: int = 42,
    max_bins: int = 32,
    share: float = 1.0,
) -> DataFrame:
    """Features ranked by random-forest importance, fitted on all rows or on a `share` of them drawn by a hash of the row."""
    if share < 1:
        df = df.filter(fast_uniform(seed, row_key(df)) < share)
    packer = VectorAssembler(inputCols=list(names), outputCol="_features", handleInvalid="skip")
    rows = packer.transform(df.select(*[c(n) for n in names], c(label))).select("_features", c(label))
    packed = store_for_fit(rows, "importance", trees=trees, width=len(names))
    model = sized_forest(packed, label, "_features", numTrees=trees, maxDepth=depth, seed=seed, maxBins=max_bins).fit(packed)
    weights = model.featureImportances.toArray()
    order = sorted(range(len(names)), key=lambda i: (-weights[i], names[i]))
    ranked = [(rank + 1, names[i], float(weights[i])) for rank, i in enumerate(order)]
    return df.sparkSession.createDataFrame(ranked, "rank int, feature string, importance double")


def _components(df: DataFrame, names: Sequence[str]) -> tuple[DataFrame, np.ndarray, np.ndarray, dict]:
    """(complete rows, explained shares, loadings, mean and deviation per column).

    Principal components of standardised columns are eigenvectors of their correlation matrix, which is columns × columns
    whatever the table; only that reaches the driver. The largest loading of each component is positive.
    """
    numbers = {n: c(n).cast("double") for n in names}
    sound = [v.isNotNull() & ~F.isnan(v) for v in numbers.values()]
    rows = df.filter(reduce(lambda a, b: a & b, sound))
    stats = rows.agg(*[F.struct(F.avg(v), F.stddev_samp(v)).alias(f"_{i}") for i, v in enumerate(numbers.values())]).first()
    r = np.eye(len(names))
    for cell in correlation(rows, names).collect():
        r[cell["i"], cell["j"]] = 0.0 if cell["r"] is None or np.isnan(cell["r"]) else cell["r"]
    values, vectors = np.linalg.eigh(r)
    order = np.argsort(-values, kind="stable")
    values, vectors = np.maximum(values[order], 0), vectors[:, order]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(names))])
    return rows, values / values.sum(), vectors, {n: tuple(stats[i]) for i, n in enumerate(names)}


def pca_scree(df: DataFrame, names: Sequence[str], share: float = VARIANCE_SHARE) -> DataFrame:
    """Explained variance per component, running total, and the components needed for `share`."""
    _, variance, _, _ = _components(df, names)
    total = np.cumsum(variance)
    needed = int(np.argmax(total >= share - 1e-12)) + 1
    rows = [(i + 1, float(v), float(t), i + 1 == needed) for i, (v, t) in enumerate(zip(variance, total))]
    return df.sparkSession.createDataFrame(rows, "component int, explained double, cumulative double, reaches_share boolean")


def pca_project(df: DataFrame, names: Sequence[str], keep: Sequence[str], k: int = 2) -> DataFrame:
    """First `k` principal components per row beside the columns to keep."""
    rows, _, vectors, stats = _components(df, names)
    z = {n: F.coalesce(F.try_divide(c(n).cast("double") - F.lit(m), F.lit(s)), F.lit(0.0)) for n, (m, s) in stats.items()}
    parts = [reduce(lambda a, b: a + b, [z[n] * float(vectors[i, j]) for i, n in enumerate(names)]) for j in range(k)]
    return rows.select(*[c(n) for n in keep], *[p.alias(f"pc{j + 1}") for j, p in enumerate(parts)])


def f_tail(f: Column, d1: Column, d2: Column) -> Column:
    """P(F > f) for the F distribution: continued fraction of the regularised incomplete beta function."""

    def tail(f: float, d1: float, d2: float) -> float:
        if f is None or f != f:
            return math.nan
        if f <= 0 or math.isinf(f):
            return 1.0 if f <= 0 else 0.0
        a, b, x = d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f)
        flip = x >= (a + 1) / (a + b + 2)
        if flip:
            a, b, x = b, a, 1.0 - x
        front = a * math.log(x) + b * math.log1p(-x) + math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
        tiny = 1e-300
        num, den = 1.0, 1.0 / ((1.0 - (a + b) * x / (a + 1)) or tiny)
        value = den
        for m in range(1, 10_000):
            for step in (
                m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
            ):
                den = 1.0 / ((1.0 + step * den) or tiny)
                num = (1.0 + step / num) or tiny
                value *= num * den
            if abs(num * den - 1.0) < 1e-15:
                break
        part = math.exp(front) * value / a
        return 1.0 - part if flip else part

    @F.pandas_udf(T.DoubleType())
    def tails(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
        return pd.Series([tail(x, a, b) for x, a, b in zip(f, d1, d2)], dtype="float64")

    return tails(f, d1, d2)


def anova_f(df: DataFrame, names: Sequence[str], label: str = "Label", fill_zero: bool = True) -> DataFrame:
    """One-way ANOVA per feature over the whole table: F score and p value, best first.

    Built from count, mean and variance per class, so one shuffle of class × feature rows is all it takes.
    Missing values count as 0 unless `fill_zero` is off.
    """
    make = number_or_zero if fill_zero else (lambda col: col.cast("double"))
    per_class = per_column(
        df.filter(c(label).isNotNull()),
        list(names),
        {
            "n": lambda n: F.count(make(c(n))),
            "m": lambda n: F.avg(make(c(n))),
            "v": lambda n: F.var_pop(make(c(n))),
        },
        by=[label],
    ).filter("n > 0")
    overall = Window.partitionBy("column")
    grand = F.sum(F.col("n") * F.col("m")).over(overall) / F.sum("n").over(overall)
    sums = (
        per_class.withColumn("_between", F.col("n") * F.pow(F.col("m") - grand, F.lit(2.0)))
        .groupBy(F.col("column").alias("feature"))
        .agg(
            F.sum("_between").alias("_ssb"),
            F.sum(F.col("n") * F.col("v")).alias("_ssw"),
            (F.count(F.lit(1)) - 1).cast("double").alias("df_between"),
            (F.sum("n") - F.count(F.lit(1))).cast("double").alias("df_within"),
        )
    )
    score = F.try_divide(F.col("_ssb") / F.col("df_between"), F.col("_ssw") / F.col("df_within"))
    scored = sums.filter("df_between > 0").withColumn("f_score", score)
    return scored.select(
        "feature", "f_score", f_tail(F.col("f_score"), F.col("df_between"), F.col("df_within")).alias("p_value")
    ).orderBy(F.desc_nulls_last("f_score"), "feature")


def vif(df: DataFrame, names: Sequence[str], limit: float = VIF_LIMIT) -> DataFrame:
    """Variance inflation without intercept: Gᵢᵢ·(G⁻¹)ᵢᵢ of the Gram matrix, highest first.

    Only the k × k matrix reaches the driver. A singular matrix gives infinity to the columns involved.
    """
    k = len(names)
    g = np.zeros((k, k))
    for r in gram(df, names).collect():
        g[r["i"], r["j"]] = g[r["j"], r["i"]] = r["g"]
    scale = np.sqrt(np.diag(g))
    scale[scale == 0] = 1.0
    unit = g / np.outer(scale, scale)
    rows = []
    for i, name in enumerate(names):
        rest = [j for j in range(k) if j != i]
        fit, *_ = np.linalg.lstsq(unit[np.ix_(rest, rest)], unit[rest, i], rcond=None)
        left = unit[i, i] - unit[rest, i] @ fit
        value = float(unit[i, i] / left) if left > 1e-12 else math.inf
        rows.append((name, value, value > limit))
    rows.sort(key=lambda r: (-r[1], r[0]))
    return df.sparkSession.createDataFrame(rows, "feature string, vif double, above_limit boolean")


def method_table(
    all_names: Sequence[str],
    kept: Sequence[str],
    anova: DataFrame,
    importance: DataFrame | None = None,
    inflation: DataFrame | None = None,
    top_importance: int = 20,
    top_anova: int = 30,
) -> DataFrame:
    """One row per feature: kept by the correlation filter, rank by each method, and in both top lists."""
    spark = anova.sparkSession
    base = spark.createDataFrame(
        pa.table({"feature": list(all_names), "kept": [n in set(kept) for n in all_names]})
    )
    ranks = anova.withColumn(
        "anova_rank", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.desc_nulls_last("f_score"), "feature"))
    ).select("feature", "f_score", "anova_rank")
    out = base.join(ranks, "feature", "left")
    if importance is not None:
        out = out.join(importance.select("feature", "importance", F.col("rank").alias("rf_rank")), "feature", "left")
        both = (F.col("rf_rank") <= top_importance) & (F.col("anova_rank") <= top_anova)
        out = out.withColumn("consensus", F.coalesce(both, F.lit(False)))
    if inflation is not None:
        out = out.join(inflation.select("feature", "vif", F.col("above_limit").alias("vif_high")), "feature", "left")
    return out


def gold(df: DataFrame, names: Sequence[str], label: str = "Label", index: str = "label_index") -> DataFrame:
    """Label, class number and the chosen features."""
    return df.select(c(label), c(index), *[c(n) for n in names])
