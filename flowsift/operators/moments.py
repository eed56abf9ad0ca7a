"""Second moments of many columns at once.

One `corr` or `sum` per pair of columns makes aggregates too large for code generation from some dozen columns
on. Here each task multiplies its Arrow batches with numpy and hands one small triangle to the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowsift.functions.columns import c, finite

#: Up to so many columns plain sums stay inside generated code.
PLAIN_SUM_COLUMNS = 8

_FIELDS = ("n", "mx", "my", "cxx", "cyy", "cxy")


def _numbers(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*[finite(c(n).cast("double")).alias(f"_c{i}") for i, n in enumerate(names)])


def _joined(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """Count, means and centred sums of two sets of rows together, per pair of columns."""
    n, mx, my, cxx, cyy, cxy = a
    m, ux, uy, dxx, dyy, dxy = b
    both = n + m
    share = np.divide(m, both, out=np.zeros_like(both), where=both > 0)
    dx, dy, weight = ux - mx, uy - my, n * share
    return both, mx + dx * share, my + dy * share, cxx + dxx + dx * dx * weight, cyy + dyy + dy * dy * weight, cxy + dxy + dx * dy * weight


def _block_moments(x: np.ndarray) -> tuple[np.ndarray, ...]:
    """Count, means and centred sums per pair of columns of a block, a pair taking the rows where both are present."""
    there = ~np.isnan(x)
    x, w = np.where(there, x, 0.0), there.astype(float)
    n, sx = w.T @ w, x.T @ w
    sxx, sxy = (x * x).T @ w, x.T @ x
    mx = np.divide(sx, n, out=np.zeros_like(sx), where=n > 0)
    my = mx.T
    return n, mx, my, sxx - n * mx * mx, sxx.T - n * my * my, sxy - n * mx * my


def pair_moments(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Per pair i ≤ j over the rows where both values are present: count `n`, means `mx`, `my`, centred sums `cxx`, `cyy`, `cxy`.

    One read. A task takes its first mean of a column off all its values and joins the moments of its batches; the moments of
    the tasks, a small table, are joined around their common mean. Nothing is lost where values are large against their spread.
    """
    k = len(names)
    left, right = np.triu_indices(k)

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, pilot = tuple(np.zeros((k, k)) for _ in _FIELDS), np.full(k, np.nan)
        for batch in batches:
            if batch.num_rows:
                block = np.column_stack([col.to_numpy(zero_copy_only=False).astype(float) for col in batch.columns])
                new = np.flatnonzero(np.isnan(pilot) & ~np.isnan(block).all(axis=0))
                pilot[new] = np.nanmean(block[:, new], axis=0)
                held = _joined(held, _block_moments(block - pilot))
        if held[0].any():
            pilot = np.nan_to_num(pilot)
            sums = [s[left, right] for s in held] + [pilot[left], pilot[right]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(left.astype("int32")), pa.array(right.astype("int32")), *[pa.array(s) for s in sums]],
                names=["i", "j", *_FIELDS, "px", "py"],
            )

    fields = ", ".join(f"{f} double" for f in (*_FIELDS, "px", "py"))
    parts = _numbers(df, names).mapInArrow(per_task, f"i int, j int, {fields}").where("n > 0")
    pair = Window.partitionBy("i", "j")
    for pilot, mean in (("px", "mx"), ("py", "my")):  # means as distances from one task's pilot
        parts = parts.withColumn("_least", F.min(pilot).over(pair))
        parts = parts.withColumn(mean, (F.col(pilot) - F.col("_least")) + F.col(mean)).withColumn(pilot, F.col("_least"))
    common = lambda m: F.sum(F.col("n") * F.col(m)).over(pair) / F.sum("n").over(pair)
    dx, dy, n = F.col("mx") - F.col("_x"), F.col("my") - F.col("_y"), F.col("n")
    return parts.withColumns({"_x": common("mx"), "_y": common("my")}).groupBy("i", "j").agg(
        F.sum("n").alias("n"),
        F.max(F.col("px") + F.col("_x")).alias("mx"),
        F.max(F.col("py") + F.col("_y")).alias("my"),
        F.sum(F.col("cxx") + n * dx * dx).alias("cxx"),
        F.sum(F.col("cyy") + n * dy * dy).alias("cyy"),
        F.sum(F.col("cxy") + n * dx * dy).alias("cxy"),
    )


def correlation(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Pearson correlation of every ordered pair of columns with a position: rows (i, j, x, y, r).

    Each pair uses the rows where both values are present. A column without spread has null with all others.
    """
    names = list(names)
    sums = pair_moments(df, names)
    n = F.col("n")
    # a spread within the rounding of the mean is none
    rounding = lambda m: n * F.pow(F.col(m) * 1e-14, F.lit(2))
    spread = (F.col("cxx") > rounding("mx")) & (F.col("cyy") > rounding("my"))
    r = F.when(spread, F.greatest(F.least(F.col("cxy") / F.sqrt(F.col("cxx") * F.col("cyy")), F.lit(1.0)), F.lit(-1.0)))
    upper = sums.filter((F.col("i") < F.col("j")) & (n > 0)).select("i", "j", r.alias("r"))
    mirrored = upper.select(
        F.inline(F.array(F.struct("i", "j", "r"), F.struct(F.col("j").alias("i"), F.col("i").alias("j"), "r")))
    )
    position = F.col("id").cast("int")
    diagonal = df.sparkSession.range(len(names)).select(position.alias("i"), position.alias("j"), F.lit(1.0).alias("r"))
    name_at = F.array(*[F.lit(name) for name in names])
    return mirrored.unionByName(diagonal).select(
        "i", "j", F.element_at(name_at, F.col("i") + 1).alias("x"), F.element_at(name_at, F.col("j") + 1).alias("y"), "r"
    )


def gram(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Σ xᵢ·xⱼ over rows where all columns are present: rows (i, j, g), i ≤ j."""
    k = len(names)
    numbers = _numbers(df, names).dropna()
    if k <= PLAIN_SUM_COLUMNS:
        cells = [
            F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.sum(F.col(f"_c{i}") * F.col(f"_c{j}")).alias("g"))
            for i in range(k)
            for j in range(i, k)
        ]
        return numbers.agg(F.array(*cells).alias("_g")).select(F.inline("_g"))
    left, right = np.triu_indices(k)

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in batches:
            block = np.column_stack([col.to_numpy(zero_copy_only=False) for col in batch.columns])
            total += block.T @ block
        yield pa.RecordBatch.from_arrays(
            [pa.array(left.astype("int32")), pa.array(right.astype("int32")), pa.array(total[left, right])],
            names=["i", "j", "g"],
        )

    return numbers.mapInArrow(per_task, "i int, j int, g double").groupBy("i", "j").agg(F.sum("g").alias("g"))
