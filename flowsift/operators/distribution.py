"""Distribution and bivariate statistics over whole tables.

Every curve is computed from pre-aggregated cells (bins, class × bin, rank brackets), so what follows the first
aggregate is small and independent of the number of rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from statistics import NormalDist

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsift.functions.columns import c, finite, join_on, lookup_side, pct
from flowsift.operators.quantiles import quantile_bounds, quantiles, quantiles_long


def _number(name: str) -> Column:
    return finite(c(name).cast("double"))


def _bin_of(value: Column, low: Column, high: Column, bins: int) -> Column:
    """0-based equal-width bin, the maximum falling into the last one; a constant column has only bin 0."""
    width = (high - low) / bins
    raw = F.floor(F.try_divide(value - low, width)).cast("int")
    return F.least(F.greatest(F.coalesce(raw, F.lit(0)), F.lit(0)), F.lit(bins - 1))


def trim(df: DataFrame, name: str, low: float, high: float) -> DataFrame:
    """Rows whose value lies between two exact quantiles, ends included."""
    lo, hi = quantile_bounds(df, name, low, high)
    return df.filter(c(name).between(lo, hi))


def trim_report(df: DataFrame, name: str, low: float, high: float) -> DataFrame:
    """Bounds of a trim with the rows it keeps and excludes (nulls and NaN are no rows here)."""
    lo, hi = quantile_bounds(df, name, low, high)
    value = c(name).cast("double")
    present = value.isNotNull() & ~F.isnan(value)
    sums = df.agg(
        F.lit(lo).alias("low"),
        F.lit(hi).alias("high"),
        F.count_if(present).alias("n_total"),
        F.count_if(present & value.between(lo, hi)).alias("n_kept"),
    )
    return sums.withColumn("n_excluded", F.col("n_total") - F.col("n_kept")).withColumn(
        "pct_excluded", pct(F.col("n_excluded"), F.col("n_total"), 4)
    )


def trim_sequential(df: DataFrame, names: Sequence[str], low: float = 0.02, high: float = 0.98):
    """Trim by one column after the other, each on the rows left. Returns the rows and a report."""
    left, tests, steps = df, F.lit(True), []
    for name in names:
        lo, hi = quantile_bounds(left, name, low, high)
        test = c(name).between(lo, hi)
        left, tests = left.filter(test), tests & test
        steps.append((name, lo, hi, tests))
    rows = [
        F.struct(
            F.lit(i).alias("step_no"),
            F.lit(name).alias("column"),
            F.lit(lo).alias("low"),
            F.lit(hi).alias("high"),
            F.count_if(F.coalesce(test, F.lit(False))).alias("rows_left"),
        )
        for i, (name, lo, hi, test) in enumerate(steps)
    ]
    report = df.agg(F.count(F.lit(1)), F.array(*rows).alias("_r")).select(F.inline("_r"))
    return left, report


def _spread(df: DataFrame, name: str) -> tuple[float | None, float | None]:
    row = df.agg(F.min(_number(name)).alias("lo"), F.max(_number(name)).alias("hi")).first()
    return row["lo"], row["hi"]


def histogram(df: DataFrame, name: str, bins: int = 50) -> DataFrame:
    """Equal-width histogram over the finite values with counts and density; empty bins are kept.

    A constant column gets one unit around its value, as plotting libraries do.
    """
    lo, hi = _spread(df, name)
    if lo is None:
        raise ValueError(f"column {name!r} holds no finite value")
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    filled = (
        df.select(_number(name).alias("_v"))
        .filter(F.col("_v").isNotNull())
        .groupBy(_bin_of(F.col("_v"), F.lit(lo), F.lit(hi), bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    counts = every.join(filled, "bin", "left").fillna(0, subset=["n_rows"])
    total = filled.agg(F.sum("n_rows")).scalar()
    return counts.select(
        "bin",
        (F.lit(lo) + F.col("bin") * width).alias("low"),
        (F.lit(lo) + (F.col("bin") + 1) * width).alias("high"),
        "n_rows",
        (F.col("n_rows") / (total * width)).alias("density"),
    )


def histogram_trimmed(df: DataFrame, name: str, low: float = 0.005, high: float = 0.995, bins: int = 50) -> DataFrame:
    return histogram(trim(df, name, low, high), name, bins)


#: Cells per bandwidth, moments kept of each cell, and bandwidths that a kernel reaches.
_CELLS, _MOMENTS, _REACH = 4, 9, 8.5


def _hermite(z: Column, order: int) -> list[Column]:
    """Probabilists' Hermite polynomials up to `order`."""
    found = [F.lit(1.0), z]
    for k in range(1, order):
        found.append(z * found[k] - k * found[k - 1])
    return found[: order + 1]


def density(df: DataFrame, name: str, grid: int = 1000, by: str | None = None, min_rows: int = 2):
    """Gaussian kernel density on an even grid with Scott's bandwidth, equal to the sum over all rows within 1e-10 of its peak.

    Rows are gathered in cells of a quarter bandwidth, of which only those with rows exist, so far values cost nothing. A
    cell keeps the first moments of its rows around its middle, from which the Hermite series of the kernel gives the
    cell's share at every grid point it reaches. The grid goes half the range beyond both ends. Groups with fewer than
    `min_rows` rows are left out.
    """
    keys = [by] if by else []
    slim = df.select(*[c(k) for k in keys], _number(name).alias("_v")).filter(F.col("_v").isNotNull())
    spread = lookup_side(
        slim.groupBy(*[c(k) for k in keys])
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.min("_v").alias("_lo"),
            F.max("_v").alias("_hi"),
            F.stddev_samp("_v").alias("_sd"),
        )
        .filter((F.col("_n") >= min_rows) & (F.col("_hi") > F.col("_lo")))
    )
    if keys:
        joined = join_on(slim, spread, keys)
    else:
        row = spread.first()
        if row is None:
            raise ValueError(f"column {name!r} has no spread")
        joined = slim.withColumns({k: F.lit(row[k]) for k in ("_n", "_lo", "_hi", "_sd")})
    shape = ["_n", "_lo", "_hi", "_sd"]
    width = F.col("_sd") * F.pow(F.col("_n").cast("double"), F.lit(-0.2))
    cell = F.floor((F.col("_v") - F.col("_lo")) / (width / _CELLS))
    middle = F.col("_lo") + (F.col("_b") + 0.5) * (width / _CELLS)
    off = joined.withColumn("_b", cell).withColumn("_t", (F.col("_v") - middle) / width)
    powers = [F.lit(1.0)]
    for _ in range(1, _MOMENTS):
        powers.append(powers[-1] * F.col("_t"))
    moments = [F.sum(x).alias(f"_m{k}") for k, x in enumerate(powers)]
    cells = off.groupBy(*[c(k) for k in keys], *shape, "_b").agg(*moments)
    span = F.col("_hi") - F.col("_lo")
    step = span * 2 / (grid - 1)
    start = F.col("_lo") - span * 0.5
    first = F.greatest(F.lit(0), F.ceil((middle - width * _REACH - start) / step)).cast("int")
    last = F.least(F.lit(grid - 1), F.floor((middle + width * _REACH - start) / step)).cast("int")
    reached = cells.withColumns({"_first": first, "_last": last}).filter("_first <= _last")
    spread_out = reached.withColumn("point", F.explode(F.sequence("_first", "_last")))
    z = (start + F.col("point") * step - middle) / width
    series = [h * F.col(f"_m{k}") / math.factorial(k) for k, h in enumerate(_hermite(F.col("_z"), _MOMENTS - 1))]
    share = F.exp(-0.5 * F.col("_z") * F.col("_z")) * sum(series[1:], series[0]) / (F.col("_n") * width * math.sqrt(2 * math.pi))
    sums = spread_out.withColumn("_z", z).groupBy(*[c(k) for k in keys], "point").agg(F.sum(share).alias("density"))
    base = spread if keys else df.sparkSession.createDataFrame([tuple(row[k] for k in shape)], "_n long, _lo double, _hi double, _sd double")
    points = base.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
    whole = join_on(points.select(*[c(k) for k in keys], "point", (start + F.col("point") * step).alias("x")), sums, [*keys, "point"], "left")
    return whole.select(*[c(k) for k in keys], "point", "x", F.greatest(F.coalesce("density", F.lit(0.0)), F.lit(0.0)).alias("density"))


def ridge(
    df: DataFrame,
    name: str,
    label: str = "Label",
    classes: Sequence[str] | None = None,
    low: float = 0.01,
    high: float = 0.99,
    min_rows: int = 11,
    grid: int = 1000,
) -> DataFrame:
    """Density per class after trimming inside each class; classes with at most ten rows left are passed over."""
    kept = df if classes is None else df.filter(c(label).isin(list(classes)))
    return density(trim_by_class(kept, name, label, low, high), name, grid, by=label, min_rows=min_rows)


def trim_by_class(df: DataFrame, name: str, label: str = "Label", low: float = 0.01, high: float = 0.99) -> DataFrame:
    bounds = quantiles(df, [name], {"_low": low, "_high": high}, by=[label]).select(c(label), "_low", "_high")
    joined = join_on(df, lookup_side(bounds), [label])
    return joined.filter(c(name).between(F.col("_low"), F.col("_high"))).drop("_low", "_high")


QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def class_quartiles(df: DataFrame, names: Sequence[str], label: str = "Label", classes: Sequence[str] | None = None):
    kept = df if classes is None else df.filter(c(label).isin(list(classes)))
    return quantiles(kept, names, QUARTILES, by=[label])


def box_stats(df: DataFrame, names: Sequence[str], by: str | None = None, reach: float = 1.5) -> DataFrame:
    """Quartiles, whiskers (last values within `reach` · IQR of the box) and outliers per column, and per class, of finite values."""
    keys = [by] if by else []
    df = df.select(*[c(k) for k in keys], *[_number(n).alias(n) for n in names])
    quarts = lookup_side(quantiles(df, names, QUARTILES, by=keys))
    long = df.select(
        *[c(k) for k in keys],
        F.inline(F.array(*[F.struct(F.lit(n).alias("column"), _number(n).alias("_v")) for n in names])),
    ).filter(F.col("_v").isNotNull())
    joined = join_on(long, quarts, [*keys, "column"])
    gap = (F.col("q3") - F.col("q1")) * reach
    inside = F.col("_v").between(F.col("q1") - gap, F.col("q3") + gap)
    return joined.groupBy(*[c(k) for k in keys], "column", "q1", "median", "q3").agg(
        F.least(F.min(F.when(inside, F.col("_v"))), F.col("q1")).alias("whisker_low"),
        F.greatest(F.max(F.when(inside, F.col("_v"))), F.col("q3")).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def box_stats_trimmed(df: DataFrame, name: str, by: str | None = None, low: float = 0.01, high: float = 0.99):
    """Box statistics of one column between two quantiles of the whole column."""
    return box_stats(trim(df, name, low, high), [name], by)


def normal_positions(points: int) -> list[tuple[float, float]]:
    """Filliben's order-statistic medians with the normal quantiles at them."""
    last = 0.5 ** (1.0 / points)
    inner = [(i - 0.3175) / (points + 0.365) for i in range(2, points)]
    return [(p, NormalDist().inv_cdf(p)) for p in [1 - last, *inner, last]]


def qq_normal(df: DataFrame, name: str, points: int = 99) -> DataFrame:
    """Exact sample quantiles of the whole column against normal quantiles at the same positions."""
    probs, normal = zip(*normal_positions(points))
    z = F.element_at(F.lit(np.array(normal)), F.col("pos") + 1)
    return quantiles_long(df, [name], probs).select(
        "column", F.col("pos").alias("point"), "prob", z.alias("theoretical"), F.col("value").alias("sample")
    )


def qq_fit(qq: DataFrame) -> DataFrame:
    """Least-squares line through the points of `qq_normal`, with their correlation (1 for a constant sample)."""
    return qq.groupBy("column").agg(
        F.regr_slope("sample", "theoretical").alias("slope"),
        F.regr_intercept("sample", "theoretical").alias("intercept"),
        (F.signum(F.covar_samp("sample", "theoretical")) * F.sqrt(F.regr_r2("sample", "theoretical"))).alias("r"),
    )


def high_pairs(matrix: DataFrame, threshold: float = 0.95) -> DataFrame:
    """Pairs above the diagonal whose absolute correlation exceeds the threshold, strongest first."""
    strong = matrix.filter((F.col("i") < F.col("j")) & (F.abs("r") > threshold))
    return strong.orderBy(F.desc(F.abs("r")), "i", "j")


def grid_2d(df: DataFrame, x: str, y: str, cells: int = 40, low: float = 0.02, high: float = 0.98) -> DataFrame:
    """Rows per square cell after trimming both axes on the whole data; only cells with rows."""
    slim = df.select(_number(x).alias("_x"), _number(y).alias("_y")).dropna()
    bounds = {
        r["column"]: (r["lo"], r["hi"]) for r in quantiles(slim, ["_x", "_y"], {"lo": low, "hi": high}).collect()
    }
    kept = slim.filter(F.col("_x").between(*bounds["_x"]) & F.col("_y").between(*bounds["_y"]))
    row = kept.agg(F.min("_x").alias("x0"), F.max("_x").alias("x1"), F.min("_y").alias("y0"), F.max("_y").alias("y1")).first()
    return (
        kept.groupBy(
            _bin_of(F.col("_x"), F.lit(row["x0"]), F.lit(row["x1"]), cells).alias("cell_x"),
            _bin_of(F.col("_y"), F.lit(row["y0"]), F.lit(row["y1"]), cells).alias("cell_y"),
        )
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def robust_scale(df: DataFrame, names: Sequence[str], limit: float = 5.0) -> DataFrame:
    """(x − median) / IQR clipped to ± `limit`; a column without spread is only centred."""
    stats = {r["column"]: r for r in quantiles(df, names, QUARTILES).collect()}
    out = {}
    for n in names:
        q = stats.get(n)
        if q is None:
            continue
        spread = (q["q3"] - q["q1"]) or 1.0
        scaled = (c(n).cast("double") - q["median"]) / spread
        out[n] = F.when(scaled > limit, limit).when(scaled < -limit, -limit).otherwise(scaled)
    return df.withColumns(out)


def class_ellipse(
    df: DataFrame, x: str, y: str, label: str = "Label", n_std: float = 2.0, min_rows: int = 3, draw_above: int = 50
) -> DataFrame:
    """Covariance ellipse per class: centre, axis scales, the two radii, and whether it has rows enough to draw.

    Rows with a number that is not finite are left out."""
    a, b = _number(x), _number(y)
    sums = (
        df.filter(a.isNotNull() & b.isNotNull())
        .groupBy(c(label).alias("Label"))
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.avg(a).alias("centre_x"),
            F.avg(b).alias("centre_y"),
            F.stddev_samp(a).alias("_sx"),
            F.stddev_samp(b).alias("_sy"),
            F.covar_samp(a, b).alias("_cov"),
        )
        .filter(F.col("n_rows") >= min_rows)
    )
    r = F.coalesce(F.try_divide(F.col("_cov"), F.col("_sx") * F.col("_sy")), F.lit(0.0))
    return sums.select(
        "Label",
        "n_rows",
        "centre_x",
        "centre_y",
        (F.col("_sx") * n_std).alias("scale_x"),
        (F.col("_sy") * n_std).alias("scale_y"),
        F.sqrt(F.greatest(1 + r, F.lit(0.0))).alias("radius_x"),
        F.sqrt(F.greatest(1 - r, F.lit(0.0))).alias("radius_y"),
        (F.col("n_rows") > draw_above).alias("drawn"),
    )
