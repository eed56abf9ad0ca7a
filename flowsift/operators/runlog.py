"""Speed analysis of a log of training runs (model, threads, seconds)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsift.functions.columns import c


def speedup(
    runs: DataFrame, model: str = "model", threads: str = "n_threads", time: str = "time", base_threads: int = 8
) -> DataFrame:
    """Speedup, scale factor, efficiency and ideal speedup against the run of the model with `base_threads`."""
    base = runs.filter(c(threads) == base_threads).groupBy(c(model).alias("_m")).agg(F.max(c(time)).alias("_base"))
    joined = runs.join(base, c(model) == F.col("_m"))
    factor = c(threads) / F.lit(base_threads)
    return joined.select(
        c(model).alias("model"),
        c(threads).alias("n_threads"),
        c(time).alias("time"),
        F.try_divide(F.col("_base"), c(time)).alias("speedup"),
        factor.alias("n_factor"),
        F.round(F.try_divide(F.col("_base"), c(time)) / factor * 100, 2).alias("efficiency"),
        factor.alias("ideal_speedup"),
    )


def amdahl(speeds: DataFrame) -> DataFrame:
    """Parallel share p, serial share and greatest possible speedup, from the best run of each model.

    Models whose best run is no faster than the base are left out.
    """
    best = speeds.groupBy("model").agg(
        F.max_by(F.struct("speedup", "n_factor", "n_threads"), F.struct("speedup", -F.col("n_factor"))).alias("_b")
    )
    s, n = F.col("_b.speedup"), F.col("_b.n_factor")
    p = (1 - 1 / s) / (1 - 1 / n)
    return best.filter((s > 1) & (n > 1)).select(
        "model",
        F.col("_b.n_threads").alias("best_threads"),
        F.round(s, 4).alias("best_speedup"),
        F.round(p, 4).alias("p"),
        F.round(1 - p, 4).alias("alpha"),
        F.round(F.try_divide(F.lit(1.0), 1 - p), 2).alias("max_speedup"),
    )


def volume_ratio(runs: DataFrame, model: str = "model", volume: str = "frac", time: str = "time") -> DataFrame:
    """Time at the largest volume over time at the smallest, with the growth in volume."""
    ends = runs.groupBy(c(model).alias("model")).agg(
        F.min(c(volume)).alias("_v0"),
        F.max(c(volume)).alias("_v1"),
        F.min_by(c(time), c(volume)).alias("_t0"),
        F.max_by(c(time), c(volume)).alias("_t1"),
    )
    return ends.select(
        "model",
        F.try_divide(F.col("_v1").cast("double"), F.col("_v0")).alias("volume_growth"),
        F.try_divide(F.col("_t1"), F.col("_t0")).alias("time_growth"),
    )
