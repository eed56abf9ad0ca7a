"""Exact quantiles of large columns.

The built-in exact `percentile` holds every distinct value of a group in one task. Here a mergeable sketch first
brackets each wanted rank, then one pass counts the rows between the brackets and keeps single values only inside
them. What is sorted in the end is a tiny share of the column, and the answer is still exact: a rank that its bracket misses is
looked for again in a wider one.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsift.functions.columns import c, fetch_small, join_on
from flowsift.session import materialize

#: Sketch accuracies; the finer one is used for columns too long for the first.
COARSE, FINE = 10_000, 200_000
_FINE_FROM_ROWS = 10_000_000_000
#: Half the width of a bracket, in errors of the sketch; a missed rank is looked for with `WIDER` times as much.
MARGIN, WIDER = 2.0, 64.0
#: Up to so many quantiles the bracket edges are compared one by one in generated code.
UNROLLED_PROBS = 4


def _number(name: str) -> Column:
    value = c(name).cast("double")
    return F.when(~F.isnan(value), value)


def _brackets(df: DataFrame, names: Sequence[str], probs: Sequence[float], by: Sequence[str], accuracy: int, errors: float) -> DataFrame:
    """Per group: count `_n` and bracket edges `_e` (lower ones, then upper ones) of each column.

    The sketch is off by at most n / accuracy ranks and the margin is `errors` times that. A group too short for the
    margin to hold the neighbours of a rank as well is bracketed whole.
    """
    margin, m = errors / accuracy, len(probs)
    wanted = [min(1.0, max(0.0, p - margin)) for p in probs] + [max(0.0, min(1.0, p + margin)) for p in probs]
    whole = F.array(*[F.lit(-math.inf)] * m, *[F.lit(math.inf)] * m)
    aggs = []
    for i, name in enumerate(names):
        aggs.append(F.count(_number(name)).alias(f"_n{i}"))
        aggs.append(F.approx_percentile(_number(name), wanted, accuracy).alias(f"_s{i}"))
    sketched = df.groupBy(*[c(b) for b in by]).agg(*aggs)
    bracketed = (lambda i: F.col(f"_n{i}") > 4 * accuracy) if margin < 1 else (lambda i: F.lit(False))
    edges = {f"_e{i}": F.when(bracketed(i), F.col(f"_s{i}")).otherwise(whole) for i in range(len(names))}
    return sketched.withColumns(edges).drop(*[f"_s{i}" for i in range(len(names))])


def _bisect(m: int, edges: Column, goes_on) -> Column:
    """How many of `m` rising edges, from the first on, meet `goes_on`: steps of falling powers of two."""
    steps = [2**k for k in reversed(range(m.bit_length()))]

    def move(at: Column, step: Column) -> Column:
        there = at + step
        return F.when((there <= m) & goes_on(F.get(edges, there - 1)), there).otherwise(at)

    return F.aggregate(F.lit(np.array(steps, dtype="int32")), F.lit(0), move)


def _edges_below(m: int, edges: Sequence[Column], arrays: tuple[Column, Column], value: Column) -> tuple[Column, Column]:
    """Lower edges reached and upper edges passed by a value: plain comparisons if few, bisection if many."""
    if m > UNROLLED_PROBS:
        return _bisect(m, arrays[0], lambda e: e <= value), _bisect(m, arrays[1], lambda e: e < value)
    reached = [F.when(e <= value, 1).otherwise(0) for e in edges[:m]]
    passed = [F.when(e < value, 1).otherwise(0) for e in edges[m:]]
    return reduce(lambda a, b: a + b, reached), reduce(lambda a, b: a + b, passed)


def _rank(counted: DataFrame, keys: Sequence[str], by_segment: bool) -> DataFrame:
    """Running row count `_end` up to each value and the total `_all` of its group.

    With many brackets each is summed up on its own, starting from the total of the segments before it.
    """
    group = Window.partitionBy(*[c(k) for k in keys])
    so_far = (Window.unboundedPreceding, Window.currentRow)
    if not by_segment:
        running = group.orderBy("_seg", "_key").rowsBetween(*so_far)
        return counted.withColumn("_end", F.sum("_m").over(running)).withColumn("_all", F.sum("_m").over(group))
    totals = counted.groupBy(*[c(k) for k in keys], "_seg").agg(F.sum("_m").alias("_t"))
    offsets = totals.select(
        *[c(k) for k in keys],
        "_seg",
        (F.sum("_t").over(group.orderBy("_seg").rowsBetween(*so_far)) - F.col("_t")).alias("_start"),
        F.sum("_t").over(group).alias("_all"),
    )
    inside = Window.partitionBy(*[c(k) for k in keys], "_seg").orderBy("_key").rowsBetween(*so_far)
    joined = join_on(counted, offsets, [*keys, "_seg"])
    return joined.withColumn("_end", F.col("_start") + F.sum("_m").over(inside))


def quantiles_long(
    df: DataFrame,
    names: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    accuracy: int | None = None,
) -> DataFrame:
    """Linearly interpolated quantiles, one row per group, column and entry of `probs` (`pos` is its place).

    Null and NaN are left out. Result columns: `by`, `column`, `n`, `pos`, `prob`, `value`. The two values around each rank, one row
    per result row, are written to the shared folder; those that a bracket missed are found in the next round.
    """
    order = sorted(range(len(probs)), key=lambda k: probs[k])
    ps = [float(probs[k]) for k in order]
    slim = df.select(*[c(b) for b in by], *[c(n) for n in names])
    errors, found, keys = MARGIN, None, [*by, "_i", "prob"]
    while True:
        picked = materialize(_around_ranks(slim, names, ps, by, accuracy, errors), "ranks")
        hit = picked.filter(F.col("_lo").isNotNull() & F.col("_hi").isNotNull())
        if found is not None:  # what an earlier round found stands
            there = reduce(lambda a, b: a & b, [hit[k].eqNullSafe(found[k]) for k in keys])
            hit = found.unionByName(hit.join(found, there, "left_anti"))
        missed = picked.count() - hit.count()
        found = hit
        if not missed:
            break
        errors = max(1.0, errors) * WIDER
    lo, hi, position = F.col("_lo"), F.col("_hi"), F.col("prob") * (F.col("n") - 1)
    value = F.when(lo == hi, lo).otherwise(lo + (hi - lo) * (position - F.floor(position)))
    place = F.element_at(F.lit(np.array(order, dtype="int32")), F.array_position(_doubles(ps), F.col("prob")).cast("int"))
    column = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("_i") + 1)
    return found.select(*[c(b) for b in by], column.alias("column"), "n", place.alias("pos"), "prob", value.alias("value"))


def _around_ranks(
    slim: DataFrame, names: Sequence[str], ps: Sequence[float], by: Sequence[str], accuracy: int | None, errors: float
) -> DataFrame:
    """Per group, column and rising entry of `ps`: `n`, and the values `_lo` and `_hi` around its rank, null where a bracket missed it."""
    m = len(ps)

    def too_long(counts) -> bool:
        return accuracy is None and max((n or 0 for n in counts), default=0) > _FINE_FROM_ROWS

    counts = [f"_n{i}" for i in range(len(names))]
    brackets = _brackets(slim, names, ps, by, accuracy or COARSE, errors)
    if by:
        small = fetch_small(brackets)
        if small is not None and too_long(v for n in counts for v in small.column(n).to_pylist()):
            brackets = _brackets(slim, names, ps, by, FINE, errors)
            small = fetch_small(brackets)
        side = brackets if small is None else F.broadcast(slim.sparkSession.createDataFrame(small, brackets.schema))
        joined = join_on(slim, side, by)
        unrolled = range(2 * m) if m <= UNROLLED_PROBS else ()
        edges = [[F.get(F.col(f"_e{i}"), k) for k in unrolled] for i in range(len(names))]
        arrays = [(F.slice(f"_e{i}", 1, m), F.slice(f"_e{i}", m + 1, m)) for i in range(len(names))]
    else:
        joined, row = slim, brackets.first()
        if too_long(row[n] for n in counts):
            row = _brackets(slim, names, ps, by, FINE, errors).first()
        edges = [[F.lit(v) for v in row[f"_e{i}"]] if m <= UNROLLED_PROBS else [] for i in range(len(names))]
        arrays = [tuple(_doubles(half) for half in (row[f"_e{i}"][:m], row[f"_e{i}"][m:])) for i in range(len(names))]

    # Lower and upper edges both rise: more lower edges reached than upper edges passed means inside a bracket,
    # and the sum of both orders the segments.
    cells = []
    for i, name in enumerate(names):
        value = _number(name)
        reached, passed = _edges_below(m, edges[i], arrays[i], value)
        cells.append(
            F.struct(F.lit(i).alias("_i"), value.alias("_v"), reached.alias("_reached"), passed.alias("_passed"))
        )
    counted = (
        joined.select(*[c(b) for b in by], F.inline(F.array(*cells)))
        .filter(F.col("_v").isNotNull())
        .groupBy(
            *[c(b) for b in by],
            "_i",
            (F.col("_reached") + F.col("_passed")).alias("_seg"),
            F.when(F.col("_reached") > F.col("_passed"), F.col("_v")).alias("_key"),
        )
        .agg(F.count(F.lit(1)).alias("_m"))
    )
    ranked = _rank(counted, [*by, "_i"], by_segment=m > UNROLLED_PROBS)

    # A row of `ranked` covers the ranks from _end - _m to _end - 1; keep it for the quantiles that need one of them.
    below, above = (lambda p: F.floor(p * (F.col("_all") - 1))), (lambda p: F.ceil(p * (F.col("_all") - 1)))
    first = F.col("_end") - F.col("_m")
    needed = F.filter(_doubles(ps), lambda p: (below(p) < F.col("_end")) & (above(p) >= first))
    hits = ranked.select("*", F.explode(needed).alias("prob"))
    at = F.col("prob")
    return hits.groupBy(*[c(b) for b in by], "_i", "prob").agg(
        F.max("_all").alias("n"),
        F.max(F.when((first <= below(at)) & (below(at) < F.col("_end")), F.col("_key"))).alias("_lo"),
        F.max(F.when((first <= above(at)) & (above(at) < F.col("_end")), F.col("_key"))).alias("_hi"),
    )


def _doubles(values: Sequence[float]) -> Column:
    return F.lit(np.array(values, dtype="float64"))


def quantiles(
    df: DataFrame,
    names: Sequence[str],
    probs: Mapping[str, float],
    by: Sequence[str] = (),
    accuracy: int | None = None,
) -> DataFrame:
    """`quantiles_long` with one row per group and column, and one output column per entry of `probs`."""
    distinct = sorted(set(probs.values()))
    long = quantiles_long(df, names, distinct, by, accuracy)
    wide = long.groupBy(*[c(b) for b in by], "column").agg(
        F.max("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("pos", "value"))).alias("_q")
    )
    return wide.select(*[c(b) for b in by], "column", "n", *[F.col("_q")[distinct.index(p)].alias(k) for k, p in probs.items()])


def quantile_bounds(df: DataFrame, name: str, low: float, high: float) -> tuple[float, float]:
    """Two exact quantiles as Python numbers, to be used as filter literals that reach the scan."""
    row = quantiles(df, [name], {"lo": low, "hi": high}).first()
    if row is None:
        raise ValueError(f"column {name!r} holds no value")
    return row["lo"], row["hi"]
