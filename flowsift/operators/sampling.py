"""Samples, splits and class balance driven by a uniform number per row.

All operators take that number as a column `u` (see `flowsift.functions.hashing`), so the same rows come back
whatever the partition layout, and a retried task draws the same rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsift.functions.columns import c, join_on, lookup_side
from flowsift.operators.classes import class_counts

#: Copies of one row written by one task before they are spread over tasks.
COPIES_PER_TASK = 1_000
#: Sampled rows (per group) that a task keeps itself; larger samples are drawn by counts.
SUMMARY_ROWS = 200_000
#: Tasks that merge the kept rows of one group before the last one does.
MERGE_TASKS = 32


def sample_fraction(df: DataFrame, fraction: float, u: Column) -> DataFrame:
    """Each row with probability `fraction`; a filter, no shuffle."""
    return df.filter(u < fraction)


def fraction_for(df: DataFrame, rows: int) -> float:
    """Fraction that keeps about `rows` rows."""
    total = df.count()
    return min(rows, total) / total if total else 0.0


def lowest_per_group(
    df: DataFrame, n: int, u: Column, by: Sequence[str] = (), tie: Sequence[str] = (), cells: int | None = None
) -> DataFrame:
    """The `n` rows with the smallest `u`, per group if `by` is given.

    For samples that a task can hold, one scan: every task keeps the first `n` rows of each of its groups, the tasks' rows are
    merged in two steps, and a group with a third of the table still sends no more than `n` rows a task. Larger samples, and
    those with `cells`, first count rows per cell of `u`, so that only rows up to the last cell needed are sorted at all.
    """
    if cells or n > SUMMARY_ROWS:
        return _lowest_by_cells(df, n, u, by, tie, cells or 65_536)
    keys = [c(b) for b in by]
    order = [F.col("_u"), *[c(t) for t in tie]]
    marked = df.withColumns({"_u": u, "_task": F.pmod(F.spark_partition_id(), F.lit(MERGE_TASKS))})
    for within in ([*keys, F.col("_task")], keys):
        if within:
            place = F.row_number().over(Window.partitionBy(*within).orderBy(*order))
            marked = marked.withColumn("_rank", place).filter(F.col("_rank") <= n).drop("_rank")
        else:
            marked = marked.orderBy(*order).limit(n)
    return marked.drop("_u", "_task")


def _lowest_by_cells(df: DataFrame, n: int, u: Column, by: Sequence[str], tie: Sequence[str], cells: int) -> DataFrame:
    """A count per cell of `u` tells up to which cell rows can be among the first `n`; a second scan sorts only those."""
    keys = [c(b) for b in by]
    marked = df.withColumn("_u", u).withColumn("_cell", F.floor(F.col("_u") * cells))
    counts = marked.groupBy(*keys, "_cell").agg(F.count(F.lit(1)).alias("_m"))
    running = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = counts.withColumn("_before", F.sum("_m").over(running) - F.col("_m")).filter(F.col("_before") < n)
    last = reached.groupBy(*keys).agg(F.max("_cell").alias("_last"))
    order = [F.col("_u"), *[c(t) for t in tie]]
    if not by:
        row = last.first()
        kept = marked.filter(F.col("_cell") <= (row["_last"] if row and row["_last"] is not None else -1))
        return kept.orderBy(*order).limit(n).drop("_u", "_cell")
    kept = join_on(marked, lookup_side(last), by).filter(F.col("_cell") <= F.col("_last"))
    ranked = kept.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") <= n).drop("_u", "_cell", "_last", "_rank")


def sample_rows(df: DataFrame, n: int, u: Column, tie: Sequence[str] = ()) -> DataFrame:
    """Exactly min(`n`, rows) rows."""
    return lowest_per_group(df, n, u, tie=tie)


def sample_per_class(df: DataFrame, n: int, u: Column, label: str = "Label", tie: Sequence[str] = ()) -> DataFrame:
    """Exactly min(`n`, class size) rows of each class."""
    return lowest_per_group(df, n, u, by=[label], tie=tie)


def sample_equal_shares(df: DataFrame, total: int, classes: Sequence[str], u: Column, label: str = "Label", tie=()):
    """`total` rows in equal shares over the given classes."""
    kept = df.filter(c(label).isin(list(classes)))
    return sample_per_class(kept, total // len(classes), u, label, tie)


def mark_split(
    df: DataFrame, u: Column, label: str = "Label", train: float | Mapping[str, float] = 0.8, target: str = "side"
) -> DataFrame:
    """Column `side` = train or test. One fraction for all classes, or one per class (0 where none is named).

    Both sides are filters on the same number, so they are disjoint and complete without a join.
    """
    if isinstance(train, Mapping):
        share = F.lit(0.0)
        for name, fraction in train.items():
            share = F.when(c(label) == F.lit(name), F.lit(float(fraction))).otherwise(share)
    else:
        share = F.lit(float(train))
    return df.withColumn(target, F.when(u < share, "train").otherwise("test"))


def split(df: DataFrame, u: Column, label: str = "Label", train: float | Mapping[str, float] = 0.8):
    """Train and test frames of `mark_split`."""
    marked = mark_split(df, u, label, train, "_side")
    return tuple(marked.filter(F.col("_side") == s).drop("_side") for s in ("train", "test"))


def mark_parts(df: DataFrame, weights: Sequence[float], u: Column, target: str = "part") -> DataFrame:
    """Number of the part each row falls into, parts sized by `weights`."""
    total, edge, part = float(sum(weights)), 0.0, F.lit(len(weights) - 1)
    edges = []
    for w in weights[:-1]:
        edge += w / total
        edges.append(edge)
    for i in reversed(range(len(edges))):
        part = F.when(u < edges[i], i).otherwise(part)
    return df.withColumn(target, part)


def class_ratios(df: DataFrame, label: str = "Label", target: int | None = None) -> DataFrame:
    """Rows per class, the common target (whole median of the class sizes unless given) and target / rows."""
    counts = lookup_side(df.groupBy(c(label).alias("Label")).agg(F.count(F.lit(1)).alias("n_rows")))
    if target is None:
        sizes = counts.groupBy("n_rows").agg(F.count(F.lit(1)).alias("_m"))
        target = int(sizes.agg(F.percentile("n_rows", F.lit(0.5), F.col("_m"))).first()[0] or 0)
    goal = F.lit(target).cast("long")
    return counts.withColumn("target", goal).withColumn("ratio", F.lit(float(target)) / F.col("n_rows"))


def balance(df: DataFrame, u: Column, label: str = "Label", target: int | None = None, copy: str = "copy") -> DataFrame:
    """Bring every class close to the same size in one pass.

    With r = target / class size a row comes back floor(r) times, and once more if `u` falls below the rest of r:
    large classes are thinned, small ones repeated. `copy` numbers the copies from 1. Rows to be repeated more
    than a thousand times are first spread over tasks, so a tiny class does not grow inside one task.
    """
    ratios = class_ratios(df, label, target)
    extreme = ratios.agg(F.max("ratio")).first()[0] or 0.0
    side = ratios.select(F.col("Label").alias(label), F.col("ratio").alias("_r"))
    whole = F.floor("_r")
    joined = join_on(df.withColumn("_u", u), side, [label])
    counted = joined.withColumn(
        "_copies", whole + F.when(F.col("_u") < F.col("_r") - whole, 1).otherwise(0)
    ).filter(F.col("_copies") > 0)

    def repeat(rows: DataFrame) -> DataFrame:
        return rows.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))

    if extreme <= COPIES_PER_TASK:
        return repeat(counted).drop("_u", "_r", "_copies")
    few = repeat(counted.filter(F.col("_r") <= COPIES_PER_TASK))
    last_block = F.floor((F.col("_copies") - 1) / COPIES_PER_TASK)
    blocks = counted.filter(F.col("_r") > COPIES_PER_TASK).withColumn(
        "_block", F.explode(F.sequence(F.lit(0).cast("long"), last_block))
    )
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    start = F.col("_block") * COPIES_PER_TASK
    many = (
        blocks.repartition(tasks, "_u", "_block")
        .withColumn(copy, F.explode(F.sequence(start + 1, F.least(start + COPIES_PER_TASK, F.col("_copies")))))
        .drop("_block")
    )
    return few.unionByName(many).drop("_u", "_r", "_copies")


def balance_report(df: DataFrame, balanced: DataFrame, label: str = "Label") -> DataFrame:
    """Rows per class before and after."""
    before = class_counts(df, label).withColumnRenamed("n_rows", "rows_before")
    after = class_counts(balanced, label).withColumnRenamed("n_rows", "rows_after")
    return join_on(before, after, ["Label"], "left").fillna(0, subset=["rows_after"])
