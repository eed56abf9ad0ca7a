"""Merkle manifest of a table: a tree per group over its ordered rows, a tree over the groups, and a proof for every row.

Rows are ranked by one range sort; a rank's base-3 digits are its way down the tree. Within blocks of `3 ** BLOCK_LEVELS`
neighbours the digit columns are grouped away one after another, the smallest first, and every grouping nests the structs of the
one before as children. All of these groupings hold within the partitioning by block, so a block is shuffled once. The digests of
blocks are the leaves of the next tree of blocks, until one is left per group. On the way down a block is brought together
with the path above it by grouping, and nested transforms and an explode emit the proofs of its rows; no row is ever joined
with its siblings. A block is all that a task holds of a group, however many rows the group has.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsift.session import materialize

ARITY = 3
#: Levels of the tree in a block: 729 rows.
BLOCK_LEVELS = 6
#: Rows of digests in a task of the range sort.
TASK_ROWS = 100_000


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts one after another."""
    return F.sha2(F.concat(*parts), 256)


def row_digest(*columns: Column) -> Column:
    """Digest of a row: each value as byte count, colon and text, a null as a dash."""
    texts = [c.cast("string") for c in columns]
    return digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def _same(a: DataFrame, b: DataFrame, *names: str) -> Column:
    return reduce(lambda x, y: x & y, [a[n].eqNullSafe(b[n]) for n in names])


def _ranked(rows: DataFrame) -> tuple[DataFrame, int]:
    """`rows` (`g`, `k`, `digest`, ...) with `rank` by `k` within `g`, from 0, and `total`, the rows of `g`; the largest total.

    Equal keys are ranked by digest; what is then still equal is the same row again.
    """
    rows = materialize(rows.withColumn("spread", F.monotonically_increasing_id()), "leaves")
    extent = rows.groupBy("g").count().agg(F.sum("count"), F.max("count")).first()
    tasks = max(1, -(-(extent[0] or 0) // TASK_ROWS))
    keys = ["g", "k", "digest", "spread"]
    placed = rows.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys).drop("spread")
    placed = placed.withColumns({"at": F.monotonically_increasing_id(), "task": F.spark_partition_id()})
    placed = materialize(placed, "placed")
    extents = placed.groupBy("g", "task").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    of_group = Window.partitionBy("g")
    before = F.sum("n").over(of_group.orderBy("task").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    extents = extents.select("g", "task", (before - F.col("first")).alias("shift"), F.sum("n").over(of_group).alias("total"))
    joined = placed.join(extents, _same(placed, extents, "g", "task")).drop(extents["g"], extents["task"])
    return joined.withColumn("rank", F.col("at") + F.col("shift")).drop("at", "task", "shift"), extent[1] or 0


def _levels_of(total: Column) -> Column:
    """Levels of a tree over `total` rows: 0 for one row, 1 for up to 3."""
    steps = [F.when(total > F.lit(ARITY**i), 1).otherwise(0) for i in range(39)]
    return reduce(lambda a, b: a + b, steps)


def _blocks(nodes: DataFrame) -> DataFrame:
    """One row per block of `nodes` (`g`, `rank`, `levels` that are left above them, `digest`, `item`): its digest and nested rows."""
    digits = [f"d{i}" for i in range(BLOCK_LEVELS)]
    place = {d: (F.floor(F.col("rank") / F.lit(ARITY**i)) % ARITY).cast("int") for i, d in enumerate(digits)}
    block = F.expr(f"rank div {ARITY**BLOCK_LEVELS}")
    df = nodes.withColumns({**place, "block": block}).withColumnRenamed("item", "inner").drop("rank").repartition("g", "block")
    for i, d in enumerate(digits):
        kids = F.sort_array(F.collect_list(F.struct(F.col(d).alias("d"), "digest", "inner")))
        df = df.groupBy("g", "block", "levels", *digits[i + 1 :]).agg(kids.alias("inner"))
        joined = digest(F.array_join(F.transform("inner", lambda x: x["digest"]), ""))
        df = df.withColumn("digest", F.when(F.lit(i) < F.col("levels"), joined).otherwise(F.col("inner")[0]["digest"]))
    return df


def _emit(kids: Column, level: int) -> Column:
    """The rows nested in `kids`, each with its siblings on the way up from it."""

    def one(x: Column, at: Column) -> Column:
        side = lambda keep: F.concat(
            *[F.when(keep(F.lit(j)), F.coalesce(F.get(kids, F.lit(j))["digest"], F.lit(""))).otherwise("") for j in range(ARITY)]
        )
        step = F.array(F.struct(side(lambda j: j < at).alias("left"), side(lambda j: j > at).alias("right")))
        if level == 0:
            return F.array(F.struct(x["inner"].alias("item"), x["digest"].alias("digest"), step.alias("path")))
        # the levels above the root of a short tree have one node each and are no part of it
        more = F.when(F.lit(level) < F.col("levels"), step).otherwise(F.slice(step, 1, 0))
        return F.transform(
            _emit(x["inner"], level - 1),
            lambda y: F.struct(y["item"].alias("item"), y["digest"].alias("digest"), F.concat(y["path"], more).alias("path")),
        )

    return F.flatten(F.transform(kids, one))


def _descend(blocks: DataFrame, heads: DataFrame) -> DataFrame:
    """Rows of `blocks` (`g`, `item`, `digest`, `path`, `top`), given the path above each block (`g`, `block`, `path`, `top`)."""
    body = blocks.select("g", "block", F.struct("levels", "inner").alias("body"))
    sides = body.unionByName(heads.select("g", "block", F.struct("path", "top").alias("head")), allowMissingColumns=True)
    met = sides.groupBy("g", "block").agg(F.first("body", True).alias("body"), F.first("head", True).alias("head"))
    met = met.select("g", "head", F.col("body.levels").alias("levels"), F.col("body.inner").alias("inner"))
    row = F.explode(_emit(F.col("inner"), BLOCK_LEVELS - 1)).alias("row")
    found = met.select("g", "head", "levels", row)
    path = F.when(F.col("levels") > 0, F.concat("row.path", "head.path")).otherwise(F.col("head.path"))
    return found.select("g", "row.item", "row.digest", path.alias("path"), "head.top")


class _Forest:
    """Trees over ranked rows, level tables written one after another: `roots` (`g`, `digest`), and `proofs` on the way down."""

    def __init__(self, rows: DataFrame):
        ranked, longest = _ranked(rows)
        nodes = ranked.select("g", "rank", _levels_of(F.col("total")).alias("levels"), "digest", "item")
        self.tables = [materialize(_blocks(nodes), "blocks")]
        while longest > ARITY**BLOCK_LEVELS:
            longest = -(-longest // ARITY**BLOCK_LEVELS)
            left = F.greatest(F.col("levels") - BLOCK_LEVELS, F.lit(0)).alias("levels")
            nodes = self.tables[-1].select("g", F.col("block").alias("rank"), left, "digest", F.col("block").alias("item"))
            self.tables.append(materialize(_blocks(nodes), "blocks"))
        self.roots = self.tables[-1].select("g", "digest")

    def proofs(self, heads: DataFrame) -> DataFrame:
        """`g`, `item`, `digest`, `path`, `top` of all rows; `heads` has `path` and `top` of each tree's root."""
        found = heads.withColumn("block", F.lit(0).cast("long"))
        for table in reversed(self.tables):
            found = _descend(table, found).withColumn("block", F.col("item"))
        return found.drop("block")


def merkle_manifest(rows: DataFrame, order_col: str, group_col: str, leaf: Column, claim: Column | None = None) -> DataFrame:
    """One row per row: `order_col`, `group_col`, `leaf`, `claim`, `subroot`, `root`, `path`, `proof_sha256`, `folded_root`, `verified`.

    `leaf` is the digest of a row (never null), `claim` the digest that is to be verified (the leaf itself if not given). Leaves
    of a group stand by `order_col` (null first); while more than one node is left, each run of three becomes the digest of the
    three, a shorter last run likewise. The roots of the groups, by `group_col` (null first), make the last tree in the same
    way. `path` holds the siblings of a row per level, left and right; `folded_root` is what `claim` folds to along it.

    Rows that repeat a key stand by their digest; equal rows have equal digests, so their order does not matter. Rows with a null
    key or group are rows like any other. Other columns are not read. An empty table gives an empty result.
    """
    item = F.struct(F.col("k"), F.coalesce("claim", "digest").alias("claim"))
    claimed = (claim if claim is not None else F.lit(None)).cast("string")
    leaves = rows.select(F.col(group_col).alias("g"), F.col(order_col).alias("k"), leaf.alias("digest"), claimed.alias("claim"))
    trees = _Forest(leaves.select("g", "k", "digest", item.alias("item")))
    top = _Forest(trees.roots.select(F.lit(0).alias("g"), F.col("g").alias("k"), "digest", F.col("g").alias("item")))
    no_path = F.expr("CAST(array() AS array<struct<left:string,right:string>>)")
    root = top.proofs(top.roots.select("g", no_path.alias("path"), F.struct(F.col("digest").alias("root")).alias("top")))
    known = root.select(F.col("item").alias("g"), "path", F.struct(F.col("digest").alias("subroot"), "top.root").alias("top"))
    found = trees.proofs(materialize(known, "subroots"))
    proof = F.sha2(F.array_join(F.transform("path", lambda p: F.concat(p["left"], p["right"])), ""), 256)
    folded = F.aggregate("path", F.col("item.claim"), lambda acc, p: F.sha2(F.concat(p["left"], acc, p["right"]), 256))
    return found.select(
        F.col("item.k").alias(order_col),
        F.col("g").alias(group_col),
        F.col("digest").alias("leaf"),
        F.col("item.claim").alias("claim"),
        "top.subroot",
        "top.root",
        "path",
        proof.alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
