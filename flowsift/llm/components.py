"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsift.session import current_scope, materialize, temporary_tables


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node ties its larger neighbours to the smallest node it knows."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node ties itself and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = materialize(down.groupBy("u").agg(F.min("v").alias("m")), "least")
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def star_components(links: DataFrame, left: str, right: str) -> DataFrame:
    """Component of every node of `links`: columns `node` and `component` (the smallest node reachable).

    Links may repeat, run either way and hold loops or nulls (both ignored). Minima are combined before every shuffle and
    written, so that both sides of a join are plain shuffles and adaptive execution can split a hub with very many links. Every
    round is written to the shared folder and the tables before it are deleted; the number of rounds grows with the logarithm
    of the longest path. No links give an empty table.
    """
    edges = (
        links.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
        .where(F.col(left).isNotNull() & F.col(right).isNotNull())
        .where("u <> v")
        .distinct()
    )
    spark = links.sparkSession
    with temporary_tables(spark) as round_scope:
        edges = round_scope.keep(materialize(edges, "links"))
    mark = None
    while True:
        with temporary_tables(spark) as round_scope:
            stars = materialize(_large_star(edges), "large")
            found = round_scope.keep(materialize(_small_star(stars), "small"))
        current_scope(spark).drop(edges)
        edges = found
        now = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.expr("sum(cast(xxhash64(v, u) as decimal(38)))")).first()
        if now == mark or not now[0]:
            break
        mark = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
