"""Name → Spark query and, where SQL can say it, the DuckDB twin."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsift.functions.columns import c


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a function (spark, folder of the tables) → DataFrame under `name`."""

    def add(run):
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Query(run, sql)
        return run

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    """Round double results, so that two engines that add in different order agree."""
    return df.withColumns({n: F.round(c(n), digits) for n in names})


def renamed(df: DataFrame, names: Sequence[tuple[str, str]]) -> DataFrame:
    return df.select(*[c(old).alias(new) for old, new in names])
