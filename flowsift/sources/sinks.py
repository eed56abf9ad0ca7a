"""Parquet, CSV and JSON sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsift.functions.columns import c

#: How both sides write and read CSV.
CSV_FORM = {
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> DataFrame:
    """Write and read back lazily.

    With `partition_by` the rows are rebalanced by those columns first: small partitions are merged into few
    files, and a class with a large share of the rows is split over several tasks instead of one.
    """
    out = df.hint("rebalance", *[c(p) for p in partition_by]) if partition_by else df
    writer = out.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def write_report(df: DataFrame, path: str) -> str:
    """One CSV file with header. For reports, which are small by construction; never for rows of a table."""
    return write_csv(df.repartition(1), path)


def write_csv(df: DataFrame, path: str) -> str:
    """CSV with header that `read_csv` with `multi_line` reads back value by value: blanks kept, quotes doubled, and an empty text
    (written as `""`) told from a null (written as nothing)."""
    df.write.mode("overwrite").options(header=True, nullValue="", emptyValue='""', **CSV_FORM).csv(path)
    return path


def write_metrics(df: DataFrame, path: str) -> str:
    df.repartition(1).write.mode("overwrite").json(path)
    return path


def verify_written(df: DataFrame, path: str) -> DataFrame:
    """Rows and columns of `df` against what lies at `path`."""
    back = df.sparkSession.read.parquet(path)
    found = back.agg(F.count(F.lit(1))).scalar()
    counts = df.agg(F.count(F.lit(1)).alias("rows_expected"))
    out = counts.select(
        "rows_expected",
        found.alias("rows_found"),
        F.lit(len(df.columns)).alias("columns_expected"),
        F.lit(len(back.columns)).alias("columns_found"),
        F.lit(sorted(df.columns) == sorted(back.columns)).alias("_same"),
    )
    return out.withColumn("passed", (F.col("rows_expected") == F.col("rows_found")) & F.col("_same")).drop("_same")
