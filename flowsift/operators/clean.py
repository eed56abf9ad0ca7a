"""Cleaning steps, each a projection or filter except deduplication."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsift.functions.columns import c, finite, float_columns, numeric_columns
from flowsift.operators.temporal import valid_time

# Identifier columns of the flow tables.
ID_COLUMNS = ("Flow ID", "Src IP", "Dst IP", "Src Port")


def drop_ids(df: DataFrame, names: Sequence[str] = ID_COLUMNS) -> DataFrame:
    return df.drop(*names)


def deduplicate(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """One row per set of equal rows; copies collapse before the shuffle, so a hot row costs nothing."""
    return df.dropDuplicates(list(names)) if names else df.dropDuplicates()


def nonfinite_to_null(df: DataFrame) -> DataFrame:
    return df.withColumns({n: finite(c(n)) for n in float_columns(df)})


def floats_present(df: DataFrame) -> Column:
    """True where no float column is null, NaN or infinite."""
    tests = [finite(c(n)).isNotNull() for n in float_columns(df)]
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def drop_null_floats(df: DataFrame) -> DataFrame:
    """Rows with a null or NaN in a float column go; nulls in whole-number columns stay."""
    return reduce(lambda d, n: d.filter(c(n).isNotNull() & ~F.isnan(c(n))), float_columns(df), df)


def drop_bad_times(df: DataFrame, time: str = "Timestamp", first_year: int = 2000) -> DataFrame:
    return df.filter(valid_time(c(time), first_year)) if time in df.columns else df


def clip_negatives(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Negative numbers become 0; null stays null."""
    return df.withColumns(
        {n: F.when(c(n) < 0, F.lit(0).cast(df.schema[n].dataType)).otherwise(c(n)) for n in numeric_columns(df, exclude)}
    )


def find_constant(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric columns with equal, non-null minimum and maximum (nulls are not looked at)."""
    names = numeric_columns(df, exclude)
    if not names:
        return []
    row = df.agg(*[(F.min(c(n)) == F.max(c(n))).alias(f"_{i}") for i, n in enumerate(names)]).first()
    return [n for i, n in enumerate(names) if row[f"_{i}"]]


def drop_constant(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    return df.drop(*find_constant(df, exclude))


def finite_rows(df: DataFrame) -> DataFrame:
    """Non-finite floats to null, then rows with a null float dropped."""
    return df.transform(nonfinite_to_null).transform(drop_null_floats)
