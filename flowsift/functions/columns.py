"""Column selection by type and name, one-pass statistics per column, bounded lookups."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FLOAT_TYPES = (T.DoubleType, T.FloatType)
NUMERIC_TYPES = (T.DoubleType, T.FloatType, T.IntegerType, T.LongType)

#: Rows and bytes a lookup side may have before it stops being collected and broadcast.
LOOKUP_MAX_ROWS = 10_000
LOOKUP_MAX_BYTES = 32 * 1024 * 1024


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def c(name: str) -> Column:
    """Column by its exact name, also with spaces, slashes or dots in it."""
    return F.col(quoted(name))


def columns_of_type(df: DataFrame, kinds: tuple, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds) and f.name not in skip]


def float_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    return columns_of_type(df, FLOAT_TYPES, exclude)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    return columns_of_type(df, NUMERIC_TYPES, exclude)


def select_numeric(df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    return df.select(*[c(n) for n in numeric_columns(df, exclude)])


def find_column(df: DataFrame, wanted: str) -> str:
    """Name in `df` that equals `wanted` up to case and blanks around it."""
    key = wanted.strip().lower()
    for name in df.columns:
        if name.strip().lower() == key:
            return name
    raise ValueError(f"no column like {wanted!r} among {df.columns}")


def rename_like(df: DataFrame, wanted: str) -> DataFrame:
    return df.withColumnRenamed(find_column(df, wanted), wanted)


def is_infinite(col: Column) -> Column:
    return col.isin(float("inf"), float("-inf"))


def is_nonfinite(col: Column) -> Column:
    return F.isnan(col) | is_infinite(col)


def finite(col: Column) -> Column:
    """NaN and infinities as null."""
    return F.when(~is_nonfinite(col), col)


def number_or_zero(col: Column) -> Column:
    """Text that is no number, null and NaN become 0."""
    return F.nanvl(F.coalesce(col.try_cast("double"), F.lit(0.0)), F.lit(0.0))


def per_column(
    df: DataFrame,
    names: Sequence[str],
    stats: dict[str, Callable[[str], Column]],
    by: Sequence[str] = (),
) -> DataFrame:
    """All `stats` of all columns in one aggregate, one output row per column (and group)."""
    if not names:
        fields = ["column string"] + [f"{s} double" for s in stats]
        return df.sparkSession.createDataFrame([], ", ".join(fields))
    rows = F.array(
        *[
            F.struct(F.lit(n).alias("column"), *[make(n).alias(alias) for alias, make in stats.items()])
            for n in names
        ]
    )
    return df.groupBy(*[c(b) for b in by]).agg(rows.alias("_rows")).select(*[c(b) for b in by], F.inline("_rows"))


def fetch_small(df: DataFrame, max_rows: int = LOOKUP_MAX_ROWS) -> pa.Table | None:
    """All rows of a small aggregate, or None if they are too many (one more than `max_rows` is fetched to tell)
    or too wide to be broadcast."""
    table = df.limit(max_rows + 1).toArrow()
    return table if table.num_rows <= max_rows and table.nbytes <= LOOKUP_MAX_BYTES else None


def lookup_side(df: DataFrame, max_rows: int = LOOKUP_MAX_ROWS) -> DataFrame:
    """Make a small aggregate ready to be joined to a big table.

    If the frame fits `max_rows`, its size is proven and it comes back as a local relation to broadcast; if not,
    the lazy frame itself comes back and Spark shuffles the join.
    """
    table = fetch_small(df, max_rows)
    return df if table is None else F.broadcast(df.sparkSession.createDataFrame(table, df.schema))


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys meet null keys; the key columns of `right` are dropped."""
    renamed = right.select(*[c(n).alias(f"_r_{n}") if n in keys else c(n) for n in right.columns])
    condition = None
    for key in keys:
        part = c(key).eqNullSafe(c(f"_r_{key}"))
        condition = part if condition is None else condition & part
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def pct(part: Column, total: Column, digits: int = 2) -> Column:
    return F.round(F.try_divide(part.cast("double"), total) * 100, digits)
