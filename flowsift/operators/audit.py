"""Data-quality audit. Each report reads its input once, whatever the number of columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsift.functions.columns import c, finite, float_columns, is_infinite, numeric_columns, pct, per_column
from flowsift.operators.labels import DEFAULT, INVALID, LabelCatalogue, MISSING, VALID


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"))


def schema_table(df: DataFrame) -> DataFrame:
    rows = [(i, name, kind) for i, (name, kind) in enumerate(df.dtypes)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string")


def null_counts(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Columns holding nulls, with count and share."""
    table = per_column(
        df,
        list(names or df.columns),
        {"n_null": lambda n: F.count_if(c(n).isNull()), "n_rows": lambda n: F.count(F.lit(1))},
    )
    out = table.filter("n_null > 0").withColumn("pct_null", pct(F.col("n_null"), F.col("n_rows")))
    return out.select("column", "n_null", "pct_null").orderBy(F.desc("n_null"), "column")


def duplicates(df: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """Groups of equal rows, all rows in them, the surplus a deduplication removes, and shares."""
    keys = [c(n) for n in df.columns if n not in set(ignore)]
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).select("_n")
    many = F.col("_n") > 1
    sums = groups.agg(
        F.count_if(many).alias("duplicate_groups"),
        F.coalesce(F.sum(F.when(many, F.col("_n"))), F.lit(0)).alias("duplicate_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("surplus_rows"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
    )
    return sums.withColumn("pct_duplicate", pct(F.col("duplicate_rows"), F.col("n_rows")))


def nonfinite_counts(df: DataFrame) -> DataFrame:
    """Infinities and NaN per float column, only columns that have some."""
    table = per_column(
        df,
        float_columns(df),
        {
            "n_inf": lambda n: F.count_if(is_infinite(c(n))),
            "n_nan": lambda n: F.count_if(F.isnan(c(n))),
            "n_null": lambda n: F.count_if(c(n).isNull()),
        },
    )
    hit = table.filter("n_inf + n_nan > 0")
    return hit.orderBy(F.desc(F.col("n_inf") + F.col("n_nan")), "column")


def constant_columns(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Columns with at most one distinct value, null counting as a value.

    Decided from minimum, maximum and null count, so no distinct values are shuffled.
    """
    table = per_column(
        df,
        list(names or df.columns),
        {
            "_same": lambda n: F.min(c(n)).eqNullSafe(F.max(c(n))),
            "_nulls": lambda n: F.count_if(c(n).isNull()),
            "_rows": lambda n: F.count(F.lit(1)),
            "value": lambda n: F.min(c(n)).cast("string"),
        },
    )
    return table.filter("_same AND (_nulls = 0 OR _nulls = _rows)").select("column", "value")


def describe(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum per column, numbers by value and texts by byte order.

    All columns of numbers, texts, dates, times and booleans unless `names` are given. Numbers have `mean`, `stddev`, `min` and
    `max`, the others `first` and `last` (the smallest and largest value as text); NaN is the largest number. One pass.
    """
    kinds = dict(df.dtypes)
    names = list(names or [n for n in df.columns if not kinds[n].startswith(("array", "map", "struct", "binary", "variant"))])
    numbers = set(numeric_columns(df.select(*[c(n) for n in names])))
    number = lambda n: c(n).cast("double") if n in numbers else F.lit(None).cast("double")
    other = lambda n: F.lit(None).cast("string") if n in numbers else c(n)
    return per_column(
        df,
        names,
        {
            "n": lambda n: F.count(c(n)),
            "mean": lambda n: F.avg(number(n)),
            "stddev": lambda n: F.stddev_samp(number(n)),
            "min": lambda n: F.min(number(n)),
            "max": lambda n: F.max(number(n)),
            "first": lambda n: F.min(other(n)).cast("string"),
            "last": lambda n: F.max(other(n)).cast("string"),
        },
    )


def label_validity(df: DataFrame, label: str = "Label", catalogue: LabelCatalogue = DEFAULT) -> DataFrame:
    state = catalogue.state(c(label))
    return df.agg(
        F.count_if(state == VALID).alias("n_valid"),
        F.count_if(state == INVALID).alias("n_invalid"),
        F.count_if(state == MISSING).alias("n_missing"),
    )


def quality_by_file(
    df: DataFrame, label: str = "Label", file: str = "source_file", catalogue: LabelCatalogue = DEFAULT
) -> DataFrame:
    """Label quality per source file, worst first. Missing labels count as invalid here."""
    # fixed values: the names of the report's columns
    sums = df.groupBy(c(file).alias("source_file")).agg(
        F.count(F.lit(1)).alias("total_filas"),
        F.count_if(catalogue.is_valid(c(label))).alias("labels_validos"),
    )
    bad = F.col("total_filas") - F.col("labels_validos")
    return (
        sums.withColumn("labels_invalidos", bad)
        .withColumn("pct_corrupcion", pct(F.col("labels_invalidos"), F.col("total_filas")))
        .orderBy(F.desc("pct_corrupcion"), "source_file")
    )


def flagged_files(by_file: DataFrame, warn_pct: float = 10.0) -> DataFrame:
    """Files of `quality_by_file` with any bad label, and whether they pass the warning level."""
    return by_file.filter("pct_corrupcion > 0").withColumn("warning", F.col("pct_corrupcion") > warn_pct)


def id_columns(df: DataFrame, names: Sequence[str], approximate: bool = False) -> DataFrame:
    """Nulls and distinct values of identifier columns; names not in `df` are passed over.

    `approximate` swaps the exact distinct count, which shuffles the values, for a sketch.
    """
    present = [n for n in names if n in df.columns]
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return per_column(
        df,
        present,
        {"n_null": lambda n: F.count_if(c(n).isNull()), "n_distinct": lambda n: distinct(c(n))},
    )


def negative_counts(df: DataFrame) -> DataFrame:
    """Negative values per numeric column, only columns that have some."""
    table = per_column(df, numeric_columns(df), {"n_negative": lambda n: F.count_if(c(n) < 0)})
    return table.filter("n_negative > 0").orderBy(F.desc("n_negative"), "column")


def integrity(
    df: DataFrame,
    id_names: Sequence[str] = ("Flow ID", "Src IP", "Dst IP", "Src Port"),
    time: str = "Timestamp",
) -> DataFrame:
    """Gate after cleaning: one row per check with its violations and whether it passed."""
    numbers, floats = numeric_columns(df), float_columns(df)

    def total(parts: list[Column]) -> Column:
        return sum(parts, F.lit(0).cast("long"))

    left = [n for n in id_names if n in df.columns]
    checks = [
        ("null_numbers", total([F.count_if(c(n).isNull()) for n in numbers])),
        ("infinite_values", total([F.count_if(is_infinite(c(n))) for n in floats])),
        ("negative_values", total([F.count_if(c(n) < 0) for n in numbers])),
        ("id_columns_left", F.lit(len(left)).cast("long")),
        ("time_column_lost", F.lit(0 if time in df.columns else 1).cast("long")),
    ]
    rows = F.array(*[F.struct(F.lit(k).alias("check"), v.alias("violations")) for k, v in checks])
    out = df.agg(F.count(F.lit(1)), rows.alias("_rows")).select(F.inline("_rows"))
    return out.withColumn("passed", F.col("violations") == 0)


def stage_report(stages: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Rows and columns of successive stages, with what each removed relative to the one before."""
    counted = None
    for i, (name, df) in enumerate(stages):
        row = df.agg(
            F.lit(i).alias("stage_no"),
            F.lit(name).alias("stage"),
            F.count(F.lit(1)).alias("n_rows"),
            F.lit(len(df.columns)).alias("n_columns"),
        )
        counted = row if counted is None else counted.unionByName(row)
    gathered = counted.agg(F.array_sort(F.collect_list(F.struct("stage_no", "stage", "n_rows", "n_columns"))).alias("_s"))
    before = F.when(F.col("stage_no") > 0, F.element_at("_s", F.greatest(F.col("stage_no"), F.lit(1)))["n_rows"])
    return (
        gathered.select("_s", F.inline("_s"))
        .withColumn("rows_removed", F.coalesce(before - F.col("n_rows"), F.lit(0)))
        .withColumn("pct_removed", F.coalesce(pct(F.col("rows_removed"), before), F.lit(0.0)))
        .drop("_s")
    )


def missing_pattern(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Which columns are null together: rows per null-bit string, one bit per column in order."""
    names = list(names or df.columns)
    bits = F.concat(*[F.when(c(n).isNull(), "1").otherwise("0") for n in names])
    return df.groupBy(bits.alias("pattern")).agg(F.count(F.lit(1)).alias("n_rows"))


def variance(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Sample variance per numeric column over its finite values."""
    names = list(names or numeric_columns(df))
    return per_column(df, names, {"variance": lambda n: F.var_samp(finite(c(n).cast("double")))})


def top_columns(stat: DataFrame, by: str, k: int = 10) -> DataFrame:
    """The `k` columns with the largest statistic."""
    return stat.orderBy(F.desc(by), "column").limit(k)
