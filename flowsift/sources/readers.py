"""CSV and Parquet sources."""

from __future__ import annotations

import csv
from collections import Counter
from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowsift.functions.columns import c
from flowsift.operators.classes import union_by_name
from flowsift.sources.sinks import CSV_FORM

#: A field without anything in it is a null, which the parser tells from `""` only by a mark that no text equals.
_ABSENT = {"nullValue": "\x00", "emptyValue": ""}
#: Column for the text of a record that does not fit.
_RAW = "_raw_record"
#: Cost of opening a file, so high that no partition holds splits of two files.
_NO_PACKING = str(1 << 40)


def list_csv(spark: SparkSession, folder: str, pattern: str = "*.csv") -> list[str]:
    """Sorted CSV paths of a folder; no match is an error."""
    return sorted(_found(spark, folder, pattern).inputFiles())


def _found(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """The lines of the CSV files of a folder; no file is an error."""
    try:
        lines = spark.read.option("pathGlobFilter", pattern).text(folder)
    except AnalysisException as missing:
        raise FileNotFoundError(f"cannot read {folder}") from missing
    if not lines._jdf.inputFiles():
        raise FileNotFoundError(f"no {pattern} in {folder}")
    return lines


def header_names(line: str) -> tuple[str, ...]:
    """Column names of a header line: names that repeat (case aside) get their place behind them, empty ones are named by it."""
    names = next(csv.reader([line]), [])
    seen = Counter(n.lower() for n in names)
    return tuple(f"_c{i}" if not n else f"{n}{i}" if seen[n.lower()] > 1 else n for i, n in enumerate(names))


def _layouts(spark: SparkSession, folder: str, pattern: str) -> dict[tuple[str, ...], list[str]]:
    """Files grouped by their header, from one job over the lines of all files.

    The job runs in a session of its own that gives every file partitions of its own, so the first line that is not blank is the
    first row of the partition in which the file begins, and the caller's options stay as they are.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.files.openCostInBytes", _NO_PACKING)
    own.conf.unset("spark.sql.files.maxPartitionNum")
    lines = _found(own, folder, pattern).where(F.col("value").rlike(r"\S")).select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("begin"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("row"),
    )
    first = lines.where("begin = 0 and row = 0")
    groups: dict[tuple[str, ...], list[str]] = {}
    for row in first.select("value", "path").collect():
        groups.setdefault(header_names(row["value"]), []).append(unquote(row["path"]))
    if len(groups) == 1:  # one layout needs no list of files
        return {names: [folder] for names in groups}
    return {names: sorted(paths) for names, paths in sorted(groups.items(), key=lambda g: min(g[1]))}


def _unified(groups: dict[tuple[str, ...], list[str]], declared: dict[str, T.DataType]) -> dict[str, str]:
    """Name of each column by its trimmed, case-blind key: the declared spelling, else that of the first header."""
    names = {n.strip().lower(): n for n in declared}
    for header in groups:
        for name in header:
            names.setdefault(name.strip().lower(), name.strip())
    return names


def read_csv(
    spark: SparkSession,
    folder: str,
    types: dict[str, T.DataType] | T.StructType,
    pattern: str = "*.csv",
    same_layout: bool = False,
    source_file: str = "source_file",
    multi_line: bool = False,
) -> DataFrame:
    """All CSV files of a folder with declared types, tagged with the file they come from.

    `types` gives the type of each column by name; unnamed columns are text. Headers that differ only in case or in blanks
    around a name are one column. A value that does not fit becomes null (`misfits` counts them), as does a column a file
    lacks. Files with equal headers share one scan. `same_layout` skips the look at the headers and takes `types`, then a full
    schema, as the layout of every file.

    `multi_line` allows line breaks inside quotes; a file is then read by one task. Without it a record that such a break cuts in two
    is an error as soon as `source_file` is computed, and never two wrong rows.
    """
    declared = {f.name: f.dataType for f in types.fields} if isinstance(types, T.StructType) else dict(types)
    if same_layout:
        _found(spark, folder, pattern)
        groups = {tuple(declared): [folder]}
    else:
        groups = _layouts(spark, folder, pattern)
    names = _unified(groups, declared)
    kinds = {n.strip().lower(): t for n, t in declared.items()}
    frames = []
    for header, members in groups.items():
        fields = [T.StructField(n, kinds.get(n.strip().lower(), T.StringType())) for n in header]
        fields += [] if multi_line else [T.StructField(_RAW, T.StringType())]
        reader = spark.read.schema(T.StructType(fields)).options(
            header=True, mode="PERMISSIVE", pathGlobFilter=pattern, multiLine=multi_line, columnNameOfCorruptRecord=_RAW, **_ABSENT, **CSV_FORM
        )
        frame = reader.csv(members)
        columns = [c(n).alias(names[n.strip().lower()]) for n in header]
        file = F.col("_metadata.file_name")
        if not multi_line:
            # a record in which a quote stays open has odd quotes; only records that do not fit the schema are looked at
            open_quote = F.pmod(F.length(F.regexp_replace(_RAW, '[^"]', "")), F.lit(2)) == 1
            # the reader wants a column of the file beside the raw text
            open_quote &= F.coalesce(F.length(c(header[0]).cast("string")), F.lit(0)) >= 0
            cut = F.raise_error(F.concat(F.lit("a line break inside quotes, read with multi_line: "), file))
            file = F.when(F.col(_RAW).isNotNull() & open_quote, cut.cast("string")).otherwise(file)
        frames.append(frame.select(*columns, file.alias(source_file)))
    return union_by_name(frames)


def infer_types(text: DataFrame, exclude: Iterable[str] = ()) -> dict[str, T.DataType]:
    """The narrowest of bigint, double and text that every value of each text column fits, from one pass over all rows.

    A column without values stays text. Meant for the result of `read_csv` without types; read again with what it gives.
    """
    names = [n for n in text.columns if n not in set(exclude)]
    counts = [F.struct(*[F.count(x).alias(k) for k, x in _as_numbers(n).items()]).alias(f"_{i}") for i, n in enumerate(names)]
    row = text.agg(*counts).first() if names else []
    kinds = {}
    for name, r in zip(names, row):
        kinds[name] = T.StringType() if not r["text"] or r["double"] < r["text"] else T.DoubleType() if r["bigint"] < r["text"] else T.LongType()
    return kinds


def _as_numbers(name: str) -> dict:
    value = F.nullif(F.trim(c(name).cast("string")), F.lit(""))
    return {"text": value, "double": value.try_cast("double"), "bigint": value.try_cast("bigint")}


def misfits(text: DataFrame, types: dict[str, T.DataType]) -> DataFrame:
    """Per column of `types`: values, and those among them that do not fit the type and would be read as null."""
    kinds = {n: t for n, t in types.items() if n in text.columns}
    rows = [
        F.struct(
            F.lit(n).alias("column"),
            F.count(c(n)).alias("n_values"),
            F.count_if(c(n).isNotNull() & F.trim(c(n)).try_cast(t).isNull()).alias("n_misfits"),
        )
        for n, t in kinds.items()
    ]
    if not rows:
        return text.sparkSession.createDataFrame([], "column string, n_values long, n_misfits long")
    return text.agg(F.array(*rows).alias("_r")).select(F.inline("_r"))


def rows_per_file(df: DataFrame, source_file: str = "source_file") -> DataFrame:
    return df.groupBy(c(source_file).alias("source_file")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns")
    )


def read_parquet(spark: SparkSession, path: str, columns: Iterable[str] = ()) -> DataFrame:
    frame = spark.read.parquet(path)
    wanted = list(columns)
    return frame.select(*[c(n) for n in wanted]) if wanted else frame


def read_metrics(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def footprint(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Files and megabytes below a path; only file lengths are read, not their content."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(path)
        .select("length")
    )
    size = F.coalesce(F.sum("length"), F.lit(0)) / 1048576.0
    return files.agg(
        F.count(F.lit(1)).alias("n_files"), size.alias("size_mb"), (size / 1024.0).alias("size_gb")
    )
