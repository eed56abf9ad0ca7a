"""Bronze, silver and gold tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowsift.functions.columns import numeric_columns, pct, rename_like
from flowsift.operators import clean, features, labels, temporal
from flowsift.operators.labels import DEFAULT, LabelCatalogue
from flowsift.session import materialize
from flowsift.sources.readers import read_csv
from flowsift.sources.sinks import write_parquet


def labelled(raw: DataFrame, catalogue: LabelCatalogue = DEFAULT) -> DataFrame:
    """Raw flows with the label column under its name and repaired; raw label and repair step kept."""
    return raw.transform(rename_like, "Label").transform(labels.normalize, "Label", catalogue)


def to_bronze(flows: DataFrame, catalogue: LabelCatalogue = DEFAULT) -> DataFrame:
    """Rows of `labelled` with a valid label, without the columns only the audit needs."""
    return labels.keep_valid(flows, "Label", catalogue).drop("Label_raw", "repair_step", "source_file")


def ingest(
    spark: SparkSession,
    folder: str,
    path: str,
    types: dict[str, T.DataType],
    catalogue: LabelCatalogue = DEFAULT,
    multi_line: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """CSV folder to a bronze table partitioned by class. Returns the labelled flows for the audit, and bronze.

    The labelled rows are written once; both the audit and bronze read them, and the CSV files are parsed a single time.
    Texts with line breaks need `multi_line`; without it they are an error.
    """
    flows = materialize(labelled(read_csv(spark, folder, types, multi_line=multi_line), catalogue), "labelled")
    return flows, write_parquet(to_bronze(flows, catalogue), path, ["Label"])


def silver_stages(bronze: DataFrame, ids: Sequence[str] = clean.ID_COLUMNS) -> list[tuple[str, DataFrame]]:
    """Every stage of the cleaning in its fixed order, for the stage report."""
    stages = [("bronze", bronze)]
    steps = (
        ("drop_ids", lambda d: clean.drop_ids(d, ids)),
        ("deduplicate", clean.deduplicate),
        ("finite_rows", clean.finite_rows),
        ("valid_times", clean.drop_bad_times),
        ("clip_negatives", clean.clip_negatives),
        ("drop_constant", clean.drop_constant),
    )
    for name, step in steps:
        stages.append((name, stages[-1][1].transform(step)))
    return stages


def to_silver(bronze: DataFrame, ids: Sequence[str] = clean.ID_COLUMNS) -> DataFrame:
    """All stages. Copies of a row change no minimum or maximum, so the constant columns are found without
    deduplicating first: the look costs one scan and the rows are shuffled once."""
    slim = clean.drop_ids(bronze, ids)

    def rows(df: DataFrame) -> DataFrame:
        return df.transform(clean.finite_rows).transform(clean.drop_bad_times)

    constant = clean.find_constant(clean.clip_negatives(rows(slim)))
    return clean.clip_negatives(rows(clean.deduplicate(slim))).drop(*constant)


def silver_report(bronze: DataFrame, ids: Sequence[str] = clean.ID_COLUMNS) -> DataFrame:
    """Rows and columns after each stage as in `audit.stage_report`, but counted together.

    Deduplication is the only stage with a shuffle and runs once; the filters after it become conditional counts.
    """
    slim = clean.drop_ids(bronze, ids)
    finite = clean.floats_present(slim)
    timely = finite & temporal.valid_time(F.col("Timestamp")) if "Timestamp" in slim.columns else finite
    all_rows = bronze.agg(F.count(F.lit(1))).scalar()
    counts = clean.deduplicate(slim).agg(
        F.count(F.lit(1)).alias("_unique"), F.count_if(finite).alias("_finite"), F.count_if(timely).alias("_timely")
    )
    width = len(slim.columns)
    left = width - len(clean.find_constant(clean.clip_negatives(slim.filter(timely))))
    rows = [
        ("bronze", all_rows, all_rows, len(bronze.columns)),
        ("drop_ids", all_rows, all_rows, width),
        ("deduplicate", all_rows, F.col("_unique"), width),
        ("finite_rows", F.col("_unique"), F.col("_finite"), width),
        ("valid_times", F.col("_finite"), F.col("_timely"), width),
        ("clip_negatives", F.col("_timely"), F.col("_timely"), width),
        ("drop_constant", F.col("_timely"), F.col("_timely"), left),
    ]
    cells = [
        F.struct(
            F.lit(i).alias("stage_no"),
            F.lit(name).alias("stage"),
            after.alias("n_rows"),
            F.lit(columns).alias("n_columns"),
            (before - after).alias("rows_removed"),
            F.coalesce(pct(before - after, before), F.lit(0.0)).alias("pct_removed"),
        )
        for i, (name, before, after, columns) in enumerate(rows)
    ]
    return counts.select(F.inline(F.array(*cells)))


def to_gold(silver: DataFrame, threshold: float = features.CORRELATION_LIMIT, stored: bool = False) -> tuple[DataFrame, list[str]]:
    """Time parts, class number, correlated features dropped. Returns the table and the features kept.

    Silver is read for the class counts, the correlations and the result, so it is written first unless `stored` says that it
    is a table already; its deduplication then runs once.
    """
    silver = silver if stored else materialize(silver, "silver")
    timed = temporal.add_time_parts(silver) if "Timestamp" in silver.columns else silver
    indexed = features.label_index(timed)
    names = numeric_columns(indexed, exclude=["label_index"])
    kept = features.prune_correlated(indexed, names, threshold)
    return features.gold(indexed, kept), kept
