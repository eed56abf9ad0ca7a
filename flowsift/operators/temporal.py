"""Time columns that arrive as text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsift.functions.columns import c, pct

# Text formats of the capture times and of the date in a file name.
TIME_FORMAT = "dd/MM/yyyy HH:mm:ss"
FILE_DATE_FORMAT = "dd-MM-yyyy"
FILE_DATE_PATTERN = r"(\d{2}-\d{2}-\d{4})"


def parse_time(text: Column, fmt: str = TIME_FORMAT) -> Column:
    """Timestamp, or null where the text does not fit the format."""
    return F.try_to_timestamp(text, F.lit(fmt))


def parse_date(text: Column, fmt: str = TIME_FORMAT) -> Column:
    return parse_time(text, fmt).cast("date")


def date_in_name(name: Column) -> Column:
    found = F.regexp_extract(name, FILE_DATE_PATTERN, 1)
    return parse_date(F.when(found != "", found), FILE_DATE_FORMAT)


def valid_time(text: Column, first_year: int = 2000, fmt: str = TIME_FORMAT) -> Column:
    return F.coalesce(F.year(parse_date(text, fmt)) >= first_year, F.lit(False))


def repair_date(df: DataFrame, time: str = "Timestamp", file: str = "source_file", first_year: int = 2000) -> DataFrame:
    """Adds `date` and `date_repaired`; a date before `first_year` or unreadable is taken from the file name.

    Without a file column such dates cannot be repaired. Rows left without a date are dropped.
    """
    parsed = parse_date(c(time))
    good = F.year(parsed) >= first_year
    if file in df.columns:
        date = F.when(good, parsed).otherwise(date_in_name(c(file)))
    else:
        date = F.when(good, parsed)
    out = df.withColumn("date", date).withColumn("date_repaired", ~F.coalesce(good, F.lit(False)))
    return out.filter(F.col("date").isNotNull())


def add_time_parts(df: DataFrame, time: str = "Timestamp", keep: bool = False) -> DataFrame:
    """`hour` (0–23) and `day_of_week` (1 = Sunday); the text column goes unless `keep`."""
    moment = parse_time(c(time))
    out = df.withColumns({"hour": F.hour(moment), "day_of_week": F.dayofweek(moment)})
    return out if keep else out.drop(time)


def daily_volume(df: DataFrame, date: str = "date") -> DataFrame:
    return df.groupBy(c(date).alias("date")).agg(F.count(F.lit(1)).alias("n_rows")).orderBy("date")


def daily_classes(df: DataFrame, label: str = "Label", date: str = "date") -> DataFrame:
    """Rows per day and class with the share within the day."""
    counts = df.groupBy(c(date).alias("date"), c(label).alias("Label")).agg(F.count(F.lit(1)).alias("n_rows"))
    day_total = F.sum("n_rows").over(Window.partitionBy("date"))
    return counts.withColumn("share", F.col("n_rows") / day_total).withColumn("pct", pct(F.col("n_rows"), day_total, 4))


def daily_pivot(df: DataFrame, classes: Sequence[str], label: str = "Label", date: str = "date") -> DataFrame:
    """One row per day, one column per class, 0 where a class is absent."""
    table = df.groupBy(c(date).alias("date")).pivot(label, list(classes)).agg(F.count(F.lit(1)))
    return table.fillna(0, subset=list(classes)).orderBy("date")
