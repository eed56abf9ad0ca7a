"""Time columns."""

from pyspark.sql import functions as F

from flowsift.operators import temporal
from flowsift.queries.labels import STAGED_SQL, repaired
from flowsift.queries.registry import query, rounded
from flowsift.queries.views import FLOWS_SQL, flows, over

_TIME = """try_strptime("Timestamp", '%d/%m/%Y %H:%M:%S')"""
_DATED = (
    STAGED_SQL
    + f""",
dated AS (SELECT *, CASE WHEN year({_TIME}) >= 2000 THEN {_TIME}::DATE
    ELSE strptime(regexp_extract(source_file, '(\\d{{2}}-\\d{{2}}-\\d{{4}})', 1), '%d-%m-%Y')::DATE END AS "date",
    NOT coalesce(year({_TIME}) >= 2000, false) AS date_repaired FROM repaired)"""
)
_CLASSES = ["Benign", "Bot", "Brute Force -Web", "DDoS attack-HOIC", "SSH-Bruteforce"]


def _dated(spark, folder):
    return temporal.repair_date(repaired(spark, folder))


def _texted(df):
    """Dates as ISO text, which both engines print alike."""
    return df.withColumn("date", F.col("date").cast("string"))


@query("time_parse_date", over(FLOWS_SQL, f'SELECT event_id, {_TIME}::DATE::VARCHAR AS "date" FROM flows'))
def time_parse_date(spark, folder):
    return flows(spark, folder).select("event_id", temporal.parse_date(F.col("Timestamp")).cast("string").alias("date"))


@query("time_parse_ts", over(FLOWS_SQL, f"SELECT event_id, {_TIME}::TIMESTAMP::VARCHAR AS moment FROM flows"))
def time_parse_ts(spark, folder):
    moment = temporal.parse_time(F.col("Timestamp")).cast("string")
    return flows(spark, folder).select("event_id", moment.alias("moment"))


@query(
    "time_date_from_file",
    over(FLOWS_SQL, r"""SELECT event_id, strptime(regexp_extract(source_file, '(\d{2}-\d{2}-\d{4})', 1), '%d-%m-%Y')::DATE::VARCHAR AS "date" FROM flows"""),
)
def time_date_from_file(spark, folder):
    return flows(spark, folder).select("event_id", temporal.date_in_name(F.col("source_file")).cast("string").alias("date"))


@query("time_repair_date", over(_DATED, 'SELECT event_id, "date"::VARCHAR AS "date", date_repaired FROM dated WHERE "date" IS NOT NULL'))
def time_repair_date(spark, folder):
    return _texted(_dated(spark, folder)).select("event_id", "date", "date_repaired")


@query(
    "time_features",
    over(
        FLOWS_SQL,
        f"""SELECT event_id, hour({_TIME})::INT AS hour, (dayofweek({_TIME}) + 1)::INT AS day_of_week FROM flows""",
    ),
)
def time_features(spark, folder):
    return temporal.add_time_parts(flows(spark, folder)).select("event_id", "hour", "day_of_week")


@query("time_daily_volume", over(_DATED, 'SELECT "date"::VARCHAR AS "date", count(*) AS n_rows FROM dated GROUP BY dated."date"'))
def time_daily_volume(spark, folder):
    return _texted(temporal.daily_volume(_dated(spark, folder)))


@query(
    "time_daily_pivot",
    over(
        _DATED,
        'SELECT "date"::VARCHAR AS "date", '
        + ", ".join(f"""count_if("Label" = '{n}')::BIGINT AS "{n}" """ for n in _CLASSES)
        + ' FROM dated GROUP BY dated."date"',
    ),
)
def time_daily_pivot(spark, folder):
    return _texted(temporal.daily_pivot(_dated(spark, folder), _CLASSES))


@query(
    "time_daily_share",
    over(
        _DATED,
        """SELECT "date"::VARCHAR AS "date", "Label", count(*) AS n_rows, round(count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY dated."date"), 6) AS share,
             round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (PARTITION BY dated."date"), 4) AS pct FROM dated GROUP BY dated."date", "Label" """,
    ),
)
def time_daily_share(spark, folder):
    return rounded(_texted(temporal.daily_classes(_dated(spark, folder))), 6, "share")
