"""Cleaning steps."""

from pyspark.sql import functions as F

from flowsift.functions.columns import c, number_or_zero, rename_like
from flowsift.operators import clean
from flowsift.plans.layers import to_silver
from flowsift.queries.audit import SILVER_SQL
from flowsift.queries.registry import query, table
from flowsift.queries.views import FLOWS_DUP_SQL, FLOWS_SQL, flows, flows_dup, over, text_of, text_of_sql

_RATE = text_of_sql('"Flow Byts/s"')


def _written(df):
    """The column with NaN and infinities as text."""
    return df.withColumn("Flow Byts/s", text_of(c("Flow Byts/s")))


@query("proj_label_rename", over(FLOWS_SQL, 'SELECT event_id, "Label" FROM flows'))
def proj_label_rename(spark, folder):
    drifted = flows(spark, folder).withColumnRenamed("Label", " label ")
    return rename_like(drifted, "Label").select("event_id", "Label")


@query("proj_final", over(FLOWS_SQL, 'SELECT event_id, "Label", "Flow Duration", "Init Win Byts" FROM flows'))
def proj_final(spark, folder):
    return flows(spark, folder).select(*[c(n) for n in ("event_id", "Label", "Flow Duration", "Init Win Byts")])


@query(
    "proj_coerce_fill",
    over(FLOWS_SQL, """SELECT event_id, coalesce(try_cast(replace("Src IP", '10.0.0.', '') AS DOUBLE), 0.0) AS host FROM flows"""),
)
def proj_coerce_fill(spark, folder):
    host = F.regexp_replace(c("Src IP"), r"10\.0\.0\.", "")
    return flows(spark, folder).select("event_id", number_or_zero(host).alias("host"))


@query(
    "clean_drop_ids",
    over(FLOWS_SQL, f"""SELECT event_id, source_file, "Timestamp", "Label", "Flow Duration", {_RATE} AS "Flow Byts/s", "Init Win Byts", "Const" FROM flows"""),
)
def clean_drop_ids(spark, folder):
    return _written(clean.drop_ids(flows(spark, folder)))


@query(
    "clean_dedup",
    over(
        FLOWS_DUP_SQL,
        f"""SELECT DISTINCT source_file, "Timestamp", "Label", "Flow Duration", {_RATE} AS "Flow Byts/s", "Init Win Byts", "Const", "Src IP" FROM flows_dup""",
    ),
)
def clean_dedup(spark, folder):
    return _written(clean.deduplicate(flows_dup(spark, folder)))


@query(
    "clean_nonfinite_to_null",
    over(FLOWS_SQL, """SELECT event_id, "Flow Duration", CASE WHEN isfinite("Flow Byts/s") THEN "Flow Byts/s" END AS "Flow Byts/s" FROM flows"""),
)
def clean_nonfinite_to_null(spark, folder):
    return clean.nonfinite_to_null(flows(spark, folder).select("event_id", "Flow Duration", c("Flow Byts/s")))


@query("clean_dropna", over(FLOWS_SQL, """SELECT event_id, "Flow Byts/s", "Label" FROM flows WHERE isfinite("Flow Byts/s")"""))
def clean_dropna(spark, folder):
    return clean.finite_rows(flows(spark, folder)).select("event_id", c("Flow Byts/s"), "Label")


@query(
    "clean_bad_timestamps",
    over(FLOWS_SQL, """SELECT event_id, "Timestamp" FROM flows WHERE year(try_strptime("Timestamp", '%d/%m/%Y %H:%M:%S')) >= 2000"""),
)
def clean_bad_timestamps(spark, folder):
    return clean.drop_bad_times(flows(spark, folder)).select("event_id", "Timestamp")


@query(
    "clean_clip_negative",
    over(
        FLOWS_SQL,
        """SELECT event_id, CASE WHEN "Flow Duration" < 0 THEN 0 ELSE "Flow Duration" END AS "Flow Duration",
             CASE WHEN "Init Win Byts" < 0 THEN 0 ELSE "Init Win Byts" END AS "Init Win Byts" FROM flows""",
    ),
)
def clean_clip_negative(spark, folder):
    return clean.clip_negatives(flows(spark, folder)).select("event_id", "Flow Duration", "Init Win Byts")


@query(
    "clean_clip_balances",
    "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS c_acctbal FROM customer",
)
def clean_clip_balances(spark, folder):
    return clean.clip_negatives(table(spark, folder, "customer").select("c_custkey", "c_acctbal"))


@query(
    "clean_drop_constant",
    over(FLOWS_SQL, f"""SELECT event_id, source_file, "Timestamp", "Label", "Flow Duration", {_RATE} AS "Flow Byts/s", "Init Win Byts", "Src IP" FROM flows"""),
)
def clean_drop_constant(spark, folder):
    return _written(clean.drop_constant(flows(spark, folder)))


@query("clean_silver", over(SILVER_SQL, "SELECT * FROM z6"))
def clean_silver(spark, folder):
    return to_silver(flows_dup(spark, folder).drop("source_file"))


@query(
    "proj_coerce_fill_nan",
    over(FLOWS_SQL, """SELECT event_id, CASE WHEN isnan("Flow Byts/s") THEN 0 ELSE coalesce("Flow Byts/s", 0) END::DOUBLE AS rate FROM flows
         WHERE "Flow Byts/s" IS NULL OR NOT isinf("Flow Byts/s")"""),
)
def proj_coerce_fill_nan(spark, folder):
    rows = flows(spark, folder)
    kept = rows.filter(c("Flow Byts/s").isNull() | (c("Flow Byts/s") != float("inf")))
    return kept.select("event_id", number_or_zero(c("Flow Byts/s").cast("string")).alias("rate"))
