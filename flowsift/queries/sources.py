"""Sources and sinks. Each query writes the given tables out and reads them back."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowsift.functions.columns import c
from flowsift.operators.audit import integrity
from flowsift.operators.labels import LabelCatalogue
from flowsift.plans.layers import ingest, to_bronze, to_gold, to_silver
from flowsift.queries.labels import STAGED_SQL, repaired
from flowsift.queries.registry import query, rounded, table
from flowsift.queries.views import FLOWS_SQL, flows, over, text_of, text_of_sql
from flowsift.session import scratch_path
from flowsift.sources import readers, sinks

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
FLOW_TYPES = {
    "event_id": T.LongType(),
    "Flow Duration": T.DoubleType(),
    "Flow Byts/s": T.DoubleType(),
    "Init Win Byts": T.IntegerType(),
    "Const": T.IntegerType(),
}


def _csv_days(spark, folder):
    """The flows with their dirty labels as a CSV folder in two layouts: even days lack the column `Src IP` and call the label ` Label`,
    odd days `label`."""
    path = scratch_path(spark, "csv")
    source = flows(spark, folder).drop("source_file")
    even = F.col("event_id") % 2 == 0
    sinks.write_csv(source.filter(~even).withColumnRenamed("Label", "label"), f"{path}/full")
    sinks.write_csv(source.filter(even).drop("Src IP").withColumnRenamed("Label", " Label"), f"{path}/short")
    return path


@query("src_csv_roundtrip", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def src_csv_roundtrip(spark, folder):
    path = scratch_path(spark, "events")
    events = table(spark, folder, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    sinks.write_csv(events, path)
    return readers.read_csv(spark, path, events.schema).drop("source_file")


@query("src_csv_roundtrip_text", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def src_csv_roundtrip_text(spark, folder):
    """Texts with line breaks, quotes and blanks at their ends."""
    path = scratch_path(spark, "documents")
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    sinks.write_csv(docs, path)
    return readers.read_csv(spark, path, docs.schema, multi_line=True).drop("source_file")


@query(
    "src_csv_two_layouts",
    over(
        FLOWS_SQL,
        f"""SELECT event_id, "Timestamp", "Label", "Flow Duration", {text_of_sql('"Flow Byts/s"')} AS "Flow Byts/s", "Init Win Byts", "Const", "Src IP" FROM flows""",
    ),
)
def src_csv_two_layouts(spark, folder):
    path = _csv_days(spark, folder)
    read = readers.read_csv(spark, f"{path}/*", {**FLOW_TYPES, "Label": T.StringType()}, multi_line=True)
    return read.withColumn("Flow Byts/s", text_of(c("Flow Byts/s"))).drop("source_file")


@query(
    "src_csv_inferred",
    """SELECT unnest(['event_id', 'Timestamp', 'Label', 'Flow Duration', 'Flow Byts/s', 'Init Win Byts', 'Const', 'Src IP']) AS "column",
              unnest(['bigint', 'string', 'string', 'double', 'double', 'bigint', 'bigint', 'string']) AS "type" """,
)
def src_csv_inferred(spark, folder):
    text = readers.read_csv(spark, f"{_csv_days(spark, folder)}/*", {"Label": T.StringType()}, multi_line=True)
    found = readers.infer_types(text, exclude=["source_file"])
    return spark.createDataFrame([(n, t.simpleString()) for n, t in found.items()], "column string, type string")


@query(
    "src_csv_misfits",
    over(FLOWS_SQL, """SELECT 'Timestamp' AS "column", count(*) AS n_values, count(*) AS n_misfits FROM flows
      UNION ALL SELECT 'Const', count(*), 0 FROM flows"""),
)
def src_csv_misfits(spark, folder):
    text = readers.read_csv(spark, f"{_csv_days(spark, folder)}/*", {}, multi_line=True)
    return readers.misfits(text, {"Timestamp": T.DoubleType(), "Const": T.IntegerType()})


@query("src_file_tag", "SELECT event_id % 2 = 0 AS even, count(*) AS n_rows, count(*) AS n_tagged FROM events GROUP BY 1")
def src_file_tag(spark, folder):
    """Rows per layout, and those that name a CSV file as their source."""
    path = _csv_days(spark, folder)
    read = readers.read_csv(spark, f"{path}/*", FLOW_TYPES, multi_line=True)
    tagged = F.count_if(F.col("source_file").rlike(r"^part-.*\.csv$"))
    return read.groupBy((F.col("event_id") % 2 == 0).alias("even")).agg(F.count(F.lit(1)).alias("n_rows"), tagged.alias("n_tagged"))


@query("src_rows_per_file", over(FLOWS_SQL, "SELECT source_file, count(*) AS n_rows, 9::INT AS n_columns FROM flows GROUP BY 1"))
def src_rows_per_file(spark, folder):
    return readers.rows_per_file(flows(spark, folder))


@query(
    "sink_partitioned",
    over(STAGED_SQL, """SELECT "Label", count(*) AS n_rows FROM repaired WHERE "Label" IN (FROM nm) GROUP BY 1"""),
)
def sink_partitioned(spark, folder):
    bronze = sinks.write_parquet(to_bronze(repaired(spark, folder)), scratch_path(spark, "bronze"), ["Label"])
    return bronze.groupBy("Label").agg(F.count(F.lit(1)).alias("n_rows"))


@query("sink_parquet", "SELECT * FROM orders")
def sink_parquet(spark, folder):
    orders = table(spark, folder, "orders")
    return sinks.write_parquet(orders, scratch_path(spark, "orders"))


@query(
    "sink_verify",
    "SELECT count(*) AS rows_expected, count(*) AS rows_found, 6::INT AS columns_expected, 6::INT AS columns_found, true AS passed FROM orders",
)
def sink_verify(spark, folder):
    orders = table(spark, folder, "orders")
    path = scratch_path(spark, "orders")
    sinks.write_parquet(orders, path)
    return sinks.verify_written(orders, path)


@query(
    "sink_report_csv",
    "SELECT o_orderpriority, count(*) AS n_rows FROM orders GROUP BY 1",
)
def sink_report_csv(spark, folder):
    report = table(spark, folder, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n_rows"))
    path = sinks.write_report(report, scratch_path(spark, "report"))
    return readers.read_csv(spark, path, report.schema).drop("source_file")


@query(
    "metrics_json",
    "SELECT o_orderstatus AS modelo, count(*) AS n, round(avg(o_totalprice), 4) AS tiempo_s FROM orders GROUP BY 1",
)
def metrics_json(spark, folder):
    metrics = table(spark, folder, "orders").groupBy(F.col("o_orderstatus").alias("modelo")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("o_totalprice"), 4).alias("tiempo_s")
    )
    path = sinks.write_metrics(metrics, scratch_path(spark, "metrics"))
    return readers.read_metrics(spark, path, "modelo string, n long, tiempo_s double")


@query("src_footprint")
def src_footprint(spark, folder):
    return readers.footprint(spark, folder, "*.parquet")


@query("src_footprint_truth", "SELECT true AS same_files, true AS same_size, true AS units_agree")
def src_footprint_truth(spark, folder):
    """The files of all tables and their lengths, against what a scan of each table says of the files it reads."""
    files = [table(spark, folder, n).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")) for n in TABLES]
    read = reduce(DataFrame.unionAll, files).distinct().agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))
    found = readers.footprint(spark, folder, "*.parquet")
    return found.select(
        (F.col("n_files") == read.select("n").scalar()).alias("same_files"),
        (F.abs(F.col("size_mb") * 1048576 - read.select("bytes").scalar()) < 0.5).alias("same_size"),
        (F.abs(F.col("size_mb") / 1024 - F.col("size_gb")) < 1e-9).alias("units_agree"),
    )


@query(
    "ingest_bronze",
    over(STAGED_SQL, """SELECT "Label", count(*) AS n_rows, round(sum("Flow Duration"), 2) AS duration FROM repaired WHERE "Label" IN (FROM nm) GROUP BY 1"""),
)
def ingest_bronze(spark, folder):
    """CSV folder with dirty labels in, bronze table out, summed up again per class."""
    _, bronze = ingest(spark, f"{_csv_days(spark, folder)}/*", scratch_path(spark, "bronze"), FLOW_TYPES)
    sums = bronze.groupBy("Label").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("Flow Duration").alias("duration"))
    return rounded(sums, 2, "duration")


@query(
    "ingest_line_breaks",
    """SELECT lang AS "Label", count(*) AS n_rows, sum(length(text))::BIGINT AS n_text FROM documents WHERE lang IN ('en', 'de', 'fr', 'es') GROUP BY 1""",
)
def ingest_line_breaks(spark, folder):
    """Texts with line breaks and quotes through a CSV folder into a bronze table partitioned by class: no row is cut or lost."""
    path = scratch_path(spark, "csv")
    docs = table(spark, folder, "documents").select("doc_id", F.col("lang").alias("Label"), "text")
    sinks.write_csv(docs, path)
    languages = LabelCatalogue(names=("en", "de", "fr", "es"), variants={"english": "en"})
    _, bronze = ingest(spark, path, scratch_path(spark, "bronze"), {"doc_id": T.LongType()}, languages, multi_line=True)
    return bronze.groupBy("Label").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.length("text")).alias("n_text"))


@query(
    "src_csv_many_files",
    over(FLOWS_SQL, """SELECT event_id % 2 = 0 AS even, count(*) AS n_rows, count("Src IP") AS n_src, round(sum("Flow Duration"), 2) AS duration
                       FROM flows GROUP BY 1"""),
)
def src_csv_many_files(spark, folder):
    """Two layouts over some sixty files; the headers of all of them are one job."""
    path = scratch_path(spark, "many")
    source = flows(spark, folder).drop("source_file").repartition(32, "event_id")
    even = F.col("event_id") % 2 == 0
    sinks.write_csv(source.filter(~even), f"{path}/full")
    sinks.write_csv(source.filter(even).drop("Src IP"), f"{path}/short")
    read = readers.read_csv(spark, f"{path}/*", FLOW_TYPES)
    counts = read.groupBy((F.col("event_id") % 2 == 0).alias("even")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(c("Src IP")).alias("n_src"), F.sum(c("Flow Duration")).alias("duration")
    )
    return rounded(counts, 2, "duration")


@query(
    "pipeline_gold",
    over(
        STAGED_SQL,
        """, s AS (SELECT "Label", greatest("Flow Duration", 0) AS d, try_strptime("Timestamp", '%d/%m/%Y %H:%M:%S') AS t FROM repaired
             WHERE "Label" IN (FROM nm) AND isfinite("Flow Byts/s") AND year(try_strptime("Timestamp", '%d/%m/%Y %H:%M:%S')) >= 2000)
        SELECT "Label", (dense_rank() OVER (ORDER BY count(*) DESC, "Label") - 1)::DOUBLE AS label_index, count(*) AS n_rows,
          round(sum(d), 2) AS duration, sum(hour(t))::BIGINT AS hours FROM s GROUP BY 1""",
    ),
)
def pipeline_gold(spark, folder):
    """CSV with dirty labels through bronze and silver to gold, summed up per class."""
    _, bronze = ingest(spark, f"{_csv_days(spark, folder)}/*", scratch_path(spark, "bronze"), FLOW_TYPES)
    silver = sinks.write_parquet(to_silver(bronze), scratch_path(spark, "silver"))
    gold, _ = to_gold(silver, stored=True)
    sums = gold.groupBy("Label", "label_index").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("Flow Duration").alias("duration"), F.sum("hour").cast("long").alias("hours")
    )
    return rounded(sums, 2, "duration")


@query("audit_silver", "SELECT true AS passed")
def audit_silver(spark, folder):
    """The integrity gate on the silver table it was made for: every check passes."""
    _, bronze = ingest(spark, f"{_csv_days(spark, folder)}/*", scratch_path(spark, "bronze"), FLOW_TYPES)
    checks = integrity(sinks.write_parquet(to_silver(bronze), scratch_path(spark, "silver")))
    return checks.agg(F.bool_and("passed").alias("passed"))
