"""Derived views over the given tables, once as DataFrames and once as SQL for the twins.

The given tables are clean. `flows` adds the dirt of a flow capture row by row (labels, times, non-finite numbers),
`feat` numeric features with classes, `scored` predictions without a model, `runlog` a log of training runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsift.functions.hashing import key_uniform
from flowsift.queries.registry import table

FEATURES = ["quantity", "price", "discount", "tax", "linenumber", "price_net", "price_usd", "day_of_week", "hour"]
KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
FLOW_FLOATS = ["Flow Duration", "Flow Byts/s"]
N_CLASSES = 5


def flows(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    i = F.col("event_id")
    kind = F.col("event_type")
    clean = (
        F.when(kind == "view", "Benign")
        .when(kind == "click", "Bot")
        .when(kind == "error", "Brute Force -Web")
        .when(kind == "purchase", "DDoS attack-HOIC")
        .otherwise("SSH-Bruteforce")
    )
    variant = (
        F.when(kind == "error", "Brute Force-Web")
        .when(kind == "purchase", "DDOS attack-HOIC")
        .when(kind == "signup", "SSH-Brute Force")
        .otherwise(clean)
    )
    turn = i % 13
    label = (
        F.when(turn == 0, F.concat(F.lit("  "), clean, F.lit(" ")))
        .when(turn == 1, F.upper(clean))
        .when(turn == 2, F.regexp_replace(clean, " ", "\t"))
        .when(turn == 3, F.regexp_replace(clean, " ", "  "))
        .when(turn == 4, F.regexp_replace(clean, "[ _-]", ""))
        .when(turn == 5, variant)
        .when((turn == 6) & (i % 5 == 0), "Label")
        .when((turn == 7) & (i % 5 == 0), F.lit(None))
        .when(turn == 8, F.concat(clean, F.char(F.lit(1))))
        .otherwise(clean)
    )
    stamp = (
        F.when(i % 997 == 0, "01/01/1970 00:00:01")
        .when(i % 1009 == 1, "bad")
        .otherwise(F.date_format("ts", "dd/MM/yyyy HH:mm:ss"))
    )
    rate = (
        F.when(i % 211 == 0, F.lit(float("inf")))
        .when(i % 223 == 0, F.lit(float("nan")))
        .when(i % 227 == 0, F.lit(None))
        .otherwise(F.col("value") * 7)
    )
    return events.select(
        i,
        F.concat(F.lit("day-"), F.date_format("ts", "dd-MM-yyyy"), F.lit(".csv")).alias("source_file"),
        stamp.alias("Timestamp"),
        label.alias("Label"),
        (F.col("value") * F.when(i % 101 == 0, -1000).otherwise(1000)).alias("Flow Duration"),
        rate.alias("Flow Byts/s"),
        F.when(i % 17 == 0, -1).otherwise(F.col("user_id")).cast("int").alias("Init Win Byts"),
        F.lit(0).alias("Const"),
        F.when(i % 2 == 1, F.concat(F.lit("10.0.0."), F.col("user_id").cast("string"))).alias("Src IP"),
    )


def flows_dup(spark: SparkSession, folder: str) -> DataFrame:
    i = F.col("event_id")
    copies = 1 + (i % 37 == 0).cast("int") + (i % 74 == 0).cast("int")
    repeated = flows(spark, folder).withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
    return repeated.drop("event_id", "_copy")


def feat(spark: SparkSession, folder: str) -> DataFrame:
    price, discount = F.col("l_extendedprice"), F.col("l_discount")
    return table(spark, folder, "lineitem").select(
        *KEYS,
        F.concat_ws("-", "l_returnflag", "l_linestatus").alias("Label"),
        F.when((F.col("l_quantity") == 1) & (discount == 0), "rare")
        .when(F.col("l_quantity") < 6, "mid")
        .otherwise("common")
        .alias("rarity"),
        F.col("l_quantity").alias("quantity"),
        price.alias("price"),
        discount.alias("discount"),
        F.col("l_tax").alias("tax"),
        F.col("l_linenumber").alias("linenumber"),
        (price * (1 - discount)).alias("price_net"),
        (price * 1.1).alias("price_usd"),
        F.dayofweek("l_shipdate").alias("day_of_week"),
        F.hour("l_shipdate").alias("hour"),
    )


def key_u(seed: int) -> Column:
    """Uniform of a `feat` row."""
    return key_uniform(seed, *KEYS)


def scored(spark: SparkSession, folder: str, seed: int = 7, right: float = 0.7) -> DataFrame:
    kinds = ["click", "error", "purchase", "signup", "view"]
    y = F.lit(0)
    for k, kind in enumerate(kinds):
        y = F.when(F.col("event_type") == kind, k).otherwise(y)
    u = key_uniform(seed, "event_id")
    base = table(spark, folder, "events").select("event_id", y.alias("label_index"), u.alias("_u"))
    guess = F.transform(
        F.array("_u"),
        lambda v: F.when(v < right, F.col("label_index"))
        .when(v < 0.9, (F.col("label_index") + 1) % N_CLASSES)
        .otherwise(0),
    )
    # The explode keeps the hash from being computed again wherever the prediction is used.
    guessed = base.select("event_id", "label_index", F.explode(guess).alias("prediction"))
    scores = [
        F.round(
            F.when(F.col("prediction") == k, 0.6).otherwise(0.1) + 0.3 * key_uniform(100 + k, "event_id"), 4
        )
        for k in range(N_CLASSES)
    ]
    return guessed.select("event_id", "label_index", "prediction", F.array(*scores).alias("scores"))


def both_models(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions of two models, told apart by `model`."""
    parts = [
        scored(spark, folder, seed, right).select(F.lit(name).alias("model"), "label_index", "prediction")
        for name, seed, right in (("a", 7, 0.7), ("b", 8, 0.8))
    ]
    return parts[0].unionByName(parts[1])


def runlog(spark: SparkSession, folder: str) -> DataFrame:
    """One model per supplier; line number n stands for 4·2ⁿ threads and n quarters of the data."""
    lines = table(spark, folder, "lineitem")
    n = F.col("l_linenumber")
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    return (
        lines.groupBy(F.col("l_suppkey").alias("model"), n)
        .agg((F.sum(cents) / F.count(F.lit(1)) / 100 / F.first(n)).alias("time"))
        .select(
            "model",
            (4 * F.pow(F.lit(2.0), n)).cast("int").alias("n_threads"),
            (n / 4.0).alias("frac"),
            "time",
        )
    )


def _u_sql(seed: object, *keys: str) -> str:
    text = ", ".join([f"'{seed}'", *[f"cast({k} AS VARCHAR)" for k in keys]])
    return f"(('0x' || substr(md5(concat_ws('|', {text})), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


def key_u_sql(seed: int) -> str:
    return _u_sql(seed, *KEYS)


FLOWS_SQL = """
flow_base AS (
  SELECT *, CASE event_type WHEN 'view' THEN 'Benign' WHEN 'click' THEN 'Bot' WHEN 'error' THEN 'Brute Force -Web'
                            WHEN 'purchase' THEN 'DDoS attack-HOIC' ELSE 'SSH-Bruteforce' END AS nm,
         CASE event_type WHEN 'error' THEN 'Brute Force-Web' WHEN 'purchase' THEN 'DDOS attack-HOIC'
                         WHEN 'signup' THEN 'SSH-Brute Force' END AS vr
  FROM events),
flows AS (
  SELECT event_id,
    'day-' || strftime(ts, '%d-%m-%Y') || '.csv' AS source_file,
    CASE WHEN event_id % 997 = 0 THEN '01/01/1970 00:00:01' WHEN event_id % 1009 = 1 THEN 'bad'
         ELSE strftime(ts, '%d/%m/%Y %H:%M:%S') END AS "Timestamp",
    CASE WHEN event_id % 13 = 0 THEN '  ' || nm || ' '
         WHEN event_id % 13 = 1 THEN upper(nm)
         WHEN event_id % 13 = 2 THEN replace(nm, ' ', chr(9))
         WHEN event_id % 13 = 3 THEN replace(nm, ' ', '  ')
         WHEN event_id % 13 = 4 THEN regexp_replace(nm, '[ _-]', '', 'g')
         WHEN event_id % 13 = 5 THEN coalesce(vr, nm)
         WHEN event_id % 13 = 6 AND event_id % 5 = 0 THEN 'Label'
         WHEN event_id % 13 = 7 AND event_id % 5 = 0 THEN NULL
         WHEN event_id % 13 = 8 THEN nm || chr(1)
         ELSE nm END AS "Label",
    value * CASE WHEN event_id % 101 = 0 THEN -1000 ELSE 1000 END AS "Flow Duration",
    CASE WHEN event_id % 211 = 0 THEN 'Infinity'::DOUBLE WHEN event_id % 223 = 0 THEN 'NaN'::DOUBLE
         WHEN event_id % 227 = 0 THEN NULL ELSE value * 7 END AS "Flow Byts/s",
    CASE WHEN event_id % 17 = 0 THEN -1 ELSE user_id END::INT AS "Init Win Byts",
    0::INT AS "Const",
    CASE WHEN event_id % 2 = 1 THEN '10.0.0.' || user_id END AS "Src IP"
  FROM flow_base)"""

FLOWS_DUP_SQL = (
    FLOWS_SQL
    + """,
flows_dup AS (
  SELECT f.* EXCLUDE (event_id) FROM flows f
  UNION ALL SELECT f.* EXCLUDE (event_id) FROM flows f WHERE event_id % 37 = 0
  UNION ALL SELECT f.* EXCLUDE (event_id) FROM flows f WHERE event_id % 74 = 0)"""
)

FEAT_SQL = """
feat AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    l_returnflag || '-' || l_linestatus AS "Label",
    CASE WHEN l_quantity = 1 AND l_discount = 0 THEN 'rare' WHEN l_quantity < 6 THEN 'mid' ELSE 'common' END AS rarity,
    l_quantity AS quantity, l_extendedprice AS price, l_discount AS discount, l_tax AS tax,
    l_linenumber AS linenumber, l_extendedprice * (1 - l_discount) AS price_net, l_extendedprice * 1.1::DOUBLE AS price_usd,
    (dayofweek(l_shipdate) + 1)::INT AS day_of_week, hour(l_shipdate)::INT AS hour
  FROM lineitem)"""


def scored_sql(name: str = "scored", seed: int = 7, right: float = 0.7) -> str:
    scores = ", ".join(
        f"round(CASE WHEN prediction = {k} THEN 0.6::DOUBLE ELSE 0.1::DOUBLE END + 0.3::DOUBLE * {_u_sql(100 + k, 'event_id')}, 4) AS s{k}"
        for k in range(N_CLASSES)
    )
    return f"""
{name}_y AS (
  SELECT event_id, CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2
                                   WHEN 'signup' THEN 3 ELSE 4 END::INT AS label_index,
         {_u_sql(seed, 'event_id')} AS u FROM events),
{name}_p AS (
  SELECT event_id, label_index, CASE WHEN u < {right}::DOUBLE THEN label_index WHEN u < 0.9::DOUBLE
         THEN (label_index + 1) % {N_CLASSES} ELSE 0 END::INT AS prediction FROM {name}_y),
{name} AS (SELECT event_id, label_index, prediction, {scores} FROM {name}_p)"""


BOTH_SQL = f"""{scored_sql('sa', 7, 0.7)},{scored_sql('sb', 8, 0.8)},
both_models AS (
  SELECT 'a' AS model, label_index, prediction FROM sa UNION ALL SELECT 'b', label_index, prediction FROM sb)"""

RUNLOG_SQL = """
runlog AS (
  SELECT l_suppkey AS model, (4 * pow(2, l_linenumber))::INT AS n_threads, l_linenumber / 4.0::DOUBLE AS frac,
         sum(round(l_extendedprice * 100)::BIGINT)::DOUBLE / count(*) / 100 / l_linenumber AS time
  FROM lineitem GROUP BY l_suppkey, l_linenumber)"""


def text_of(number: Column) -> Column:
    """A number as text that both engines write alike, with NaN and infinities by name."""
    whole = F.round(number * 1000).cast("long").cast("string")
    return F.when(F.isnan(number), "NaN").when(number == float("inf"), "Infinity").otherwise(whole)


def text_of_sql(number: str) -> str:
    return f"""CASE WHEN isnan({number}) THEN 'NaN' WHEN {number} = 'Infinity'::DOUBLE THEN 'Infinity'
      ELSE CAST(CAST(round({number} * 1000) AS BIGINT) AS VARCHAR) END"""


def over(view: str, body: str) -> str:
    return f"WITH {view.strip()}\n{body.strip()}"
