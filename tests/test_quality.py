import math

import pytest
from pyspark.sql import functions as F

from flowsift.functions.columns import find_column, join_on, lookup_side, numeric_columns, rename_like
from flowsift.operators import audit, clean, temporal
from flowsift.plans.layers import silver_report, silver_stages, to_silver

NAN, INF = math.nan, math.inf
SCHEMA = "id int, `Flow Byts/s` double, `a.b` double, win int, Timestamp string, Label string, `Src IP` string"
ROWS = [
    (1, 1.0, 1.0, -1, "14/02/2018 08:00:00", "Benign", "10.0.0.1"),
    (1, 1.0, 1.0, -1, "14/02/2018 08:00:00", "Benign", "10.0.0.2"),
    (2, INF, 1.0, 5, "14/02/2018 08:00:00", "Bot", None),
    (3, NAN, 1.0, 5, "14/02/2018 08:00:00", "Bot", None),
    (4, None, 1.0, 5, "14/02/2018 08:00:00", "Bot", None),
    (5, 2.0, 1.0, 5, "01/01/1970 00:00:01", "Bot", None),
    (6, 2.0, 1.0, 5, "bad", "Bot", None),
    (7, -3.0, 1.0, None, "15/02/2018 23:59:59", "Bot", None),
    (8, 5.0, 1.0, 9, "16/02/2018 00:00:00", "Bot", None),
]


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_silver_order(raw):
    stages = silver_stages(raw)
    report = audit.stage_report(stages).orderBy("stage_no").collect()
    assert [r["n_rows"] for r in report] == [9, 9, 8, 5, 3, 3, 3]
    assert [r["rows_removed"] for r in report] == [0, 0, 1, 3, 2, 0, 0]
    assert "a.b" not in stages[-1][1].columns
    assert sorted(map(str, to_silver(raw).collect())) == sorted(map(str, stages[-1][1].collect()))
    assert sorted(map(str, silver_report(raw).collect())) == sorted(map(str, report))


def test_clip_keeps_null_and_takes_the_sentinel(raw):
    rows = {r["id"]: r for r in to_silver(raw).collect()}
    assert rows[1]["win"] == 0 and rows[7]["win"] is None and rows[7]["Flow Byts/s"] == 0.0


def test_cleaning_twice_changes_nothing(raw):
    once = to_silver(raw).drop("id")
    assert sorted(map(str, once.collect())) == sorted(map(str, to_silver(once).collect()))


def test_nonfinite_counts(raw):
    found = audit.nonfinite_counts(raw).collect()
    assert [(r["column"], r["n_inf"], r["n_nan"], r["n_null"]) for r in found] == [("Flow Byts/s", 1, 1, 1)]


def test_duplicates_count_all_members(spark):
    df = spark.createDataFrame([(1,)] * 3 + [(2,)] * 2 + [(3,)], "x int")
    row = audit.duplicates(df).first()
    assert (row["duplicate_groups"], row["duplicate_rows"], row["surplus_rows"]) == (2, 5, 3)


def test_constant_columns_with_nulls(spark):
    df = spark.createDataFrame([(1, None, None, 1), (1, 1, None, 2)], "a int, b int, c int, d int")
    assert {r["column"] for r in audit.constant_columns(df).collect()} == {"a", "c"}
    assert clean.find_constant(df) == ["a", "b"]


def test_integrity_gate(raw):
    before = {r["check"]: r["passed"] for r in audit.integrity(raw).collect()}
    assert not any(before[k] for k in ("null_numbers", "infinite_values", "negative_values", "id_columns_left"))
    after = {r["check"]: r["violations"] for r in audit.integrity(to_silver(raw)).collect()}
    assert after == {"null_numbers": 1, "infinite_values": 0, "negative_values": 0, "id_columns_left": 0, "time_column_lost": 0}


def test_each_audit_scans_once(raw, spark):
    for make in (audit.null_counts, audit.nonfinite_counts, audit.describe, audit.variance, audit.negative_counts):
        plan = make(spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet"))._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1, make


def test_published_percentages(spark):
    """Shares published for ten source files."""
    rows = [("thu-01", 331125, 331100), ("wed-28", 613104, 613071), ("fri-16", 1048575, 1048574)]
    df = spark.createDataFrame(rows, "f string, n long, ok long")
    share = {r["f"]: r["p"] for r in df.select("f", F.round((F.col("n") - F.col("ok")) / F.col("n") * 100, 2).alias("p")).collect()}
    assert share == {"thu-01": 0.01, "wed-28": 0.01, "fri-16": 0.0}


def test_quality_by_file_counts_missing_as_invalid(spark):
    df = spark.createDataFrame([("f", "Bot"), ("f", None), ("f", "x"), ("g", "Bot")], "source_file string, Label string")
    rows = {r["source_file"]: r for r in audit.quality_by_file(df).collect()}
    assert rows["f"]["labels_invalidos"] == 2 and rows["f"]["pct_corrupcion"] == 66.67 and rows["g"]["pct_corrupcion"] == 0.0
    assert [r["source_file"] for r in audit.flagged_files(audit.quality_by_file(df)).collect()] == ["f"]


def test_repair_date(spark):
    rows = [(1, "01/01/1970 00:00:01", "day-05-01-2024.csv"), (2, "bad", "nothing"), (3, "06/01/2024 10:00:00", "x")]
    df = spark.createDataFrame(rows, "id int, Timestamp string, source_file string")
    out = {r["id"]: (str(r["date"]), r["date_repaired"]) for r in temporal.repair_date(df).collect()}
    assert out == {1: ("2024-01-05", True), 3: ("2024-01-06", False)}
    assert temporal.repair_date(df.drop("source_file")).count() == 1


def test_time_parts(spark):
    df = spark.createDataFrame([("18/02/2018 23:10:00",), ("bad",)], "Timestamp string")
    rows = temporal.add_time_parts(df).collect()
    assert (rows[0]["hour"], rows[0]["day_of_week"]) == (23, 1) and rows[1]["hour"] is None


def test_names(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "`a.b` int, ` label` string, `c/d` double")
    assert numeric_columns(df) == ["a.b", "c/d"] and find_column(df, "Label") == " label"
    assert "Label" in rename_like(df, "Label").columns
    with pytest.raises(ValueError):
        find_column(df, "nope")


def test_lookup_side_broadcasts_only_small_frames(spark):
    big = spark.range(1000).withColumn("k", F.col("id") % 100)
    small = big.groupBy("k").count()
    for limit, joined_by in ((1000, "BroadcastHashJoin"), (10, "SortMergeJoin")):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            out = join_on(big, lookup_side(small, limit), ["k"])
            assert joined_by in out._jdf.queryExecution().executedPlan().toString()
            assert out.count() == 1000
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
