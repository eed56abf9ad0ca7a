"""Headers of many files in one job, records cut by line breaks, describing texts."""

import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowsift.operators import audit
from flowsift.operators.labels import LabelCatalogue
from flowsift.plans.layers import ingest
from flowsift.sources import readers


def jobs(spark, action):
    """(result, number of jobs) of `action`."""
    context = spark.sparkContext
    context.setJobGroup("counted", "counted")
    try:
        return action(), len(context.statusTracker().getJobIdsForGroup("counted"))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_headers_of_a_thousand_files_are_one_job(spark, tmp_path):
    for i in range(1000):
        text = f"id,Label\n{i},x\n" if i % 4 else f"\n label ,id,more\ny,{i},z\n"
        (tmp_path / f"f{i:04d}.csv").write_text(text)
    (tmp_path / "empty.csv").write_text("")
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    groups, n = jobs(spark, lambda: readers._layouts(spark, str(tmp_path), "*.csv"))
    assert n == 1 and spark.conf.get("spark.sql.files.openCostInBytes") == before
    assert {k: len(v) for k, v in groups.items()} == {(" label ", "id", "more"): 250, ("id", "Label"): 750}
    read = readers.read_csv(spark, str(tmp_path), {"id": T.LongType(), "Label": T.StringType()})
    assert read.select(F.sum("id"), F.count("more"), F.count_if(F.col("Label") == "x")).first() == (499500, 250, 750)


def test_one_layout_keeps_no_list_of_files(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"a b{i}.csv").write_text(f"id,v\n{i},1\n")
    assert readers._layouts(spark, str(tmp_path), "*.csv") == {("id", "v"): [str(tmp_path)]}
    (tmp_path / "other.csv").write_text("id\n9\n")
    assert sorted(r["id"] for r in readers.read_csv(spark, str(tmp_path), {"id": T.LongType()}).collect()) == [0, 1, 2, 9]


def test_header_names_as_the_reader_gives_them(spark, tmp_path):
    for line in ("a,b", "a,,A,b", '"x ""y""", z', "a,a,a", "é,\"q,r\""):
        (tmp_path / "one.csv").write_text(line + "\n1\n", encoding="utf-8")
        assert readers.header_names(line) == tuple(spark.read.options(header=True, **readers.CSV_FORM).csv(str(tmp_path / "one.csv")).columns)


def test_a_cut_record_is_an_error_and_never_two_rows(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text('id,note,Label\n1,"one\ntwo",Bot\n2,x,Bot\n3,"a ""b""",Bot\n')
    catalogue = LabelCatalogue(names=("Bot",), variants={"robot": "Bot"})
    types = {"id": T.LongType()}
    with pytest.raises(PySparkException, match="multi_line"):
        ingest(spark, str(tmp_path / "in"), str(tmp_path / "bad"), types, catalogue)
    flows, bronze = ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), types, catalogue, multi_line=True)
    assert sorted((r["id"], r["note"]) for r in bronze.collect()) == [(1, "one\ntwo"), (2, "x"), (3, 'a "b"')] and flows.count() == 3


def test_values_that_do_not_fit_are_still_null(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,note\nx,"he said ""no"""\n2,ok\n3\n')
    rows = readers.read_csv(spark, str(tmp_path), {"id": T.LongType()}).orderBy("note").collect()
    assert [(r["id"], r["note"]) for r in rows] == [(3, None), (None, 'he said "no"'), (2, "ok")]


def test_describe_texts(spark):
    day = datetime.date(2020, 2, 1)
    rows = [("b", 1.0, day, True, [1]), ("é", None, None, False, None), ("", 3.0, day, None, None), (None, 2.0, day, True, [2])]
    df = spark.createDataFrame(rows, "t string, x double, d date, f boolean, a array<int>")
    found = {r["column"]: r for r in audit.describe(df).collect()}
    assert set(found) == {"t", "x", "d", "f"}
    assert (found["t"].n, found["t"].first, found["t"]["last"], found["t"].mean) == (3, "", "é", None)
    assert (found["x"].n, found["x"].mean, found["x"]["min"], found["x"]["max"], found["x"].first) == (3, 2.0, 1.0, 3.0, None)
    assert found["d"].first == "2020-02-01" and (found["f"].first, found["f"]["last"]) == ("false", "true")
