import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowsift import session
from flowsift.functions.hashing import fast_uniform
from flowsift.operators import features, labels, sampling, training
from flowsift.plans.layers import ingest, to_gold, to_silver
from flowsift.plans.modelling import prepare_sides
from flowsift.sources import readers, sinks

TYPES = {"Flow Duration": T.DoubleType(), "Dst Port": T.IntegerType()}


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "a-14-02-2018.csv").write_text(
        "Dst Port,Flow Duration,Timestamp, Label\n80,1.5,14/02/2018 08:00:00,Benign\n"
        "Dst Port,Flow Duration,Timestamp,Label\n443,Infinity,14/02/2018 09:00:00,bot \n"
    )
    (tmp_path / "b-15-02-2018.csv").write_text(
        "Src IP,Dst Port,Flow Duration,Timestamp,Label\n10.0.0.1,22,-3,15/02/2018 10:00:00,SSH-Bruteforce\n"
    )
    (tmp_path / "notes.txt").write_text("no table")
    return str(tmp_path)


def test_read_csv_with_drifting_layouts(spark, folder):
    df = readers.read_csv(spark, folder, TYPES)
    assert dict(df.dtypes)["Flow Duration"] == "double" and dict(df.dtypes)["Dst Port"] == "int"
    rows = {r["source_file"]: r["n_rows"] for r in readers.rows_per_file(df).collect()}
    assert rows == {"a-14-02-2018.csv": 3, "b-15-02-2018.csv": 1}
    assert [r["Src IP"] for r in df.filter(F.col("`Dst Port`") == 22).collect()] == ["10.0.0.1"]


def test_headers_that_drift_are_one_column(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Dst Port, Label\n80,Benign\n")
    (tmp_path / "b.csv").write_text("dst port ,label\n81,Bot\n")
    df = readers.read_csv(spark, str(tmp_path), {**TYPES, "Label": T.StringType()})
    assert sorted((r["Dst Port"], r["Label"]) for r in df.collect()) == [(80, "Benign"), (81, "Bot")]
    assert df.columns == ["Dst Port", "Label", "source_file"]


def test_csv_keeps_every_value(spark, tmp_path):
    rows = [(1, "  Bot "), (2, "a\nb"), (3, ""), (4, None), (5, 'say "x", y'), (6, "back\\slash"), (7, "é\t")]
    df = spark.createDataFrame(rows, "i int, t string")
    back = readers.read_csv(spark, sinks.write_csv(df, str(tmp_path / "out")), df.schema, multi_line=True)
    assert sorted((r["i"], r["t"]) for r in back.collect()) == rows


def test_inferred_types_and_misfits(spark):
    rows = [("1", "2.5", "x", None), (" 3 ", "4", "5", ""), (None, "nan", "6", None)]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string")
    assert {n: t.simpleString() for n, t in readers.infer_types(df).items()} == {"a": "bigint", "b": "double", "c": "string", "d": "string"}
    bad = {r["column"]: (r["n_values"], r["n_misfits"]) for r in readers.misfits(df, {"a": T.LongType(), "c": T.IntegerType()}).collect()}
    assert bad == {"a": (2, 0), "c": (3, 1)}


def test_a_cluster_needs_a_shared_folder():
    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Fake:
        conf = Conf({"spark.master": "spark://host:7077"})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Fake())


def test_no_csv_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        readers.list_csv(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        readers.list_csv(spark, str(tmp_path / "nowhere"))


def test_ingest_drops_header_lines(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "x.csv").write_text(
        "Dst Port,Flow Duration,Timestamp,Label\n80,1,14/02/2018 08:00:00,Benign\n"
        "Dst Port,Flow Duration,Timestamp,Label\n80,2,14/02/2018 08:00:00,BOT\n"
    )
    flows, bronze = ingest(spark, str(source), str(tmp_path / "bronze"), TYPES)
    assert labels.unrecoverable(flows).collect()[0]["Label"] == "Label"
    assert {r["Label"] for r in bronze.collect()} == {"Benign", "Bot"}
    assert "source_file" not in bronze.columns


def test_sink_checks(spark, tmp_path):
    df = spark.range(100).withColumn("k", F.when(F.col("id") < 90, "hot").otherwise("cold"))
    path = str(tmp_path / "t")
    back = sinks.write_parquet(df, path, ["k"])
    assert sinks.verify_written(df, path).first()["passed"] and back.count() == 100
    assert not sinks.verify_written(df.limit(3), path).first()["passed"]
    assert readers.footprint(spark, path, "*.parquet").first()["n_files"] >= 2
    metrics = spark.createDataFrame([("RF", 0.8)], "modelo string, f1 double")
    assert readers.read_metrics(spark, sinks.write_metrics(metrics, str(tmp_path / "m"))).first()["f1"] == 0.8


@pytest.fixture(scope="module")
def gold(spark):
    n = F.col("id")
    df = spark.range(3000).select(
        (n % 97).cast("double").alias("a"),
        (n % 97 * 2).cast("double").alias("twice"),
        (n % 13).cast("double").alias("b"),
        F.when(n % 97 < 60, "low").when(n % 97 < 90, "mid").otherwise("top").alias("Label"),
        F.date_format(F.timestamp_seconds(1518600000 + n * 60), "dd/MM/yyyy HH:mm:ss").alias("Timestamp"),
    )
    return to_gold(to_silver(df))


def test_gold_drops_the_correlated_and_indexes_by_frequency(gold):
    table, kept = gold
    assert "twice" not in kept and "hour" in kept and table.columns[:2] == ["Label", "label_index"]
    index = {r["Label"]: r["label_index"] for r in table.select("Label", "label_index").distinct().collect()}
    assert index == {"low": 0.0, "mid": 1.0, "top": 2.0}


def test_models_beat_the_majority_class(spark, gold):
    table, kept = gold
    sides = prepare_sides(table, ["a", "b"])
    assert sides.train.count() + sides.test.count() == table.count()
    makers = {"rf": training.random_forest(numTrees=5, maxDepth=5), "gbt": training.gbt_one_vs_rest(maxIter=2, maxDepth=3)}
    models, board = training.fit_and_judge(makers, sides.balanced, sides.test)
    assert all(r["f1"] > 0.9 for r in board.collect())
    scored = training.score(models["gbt"], sides.test)
    assert len(scored.first()["scores"]) == 3


def test_tuning_keeps_the_parts_apart(spark, gold):
    table, _ = gold
    packed = features.assemble(table.withColumn("_id", F.monotonically_increasing_id()), ["a", "b"]).select("_id", "label_index", "features")
    seen = {}

    def prepare(part):
        seen["fit"] = {r["_id"] for r in part.collect()}
        return sampling.balance(part, fast_uniform(1, "_id"), "label_index")

    u = fast_uniform(5, "_id")
    model, report = training.tune_gbt(packed, u, prepare, {"maxIter": (1,), "maxDepth": (2,), "stepSize": (0.1,)})
    assert report.count() == 1 and len(seen["fit"]) == packed.filter(u < 0.75).count()
    best, grid = training.tune_forest(packed, u, grid={"numTrees": (2, 3), "maxDepth": (2,)})
    assert grid.count() == 2 and grid.filter("best").count() >= 1
    again = training.tune_forest(packed.repartition(3), u, grid={"numTrees": (2, 3), "maxDepth": (2,)})[1]
    assert [r["numTrees"] for r in again.collect()] == [r["numTrees"] for r in grid.collect()]


def test_saved_model_predicts_the_same(spark, gold, tmp_path):
    table, _ = gold
    packed = features.assemble(table, ["a", "b"])
    model = training.gbt_one_vs_rest(maxIter=1, maxDepth=2).fit(packed)
    back = training.load_one_vs_rest(training.save_model(model, str(tmp_path / "m")))
    one, two = ([r["prediction"] for r in training.score(m, packed).collect()] for m in (model, back))
    assert one == two
