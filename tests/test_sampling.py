import pytest
from pyspark.sql import functions as F

from flowsift.functions.hashing import fast_uniform, key_uniform, row_key
from flowsift.operators import sampling


@pytest.fixture(scope="module")
def rows(spark):
    label = F.when(F.col("id") % 100 == 0, "rare").when(F.col("id") % 3 == 0, "mid").otherwise("hot")
    return spark.range(20_000).withColumn("Label", label).persist()


@pytest.fixture(scope="module")
def u(spark):
    return key_uniform(42, "id")


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


@pytest.mark.parametrize("make", [key_uniform, fast_uniform])
def test_uniform_range_and_mean(rows, make):
    u = make(1, "id")
    low, high, mean = rows.agg(F.min(u), F.max(u), F.avg(u)).first()
    assert 0 <= low and high < 1 and abs(mean - 0.5) < 0.01


def test_split_sides_are_disjoint_complete_and_layout_free(rows, u):
    train, test = sampling.split(rows, u)
    assert sorted(ids(train) + ids(test)) == list(range(20_000))
    again, _ = sampling.split(rows.repartition(7), u)
    assert ids(train) == ids(again)
    assert abs(train.count() / 20_000 - 0.8) < 0.01


def test_split_by_row_key_keeps_copies_together(spark):
    df = spark.createDataFrame([(i % 50, float(i % 50)) for i in range(500)], "a int, b double")
    train, test = sampling.split(df, fast_uniform(3, row_key(df)), "a")
    assert not {r["a"] for r in train.collect()} & {r["a"] for r in test.collect()}


@pytest.mark.parametrize("n", [0, 1, 137, 19_999, 50_000])
def test_fixed_size(rows, n, u):
    out = ids(sampling.sample_rows(rows, n, u, ["id"]))
    order = [r["id"] for r in rows.orderBy(u, "id").select("id").collect()]
    assert out == sorted(order[:n])


def test_per_class_cap_takes_exactly_the_lowest(rows, u):
    got = sampling.sample_per_class(rows, 300, u, tie=["id"])
    sizes = {r["Label"]: r["count"] for r in got.groupBy("Label").count().collect()}
    assert sizes == {"rare": 200, "mid": 300, "hot": 300}
    hot = [r["id"] for r in rows.filter("Label = 'hot'").orderBy(u, "id").limit(300).collect()]
    assert ids(got.filter("Label = 'hot'")) == sorted(hot)


def test_coarse_cells_give_the_same_sample(rows, u):
    fine = sampling.lowest_per_group(rows, 50, u, ["Label"], ["id"])
    coarse = sampling.lowest_per_group(rows, 50, u, ["Label"], ["id"], cells=4)
    assert ids(fine) == ids(coarse)


def test_balance_reaches_the_median(rows, u):
    out = sampling.balance(rows, u)
    sizes = {r["Label"]: r["count"] for r in out.groupBy("Label").count().collect()}
    target = rows.filter("Label = 'mid'").count()
    assert sizes["mid"] == target
    assert all(abs(n - target) / target < 0.05 for n in sizes.values())
    assert out.groupBy("id", "copy").count().filter("count > 1").count() == 0


def test_spreading_copies_over_tasks_changes_nothing(rows, monkeypatch, u):
    usual = sampling.balance(rows, u)
    monkeypatch.setattr(sampling, "COPIES_PER_TASK", 5)
    spread = sampling.balance(rows, u)
    key = lambda df: sorted((r["id"], r["copy"]) for r in df.select("id", "copy").collect())
    assert key(usual) == key(spread)


def test_balance_scans_once(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select("l_orderkey", F.col("l_returnflag").alias("Label"))
    plan = sampling.balance(df, key_uniform(1, "l_orderkey"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "SortMergeJoin" not in plan


def test_even_number_of_classes(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] * 8, "Label string")
    assert {r["target"] for r in sampling.class_ratios(df).collect()} == {5}


def test_parts_follow_weights(rows, u):
    sizes = {r["part"]: r["count"] for r in sampling.mark_parts(rows, [2, 1, 1], u).groupBy("part").count().collect()}
    assert abs(sizes[0] / 20_000 - 0.5) < 0.02 and sum(sizes.values()) == 20_000


def test_more_classes_than_a_lookup_holds(rows, monkeypatch, u):
    usual = sampling.balance(rows, u)
    monkeypatch.setattr(sampling, "lookup_side", lambda df: df)
    key = lambda df: sorted((r["id"], r["copy"]) for r in df.select("id", "copy").collect())
    assert key(usual) == key(sampling.balance(rows, u))
