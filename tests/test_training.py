"""Fits: stored sides, sized memory, grids side by side, nested shares."""

import re
import threading
import time

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from flowsift.functions.hashing import fast_uniform
from flowsift.operators import features, training
from flowsift.queries import REGISTRY
from flowsift.session import temporary_tables
from oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    x = [fast_uniform(k, "id") for k in range(4)]
    label = F.when(x[0] > 0.6, 2.0).when(x[1] > 0.5, 1.0).otherwise(0.0)
    return training.store_for_fit(
        spark.range(4000).select("id", label.alias("label_index"), array_to_vector(F.array(*x)).alias("features")), "rows", tasks=1
    )


def test_stored_sides_are_even(spark, monkeypatch):
    monkeypatch.setattr(training, "FIT_TASK_ROWS", (100, 4_000_000))
    one = spark.range(0, 5000, 1, 1)
    stored = training.store_for_fit(one)
    sizes = [r["count"] for r in stored.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == spark.sparkContext.defaultParallelism and max(sizes) <= 1.05 * min(sizes)
    assert stored.rdd.getNumPartitions() == len(sizes)
    monkeypatch.setattr(training, "FIT_TASK_ROWS", (100, 300))  # long tables get more tasks than cores
    assert training.store_for_fit(one).select(F.input_file_name()).distinct().count() == 17
    assert training.store_for_fit(one.limit(0)).count() == 0


def test_fit_memory_follows_the_widest_level():
    # 45 features, 15 classes, 16 bins: 7 candidates a node, 8 * 7 * 16 * 16 bytes
    assert training.node_bytes(45, 15, 16) == 8 * 7 * 16 * 16
    memory, passes = training.fit_memory(45, 15, trees=200, depth=10, bins=16, most_mb=4096)
    assert passes == 10 and memory > 1400  # one pass a level
    small, more = training.fit_memory(45, 15, trees=200, depth=10, bins=16, most_mb=256)
    assert small == 256 and more == 10 + 1 + 2 + 5 - 0 or more > passes
    assert training.fit_memory(4, 3, trees=5, depth=3, bins=16) == (256, 3)


def test_sized_forest_fits_the_same_trees(rows):
    plain = training.random_forest(numTrees=6, maxDepth=4).fit(rows)
    sized = training.sized_forest(rows, numTrees=6, maxDepth=4)
    assert sized.getMaxMemoryInMB() == 256
    assert sized.fit(rows).toDebugString.split("\n")[1:] == plain.toDebugString.split("\n")[1:]
    with pytest.raises(ValueError):
        training.sized_forest(rows.limit(0))


def test_grid_side_by_side_equals_one_by_one(rows):
    grid = {"numTrees": (3, 6), "maxDepth": (2, 4)}
    tables = [training.tune_forest(rows, fast_uniform(1, "id"), grid=grid, at_once=n)[1].collect() for n in (1, 4)]
    key = lambda r: (r["numTrees"], r["maxDepth"])
    assert sorted(tables[0], key=key) == sorted(tables[1], key=key) and len(tables[0]) == 4
    small = {"maxIter": (1, 2), "maxDepth": (2,), "stepSize": (0.1,)}
    gbt = [training.tune_gbt(rows, fast_uniform(1, "id"), grid=small, at_once=n)[1].drop("seconds").collect() for n in (1, 2)]
    assert sorted(gbt[0]) == sorted(gbt[1])


def test_grid_keeps_order_and_bounds_what_runs(spark):
    running, most, lock = [0], [0], threading.Lock()

    def job(i):
        with lock:
            running[0] += 1
            most[0] = max(most[0], running[0])
        time.sleep(0.05)
        n = spark.range(i).count()
        with lock:
            running[0] -= 1
        return n

    assert training.run_grid(spark, [lambda i=i: job(i) for i in range(7)], at_once=3) == list(range(7))
    assert 1 < most[0] <= 3
    assert not len(spark.sparkContext.getJobTags())


def test_grid_ends_with_the_first_error(spark):
    started = []

    def slow():
        started.append("slow")
        # a job that would run for minutes
        return spark.range(0, 10**12, 1, 2).selectExpr("sum(hash(id))").collect()

    def broken():
        time.sleep(1.5)
        raise ValueError("no such combination")

    begin = time.monotonic()
    with pytest.raises(ValueError, match="no such combination"):
        training.run_grid(spark, [slow, broken, lambda: started.append("late")], at_once=2)
    assert time.monotonic() - begin < 60 and started == ["slow"]


def test_shares_are_nested_and_pruned(spark, rows):
    fractions = (0.1, 0.25, 1.0)
    u = fast_uniform(4, "id")
    shares = training.nested_shares(rows, fractions, u)
    for fraction, part in zip(fractions, shares):
        assert sorted(part.collect()) == sorted(rows.filter(u < fraction).collect())
    plan = shares[0]._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*_share#\d+ <= 0", plan)
    read = [part.select(F.input_file_name()).distinct().count() for part in shares]
    assert read[0] < read[1] < read[2]


def test_learning_curve(rows):
    makers = {"rf": lambda: training.random_forest(numTrees=3, maxDepth=3)}
    curve = training.learning_curve(rows, rows, fast_uniform(4, "id"), makers, (0.2, 1.0)).collect()
    assert [r["frac"] for r in curve] == [0.2, 1.0] and curve[1]["n"] == 4000 and curve[0]["n"] < 1000


def longest_part(df):
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


def sides_of(monkeypatch, module, limit, n_features, trees):
    """The sides that `module` stores from now on, under a limit of `limit` points of that size a task."""
    monkeypatch.setattr(training, "FIT_TASK_ROWS", (10, 4_000_000))
    monkeypatch.setattr(training, "FIT_TASK_BYTES", limit * training.point_bytes(n_features, trees))
    sides, store = [], training.store_for_fit

    def watched(*args, **kwargs):
        sides.append(store(*args, **kwargs))
        return sides[-1]

    monkeypatch.setattr(module, "store_for_fit", watched)
    return sides


def test_parts_of_a_long_side_are_read_apart(spark, monkeypatch):
    monkeypatch.setattr(training, "FIT_TASK_ROWS", (100, 300))
    stored = training.store_for_fit(spark.range(0, 5000, 1, 1))  # 17 files, which the reader would put into 8 tasks
    assert longest_part(stored) <= 300 and stored.columns == ["id"]
    assert sorted(r["id"] for r in stored.collect()) == list(range(5000))
    with temporary_tables(spark) as scope:
        stored = training.store_for_fit(spark.range(5000))
        scope.drop(stored)
        assert not scope.folders


def test_parts_follow_the_size_of_points():
    assert training.fit_parts(600_000, 8, training.point_bytes(7, 30)) == 8  # short tables: one part a core, as before
    for trees in (1, 30, 200):
        each = training.point_bytes(45, trees)
        parts = training.fit_parts(216_000_000, 12, each)
        assert 216_000_000 / parts * each <= 128 * 2**20 and parts > 54


def test_ranking_reads_bounded_parts(spark, monkeypatch):
    sides = sides_of(monkeypatch, features, 400, 7, 30)
    assert REGISTRY["feat_rf_importance"].run(spark, FOLDER).count() == 7
    (side,) = sides
    assert side.count() == spark.read.parquet(f"{FOLDER}/lineitem.parquet").count() and longest_part(side) <= 400


def test_method_table_reads_bounded_parts(spark, monkeypatch):
    sides = sides_of(monkeypatch, features, 500, 6, 5)
    assert REGISTRY["feat_method_table_full"].run(spark, FOLDER).filter("rf_rank is not null").count() == 6
    (side,) = sides
    assert side.count() == spark.read.parquet(f"{FOLDER}/lineitem.parquet").count() and longest_part(side) <= 500


@pytest.mark.parametrize("name", ["feat_tree_importance", "ml_tree_predict", "ml_boosted_stumps"])
def test_trees_over_many_parts_equal_sql(spark, monkeypatch, name):
    sides = sides_of(monkeypatch, training, 450, 5, 1)
    assert compare(spark, connect(FOLDER), REGISTRY[name], FOLDER) is None
    (side,) = sides
    assert side.rdd.getNumPartitions() > 8 and 300 < longest_part(side) <= 450


def test_long_shares_are_read_apart(spark, monkeypatch, rows):
    monkeypatch.setattr(training, "FIT_TASK_ROWS", (10, 130))
    u = fast_uniform(4, "id")
    for fraction, part in zip((0.5, 1.0), training.nested_shares(rows, (0.5, 1.0), u)):
        assert sorted(part.collect()) == sorted(rows.filter(u < fraction).collect())
        assert longest_part(part) <= 200  # dealt by a hash: about 130


def test_grid_fits_read_bounded_parts(spark, monkeypatch, rows):
    sides = sides_of(monkeypatch, training, 100, 4, 6)
    training.tune_forest(rows, fast_uniform(1, "id"), grid={"numTrees": (3, 6), "maxDepth": (2,)})
    training.tune_gbt(rows, fast_uniform(1, "id"), grid={"maxIter": (1,), "maxDepth": (2,), "stepSize": (0.1,)})
    assert len(sides) == 3 and all(0 < longest_part(side) <= 120 for side in sides)
