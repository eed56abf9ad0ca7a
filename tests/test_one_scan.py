"""Moments and samples from one read, quantiles that a bracket missed."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowsift.functions.hashing import fast_uniform
from flowsift.operators import moments, quantiles, sampling


def scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("rows") / "t")
    u = fast_uniform(1, "id")
    spark.range(0, 20000, 1, 6).select(
        "id", F.when(u < 0.5, "hot").otherwise(F.concat(F.lit("c"), (F.col("id") % 40).cast("string"))).alias("Label"), (u * 100).alias("x")
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_correlation_of_large_values_with_little_spread(spark, tmp_path):
    rng = np.random.default_rng(1)
    a = rng.normal(size=5000)
    table = np.column_stack([1e9 + a, -3e9 + 0.5 * a + rng.normal(size=5000), rng.normal(size=5000), np.full(5000, 1e9 + 0.1)])
    rows = [(*map(float, r[:2]), None if i % 7 == 0 else float(r[2]), float(r[3])) for i, r in enumerate(table)]
    spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(9).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    assert scans(moments.pair_moments(df, ["a", "b", "c"])) == 1
    found = {(r["x"], r["y"]): r["r"] for r in moments.correlation(df, ["a", "b", "c", "d"]).collect()}
    there = np.arange(5000) % 7 != 0
    for x, y, keep in ((0, 1, slice(None)), (0, 2, there), (1, 2, there)):
        wanted = np.corrcoef(table[keep, x].astype(np.longdouble) - table[0, x], table[keep, y].astype(np.longdouble) - table[0, y])[0, 1]
        assert abs(found["abc"[x], "abc"[y]] - float(wanted)) < 1e-9
    assert found["a", "d"] is None and found["a", "a"] == 1.0


def test_moments_do_not_depend_on_the_parts(spark, stored):
    one = {(r.i, r.j): r for r in moments.pair_moments(stored.coalesce(1), ["id", "x"]).collect()}
    many = {(r.i, r.j): r for r in moments.pair_moments(stored.repartition(23), ["id", "x"]).collect()}
    for key, row in one.items():
        assert np.allclose(list(row)[2:], list(many[key])[2:], rtol=1e-12)


@pytest.mark.parametrize("by", [(), ("Label",)])
def test_samples_from_one_scan(stored, by):
    u = fast_uniform(9, "id")
    found = sampling.lowest_per_group(stored, 30, u, by, ["id"])
    assert scans(found) == 1
    counted = sampling.lowest_per_group(stored, 30, u, by, ["id"], cells=500)
    assert sorted(found.collect()) == sorted(counted.collect())
    assert sorted(found.repartition(3).collect()) == sorted(sampling.lowest_per_group(stored.repartition(11), 30, u, by, ["id"]).collect())
    assert found.columns == stored.columns


def test_a_task_hands_on_no_more_than_the_sample(stored):
    plan = sampling.lowest_per_group(stored, 30, fast_uniform(9, "id"), ["Label"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.mark.parametrize("probs", [(0.0, 0.31, 0.5, 1.0), tuple(i / 40 for i in range(41))])
@pytest.mark.parametrize("by", [(), ("Label",)])
def test_missed_ranks_are_found_again(stored, monkeypatch, probs, by):
    rows = stored.toPandas()
    rounds = []
    inner = quantiles._around_ranks
    monkeypatch.setattr(quantiles, "_around_ranks", lambda *a: rounds.append(a[-1]) or inner(*a))
    # brackets of no width at all around what a coarse sketch says
    monkeypatch.setattr(quantiles, "MARGIN", 0.0)
    found = quantiles.quantiles_long(stored, ["x", "id"], probs, by, accuracy=20).collect()
    assert len(rounds) > 1
    for r in found:
        part = rows if not by else rows[rows["Label"] == r["Label"]]
        assert r["value"] == pytest.approx(np.quantile(part[r["column"]], r["prob"]), rel=1e-12)
    assert len(found) == 2 * len(probs) * (1 if not by else rows["Label"].nunique())


def test_bisection_counts_edges(spark):
    edges = [-np.inf, 1.0, 1.0, 2.5, 2.5, 2.5, 7.0, np.inf]
    values = [-5.0, 1.0, 1.5, 2.5, 6.9, 7.0, 1e300]
    array = F.lit(np.array(edges))
    df = spark.createDataFrame([(v,) for v in values], "v double")
    below = quantiles._bisect(len(edges), array, lambda e: e <= F.col("v"))
    above = quantiles._bisect(len(edges), array, lambda e: e < F.col("v"))
    found = df.select(below, above).collect()
    assert [tuple(r) for r in found] == [(sum(e <= v for e in edges), sum(e < v for e in edges)) for v in values]
