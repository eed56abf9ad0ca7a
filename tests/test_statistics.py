import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowsift.functions.columns import number_or_zero
from flowsift.operators import distribution as dist
from flowsift.operators import classes, features, moments, quantiles
from flowsift.operators.quantiles import quantiles as exact

PROBS = {"p0": 0.0, "a": 0.005, "q1": 0.25, "m": 0.5, "q3": 0.75, "z": 0.995, "p1": 1.0}


@pytest.fixture(scope="module")
def skewed(spark):
    """One group with most of the rows, ties, heavy tails, nulls and NaN, and a null group."""
    rng = np.random.default_rng(3)
    rows = []
    for group, n in (("hot", 30_000), ("small", 101), ("one", 1), (None, 50)):
        values = np.where(rng.random(n) < 0.4, 7.0, np.exp(rng.normal(0, 6, n)))
        rows += [(group, float(v)) for v in values]
    rows += [("hot", None), ("hot", math.nan), ("none", None)]
    return spark.createDataFrame(rows, "g string, v double").repartition(5).persist()


def _brute(df):
    by_group = {}
    for g, v in df.collect():
        if v is not None and not math.isnan(v):
            by_group.setdefault(g, []).append(v)
    return {g: {k: float(np.quantile(vs, p)) for k, p in PROBS.items()} for g, vs in by_group.items()}


@pytest.mark.parametrize("accuracy", [None, 50])
def test_grouped_quantiles_are_exact(skewed, accuracy):
    want = _brute(skewed)
    got = {r["g"]: r for r in exact(skewed, ["v"], PROBS, by=["g"], accuracy=accuracy).collect()}
    assert set(got) == set(want)
    for g, values in want.items():
        for k, v in values.items():
            assert got[g][k] == pytest.approx(v, rel=1e-12)


def test_more_groups_than_a_lookup_holds(skewed, monkeypatch):
    monkeypatch.setattr(quantiles, "fetch_small", lambda df: None)
    want = _brute(skewed)
    got = {r["g"]: r["m"] for r in exact(skewed, ["v"], {"m": 0.5}, by=["g"]).collect()}
    assert got == pytest.approx({g: v["m"] for g, v in want.items()})


@pytest.mark.parametrize("many", [False, True])
def test_whole_column_quantiles(skewed, many, monkeypatch):
    if many:
        monkeypatch.setattr(quantiles, "UNROLLED_PROBS", 0)
    values = [r[1] for r in skewed.collect() if r[1] is not None and not math.isnan(r[1])]
    got = exact(skewed, ["v"], PROBS).first()
    for k, p in PROBS.items():
        assert got[k] == pytest.approx(float(np.quantile(values, p)), rel=1e-12)
    assert got["n"] == len(values)


def test_narrow_brackets_are_still_exact(skewed):
    hot = skewed.filter("g = 'hot'")
    out = exact(hot, ["v"], {"m": 0.9}, accuracy=500)
    assert out.first()["m"] == pytest.approx(float(np.quantile([r["v"] for r in hot.filter("not isnan(v)").collect() if r["v"] is not None], 0.9)))


def test_histogram_keeps_all_rows_and_integrates_to_one(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)] + [(None,), (math.nan,), (math.inf,)], "v double")
    rows = dist.histogram(df, "v", 10).orderBy("bin").collect()
    assert [r["n_rows"] for r in rows] == [10] * 9 + [11]
    assert sum(r["density"] * (r["high"] - r["low"]) for r in rows) == pytest.approx(1.0)


def test_constant_histogram(spark):
    rows = dist.histogram(spark.createDataFrame([(5.0,)] * 4, "v double"), "v", 4).collect()
    assert sum(r["n_rows"] for r in rows) == 4


def test_density_close_to_the_unbinned_kernel(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, 2000)
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    got = sorted((r["x"], r["density"]) for r in dist.density(df, "v", grid=50).collect())
    width = x.std(ddof=1) * len(x) ** -0.2
    for at, value in got:
        exact_value = np.exp(-0.5 * ((at - x) / width) ** 2).sum() / (len(x) * width * math.sqrt(2 * math.pi))
        assert value == pytest.approx(exact_value, rel=1e-8, abs=1e-12)


def test_density_with_one_far_outlier(spark):
    x = np.append(np.random.default_rng(2).normal(0, 1, 20_000), 1000.0)
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    got = sorted((r["x"], r["density"]) for r in dist.density(df, "v", grid=2001).collect())
    width = x.std(ddof=1) * len(x) ** -0.2
    near = [(at, value) for at, value in got if abs(at) < 6]
    assert len(got) == 2001 and near
    for at, value in near:
        exact_value = np.exp(-0.5 * ((at - x) / width) ** 2).sum() / (len(x) * width * math.sqrt(2 * math.pi))
        assert value == pytest.approx(exact_value, rel=1e-6)


def test_infinities_and_nan_are_no_numbers(spark):
    rows = [("a", float(i), float(-i)) for i in range(10)] + [("a", math.inf, 1.0)] * 10 + [("a", math.nan, 2.0), ("a", None, 3.0)]
    df = spark.createDataFrame(rows, "Label string, v double, w double")
    box = dist.box_stats(df, ["v"]).first()
    assert (box["median"], box["n_rows"], box["n_outliers"]) == (4.5, 10, 0)
    mean = classes.class_mean_std(df, ["v"]).first()
    assert mean["mean"] == 4.5 and mean["stddev"] == pytest.approx(np.arange(10).std(ddof=1))
    ellipse = dist.class_ellipse(df, "v", "w").first()
    assert (ellipse["n_rows"], ellipse["centre_x"]) == (10, 4.5) and ellipse["radius_x"] == pytest.approx(0, abs=1e-6)
    text = spark.createDataFrame([("nan",), ("x",), (None,), ("2",)], "s string")
    assert [r[0] for r in text.select(number_or_zero(text["s"])).collect()] == [0, 0, 0, 2]


def test_principal_components_like_numpy(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (500, 4)) @ rng.normal(0, 1, (4, 4))
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)] + [(900, None, 1.0, 1.0, 1.0)], "i int, a double, b double, c double, d double")
    names = ["a", "b", "c", "d"]
    z = (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)
    _, s, vt = np.linalg.svd(z, full_matrices=False)
    scree = [r["explained"] for r in features.pca_scree(df, names).collect()]
    assert scree == pytest.approx(s**2 / (s**2).sum())
    got = np.array([[r["pc1"], r["pc2"]] for r in features.pca_project(df, names, ["i"]).orderBy("i").collect()])
    assert got.shape == (500, 2) and np.abs(got) == pytest.approx(np.abs(z @ vt[:2].T), abs=1e-8)


def test_ridge_passes_over_small_classes(spark):
    rows = [("a", float(i)) for i in range(100)] + [("b", float(i)) for i in range(5)]
    df = spark.createDataFrame(rows, "Label string, v double")
    assert {r["Label"] for r in dist.ridge(df, "v", grid=5).collect()} == {"a"}


def test_box_stats_against_hand_values(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 5, 100]], "v double")
    row = dist.box_stats(df, ["v"]).first()
    assert (row["q1"], row["median"], row["q3"]) == (2.25, 3.5, 4.75)
    assert (row["whisker_low"], row["whisker_high"], row["n_outliers"]) == (1.0, 5.0, 1)


def test_correlation_with_gaps_and_constants(spark):
    rng = np.random.default_rng(5)
    a = rng.normal(1e6, 1, 500)
    b = a * 2 + rng.normal(0, 1, 500)
    rows = [(float(x), float(y) if i % 7 else None, 3.0) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "a double, b double, k double").repartition(4)
    got = {(r["x"], r["y"]): r["r"] for r in moments.correlation(df, ["a", "b", "k"]).collect()}
    keep = np.arange(500) % 7 != 0
    assert got["a", "b"] == pytest.approx(np.corrcoef(a[keep], b[keep])[0, 1], abs=1e-9)
    assert got["a", "k"] is None and got["a", "a"] == 1.0 and got["b", "a"] == got["a", "b"]


def test_later_column_goes_even_if_its_partner_goes(spark):
    rows = [(float(i), float(i) * 2, float(i) * 3 + 1, float((i * 7) % 11)) for i in range(50)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    assert features.prune_correlated(df, ["a", "b", "c", "d"]) == ["a", "d"]


@pytest.mark.parametrize("k", [3, 12])
def test_gram_and_vif_against_numpy(spark, k):
    rng = np.random.default_rng(2)
    x = rng.normal(1, 1, (300, k))
    x[:, 2] = x[:, 0] + x[:, 1] + rng.normal(0, 0.1, 300)
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], [f"c{i}" for i in range(k)])
    g = x.T @ x
    for r in moments.gram(df, df.columns).collect():
        assert r["g"] == pytest.approx(g[r["i"], r["j"]], rel=1e-9)
    want = np.diag(g) * np.diag(np.linalg.inv(g))
    got = {r["feature"]: r["vif"] for r in features.vif(df, df.columns).collect()}
    for i in range(k):
        assert got[f"c{i}"] == pytest.approx(want[i], rel=1e-6)


def test_vif_of_collinear_columns_is_infinite(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, float(i % 3)) for i in range(1, 40)], "a double, b double, c double")
    got = {r["feature"]: r["vif"] for r in features.vif(df, ["a", "b", "c"]).collect()}
    assert math.isinf(got["a"]) and math.isinf(got["b"]) and math.isfinite(got["c"])


@pytest.mark.parametrize(
    "f, d1, d2, p",
    [(4.256495, 2, 9, 0.05), (1.0, 5, 5, 0.5), (161.4476, 1, 1, 0.05), (2.866081, 4, 20, 0.05), (0.0, 3, 8, 1.0)],
)
def test_f_tail_against_table_values(spark, f, d1, d2, p):
    df = spark.createDataFrame([(f, float(d1), float(d2))], "f double, a double, b double")
    assert df.select(features.f_tail(F.col("f"), F.col("a"), F.col("b"))).first()[0] == pytest.approx(p, abs=2e-6)


def test_anova_by_hand(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 4.0), ("b", 6.0)], "Label string, v double")
    row = features.anova_f(df, ["v"]).first()
    assert row["f_score"] == pytest.approx(12.25 / 1.25)


def test_pca_shares(spark):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([tuple(map(float, r)) for r in rng.normal(0, 1, (200, 4))], list("abcd"))
    rows = features.pca_scree(df, list("abcd")).orderBy("component").collect()
    shares = [r["explained"] for r in rows]
    assert sum(shares) == pytest.approx(1.0) and shares == sorted(shares, reverse=True)
    assert sum(r["reaches_share"] for r in rows) == 1


def test_robust_scale_clips(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)] + [(1e9,)], "v double")
    assert dist.robust_scale(df, ["v"]).agg(F.max("v")).first()[0] == 5.0


def test_ellipse_needs_three_rows(spark):
    rows = [("a", float(i), float(i)) for i in range(60)] + [("b", 1.0, 2.0)] * 2
    out = dist.class_ellipse(spark.createDataFrame(rows, "Label string, x double, y double"), "x", "y").collect()
    assert len(out) == 1 and out[0]["drawn"] and out[0]["radius_x"] == pytest.approx(math.sqrt(2))
