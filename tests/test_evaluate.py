import numpy as np
import pytest

from flowsift.operators import evaluate, runlog


@pytest.fixture(scope="module")
def scores(spark):
    """Scores crowded near zero with ties, one class without positives."""
    rng = np.random.default_rng(8)
    rows = []
    for _ in range(4000):
        y = int(rng.integers(0, 3))
        s = [float(np.round(rng.random() ** 9 * (1.5 if k == y else 1.0), 5)) for k in range(4)]
        rows.append((float(y), s))
    return rows, spark.createDataFrame(rows, "label_index double, scores array<double>")


def _brute(rows, k):
    y = np.array([r[0] == k for r in rows])
    s = np.array([r[1][k] for r in rows])
    tp = fp = 0
    auc = ap = 0.0
    pos, neg = y.sum(), (~y).sum()
    for value in sorted(set(s), reverse=True):
        here = s == value
        p, n = (y & here).sum(), (~y & here).sum()
        tp, fp = tp + p, fp + n
        auc += n * (2 * tp - p) / 2
        ap += p * tp / (tp + fp)
    return auc / (pos * neg), ap / pos


@pytest.mark.parametrize("ranges", [1, 7, 256])
def test_auc_and_ap(scores, ranges):
    rows, df = scores
    ranked = evaluate.ranked_scores(evaluate.scores_long(df, "scores"), ranges=ranges)
    auc = {r["class"]: r["auc"] for r in evaluate.roc_auc(ranked).collect()}
    ap = {r["class"]: r["ap"] for r in evaluate.average_precision(ranked).collect()}
    for k in range(3):
        want = _brute(rows, k)
        assert auc[k] == pytest.approx(want[0], abs=1e-12) and ap[k] == pytest.approx(want[1], abs=1e-12)
    assert auc[3] is None and ap[3] is None


def test_scores_that_are_no_numbers_are_an_error(spark):
    for bad in (float("nan"), None):
        df = spark.createDataFrame([(0.0, [0.1, 0.9]), (1.0, [bad, 0.5])], "label_index double, scores array<double>")
        with pytest.raises(Exception, match="null or NaN"):
            evaluate.ranked_scores(evaluate.scores_long(df, "scores")).collect()


def test_curves_end_where_they_should(scores):
    _, df = scores
    ranked = evaluate.ranked_scores(evaluate.scores_long(df, "scores"))
    roc = [(r["fpr"], r["tpr"]) for r in evaluate.roc_points(ranked).filter("class = 0").collect()]
    assert (0.0, 0.0) in roc and (1.0, 1.0) in roc
    pr = [(r["recall"], r["precision"]) for r in evaluate.pr_points(ranked).filter("class = 0").collect()]
    assert (0.0, 1.0) in pr and max(r for r, _ in pr) == 1.0


def test_report_on_a_small_case(spark):
    rows = [(0.0, 0.0)] * 3 + [(0.0, 1.0)] + [(1.0, 1.0)] * 2 + [(2.0, 0.0)]
    df = spark.createDataFrame(rows, "label_index double, prediction double")
    counts = evaluate.confusion_counts(df)
    report = {r["class"]: r for r in evaluate.per_class(counts).collect()}
    assert report[0.0]["precision"] == 0.75 and report[0.0]["recall"] == 0.75
    assert report[2.0]["f1"] == 0.0 and report[2.0]["precision"] == 0.0
    total = evaluate.averages(evaluate.per_class(counts)).first()
    assert total["accuracy"] == pytest.approx(5 / 7) and total["weighted_recall"] == pytest.approx(total["accuracy"])
    matrix = evaluate.confusion(df).collect()
    assert len(matrix) == 9 and sum(r["n_rows"] for r in matrix) == 7
    top = evaluate.top_confusions(counts).collect()
    assert [(r["actual"], r["predicted"], r["pct_of_actual"]) for r in top] == [(0.0, 1.0, 25.0), (2.0, 0.0, 100.0)]


def test_same_as_spark_ml(spark):
    from flowsift.operators.training import evaluator

    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in rng.integers(0, 4, (500, 2))], "label_index double, prediction double")
    ours = evaluate.global_metrics(evaluate.confusion_counts(df)).first().asDict()
    for metric, value in ours.items():
        assert value == pytest.approx(evaluator(metric).evaluate(df))


# Published run times (threads, seconds) and the figures published for them.
RF = [(8, 64.9), (16, 46.94), (32, 39.15), (64, 46.54)]
GBT = [(8, 3573.87), (16, 3116.45), (32, 3412.76), (64, 4824.06)]


def test_published_speedups(spark):
    rows = [("rf", n, t) for n, t in RF] + [("gbt", n, t) for n, t in GBT] + [("slow", 8, 1.0), ("slow", 16, 2.0)]
    speeds = runlog.speedup(spark.createDataFrame(rows, "model string, n_threads int, time double"))
    got = {(r["model"], r["n_threads"]): (round(r["speedup"], 6), r["efficiency"]) for r in speeds.collect()}
    assert got["rf", 32] == (1.657727, 41.44) and got["gbt", 16] == (1.146776, 57.34) and got["gbt", 64] == (0.740843, 9.26)
    laws = {r["model"]: (r["p"], r["alpha"], r["max_speedup"]) for r in runlog.amdahl(speeds).collect()}
    assert laws == {"rf": (0.529, 0.471, 2.12), "gbt": (0.256, 0.744, 1.34)}


def test_published_volume_ratio(spark):
    rows = [("rf", 0.1, 30.96), ("rf", 0.5, 38.01), ("rf", 1.0, 44.59), ("gbt", 1.0, 4782.11), ("gbt", 0.1, 3209.49)]
    out = {r["model"]: round(r["time_growth"], 1) for r in runlog.volume_ratio(spark.createDataFrame(rows, "model string, frac double, time double")).collect()}
    assert out == {"rf": 1.4, "gbt": 1.5}
