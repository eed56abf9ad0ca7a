"""Evaluation of predictions."""

from pyspark.sql import functions as F

from flowsift.operators import evaluate
from flowsift.queries.registry import query, rounded
from flowsift.queries.views import BOTH_SQL, N_CLASSES, both_models, over, scored, scored_sql

SCORED_SQL = scored_sql()
_LONG = (
    SCORED_SQL
    + ", lng AS ("
    + " UNION ALL ".join(
        f"SELECT {k}::INT AS class, s{k} AS score, (label_index = {k})::INT AS pos FROM scored" for k in range(N_CLASSES)
    )
    + """), pts AS (SELECT class, score, sum(pos) AS pos, sum(1 - pos) AS neg FROM lng GROUP BY 1, 2),
    cum AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY class) AS np,
              sum(neg) OVER (PARTITION BY class) AS nn FROM pts WINDOW w AS (PARTITION BY class ORDER BY score DESC))"""
)
_CM = "cm AS (SELECT label_index AS actual, prediction AS predicted, count(*) AS n_rows FROM {} GROUP BY 1, 2)"


def _report_sql(source: str, key: str = "") -> str:
    """Per-class report from rows (key, label_index, prediction)."""
    k, j = (f"{key}, ", f"{key}, ") if key else ("", "")
    return f"""
    act AS (SELECT {k}label_index AS class, count(*) AS support, count_if(label_index = prediction) AS hit FROM {source} GROUP BY ALL),
    prd AS (SELECT {k}prediction AS class, count(*) AS guessed FROM {source} GROUP BY ALL),
    rep0 AS (SELECT {k}class, coalesce(support, 0) AS support, coalesce(hit, 0) AS hit, coalesce(guessed, 0) AS guessed
             FROM act FULL JOIN prd USING ({j}class)),
    rep1 AS (SELECT *, coalesce(hit::DOUBLE / nullif(guessed, 0), 0) AS p, coalesce(hit::DOUBLE / nullif(support, 0), 0) AS r FROM rep0),
    rep AS (SELECT *, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f FROM rep1)"""


def _scored(spark, folder):
    return scored(spark, folder)


def _counts(spark, folder):
    return evaluate.confusion_counts(scored(spark, folder))


def _both(spark, folder):
    rows = both_models(spark, folder)
    return rows.groupBy("model", F.col("label_index").alias("actual"), F.col("prediction").alias("predicted")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def _ranked(spark, folder):
    return evaluate.ranked_scores(evaluate.scores_long(scored(spark, folder), "scores"))


_GLOBAL = """round(sum(hit) / sum(support), 8) AS accuracy, round(sum(f * support) / sum(support), 8) AS f1,
    round(sum(p * support) / sum(support), 8) AS "weightedPrecision", round(sum(r * support) / sum(support), 8) AS "weightedRecall" """
_GLOBAL_NAMES = ["accuracy", "f1", "weightedPrecision", "weightedRecall"]


@query("eval_global", over(SCORED_SQL + "," + _report_sql("scored"), f"SELECT {_GLOBAL} FROM rep"))
def eval_global(spark, folder):
    return rounded(evaluate.global_metrics(_counts(spark, folder)), 8, *_GLOBAL_NAMES)


@query(
    "eval_per_class",
    over(
        SCORED_SQL + "," + _report_sql("scored"),
        'SELECT class, round(p, 8) AS "precision", round(r, 8) AS recall, round(f, 8) AS f1, support::BIGINT AS support, hit::BIGINT AS n_correct FROM rep',
    ),
)
def eval_per_class(spark, folder):
    return rounded(evaluate.per_class(_counts(spark, folder)), 8, "precision", "recall", "f1")


@query(
    "eval_averages",
    over(
        SCORED_SQL + "," + _report_sql("scored"),
        """SELECT round(sum(hit) / sum(support), 8) AS accuracy, round(avg(p), 8) AS macro_precision, round(avg(r), 8) AS macro_recall,
             round(avg(f), 8) AS macro_f1, round(sum(p * support) / sum(support), 8) AS weighted_precision,
             round(sum(r * support) / sum(support), 8) AS weighted_recall, round(sum(f * support) / sum(support), 8) AS weighted_f1,
             sum(support)::BIGINT AS support FROM rep""",
    ),
)
def eval_averages(spark, folder):
    out = evaluate.averages(evaluate.per_class(_counts(spark, folder)))
    return rounded(out, 8, *[n for n in out.columns if n != "support"])


_FULL_CM = """, cls AS (SELECT DISTINCT actual AS c FROM cm UNION SELECT DISTINCT predicted FROM cm),
    full_cm AS (SELECT a.c AS actual, b.c AS predicted, coalesce(n_rows, 0) AS n_rows
      FROM cls a CROSS JOIN cls b LEFT JOIN cm ON cm.actual = a.c AND cm.predicted = b.c)"""


@query("eval_confusion", over(SCORED_SQL + "," + _CM.format("scored"), _FULL_CM + " SELECT * FROM full_cm"))
def eval_confusion(spark, folder):
    return evaluate.confusion(scored(spark, folder)).drop("share")


@query(
    "eval_confusion_norm",
    over(
        SCORED_SQL + "," + _CM.format("scored"),
        _FULL_CM
        + " SELECT actual, predicted, round(n_rows::DOUBLE / sum(n_rows) OVER (PARTITION BY actual), 8) AS share FROM full_cm",
    ),
)
def eval_confusion_norm(spark, folder):
    return rounded(evaluate.confusion(scored(spark, folder)), 8, "share").drop("n_rows")


@query(
    "eval_top_confusions",
    over(
        SCORED_SQL + "," + _CM.format("scored"),
        """SELECT * FROM (SELECT *, round(n_rows * 100.0::DOUBLE / sum(n_rows) OVER (PARTITION BY actual), 2) AS pct_of_actual FROM cm)
           WHERE actual <> predicted ORDER BY n_rows DESC, actual, predicted LIMIT 15""",
    ),
)
def eval_top_confusions(spark, folder):
    return evaluate.top_confusions(_counts(spark, folder))


@query(
    "eval_roc_points",
    over(
        _LONG,
        """SELECT class, score AS threshold, round(fp / nn, 8) AS fpr, round(tp / np, 8) AS tpr FROM cum
           UNION ALL SELECT DISTINCT class, 'Infinity'::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE FROM cum""",
    ),
)
def eval_roc_points(spark, folder):
    return rounded(evaluate.roc_points(_ranked(spark, folder)), 8, "fpr", "tpr")


@query(
    "eval_auc",
    over(
        _LONG,
        """, st AS (SELECT *, lag(tp, 1, 0) OVER w AS tp0, lag(fp, 1, 0) OVER w AS fp0 FROM cum WINDOW w AS (PARTITION BY class ORDER BY score DESC))
        SELECT class, round(sum((fp - fp0) / nn * (tp + tp0) / np / 2), 8) AS auc FROM st GROUP BY 1""",
    ),
)
def eval_auc(spark, folder):
    return rounded(evaluate.roc_auc(_ranked(spark, folder)), 8, "auc")


@query(
    "eval_auc_macro",
    over(
        _LONG,
        """, st AS (SELECT *, lag(tp, 1, 0) OVER w AS tp0, lag(fp, 1, 0) OVER w AS fp0 FROM cum WINDOW w AS (PARTITION BY class ORDER BY score DESC)),
        a AS (SELECT class, sum((fp - fp0) / nn * (tp + tp0) / np / 2) AS auc FROM st GROUP BY 1)
        SELECT round(avg(auc), 8) AS macro_auc, count(*) AS n_classes FROM a""",
    ),
)
def eval_auc_macro(spark, folder):
    return rounded(evaluate.macro(evaluate.roc_auc(_ranked(spark, folder)), "auc"), 8, "macro_auc")


@query(
    "eval_pr_points",
    over(
        _LONG,
        """SELECT class, score AS threshold, round(tp / (tp + fp), 8) AS "precision", round(tp / np, 8) AS recall FROM cum
           UNION ALL SELECT DISTINCT class, 'Infinity'::DOUBLE, 1.0::DOUBLE, 0.0::DOUBLE FROM cum""",
    ),
)
def eval_pr_points(spark, folder):
    return rounded(evaluate.pr_points(_ranked(spark, folder)), 8, "precision", "recall")


_AP = "SELECT class, sum(pos / np * (tp / (tp + fp))) AS ap FROM cum GROUP BY 1"


@query("eval_average_precision", over(_LONG, f"SELECT class, round(ap, 8) AS ap FROM ({_AP})"))
def eval_average_precision(spark, folder):
    return rounded(evaluate.average_precision(_ranked(spark, folder)), 8, "ap")


@query("eval_average_precision_macro", over(_LONG, f"SELECT round(avg(ap), 8) AS macro_ap, count(*) AS n_classes FROM ({_AP})"))
def eval_average_precision_macro(spark, folder):
    return rounded(evaluate.macro(evaluate.average_precision(_ranked(spark, folder)), "ap"), 8, "macro_ap")


@query(
    "eval_compare_global",
    over(
        BOTH_SQL + "," + _report_sql("both_models", "model"),
        f""", g AS (SELECT model, {_GLOBAL} FROM rep GROUP BY model),
        u AS (UNPIVOT g ON accuracy, f1, "weightedPrecision", "weightedRecall" INTO NAME metric VALUE v)
        SELECT metric, max(CASE WHEN model = 'a' THEN v END) AS a, max(CASE WHEN model = 'b' THEN v END) AS b FROM u GROUP BY 1""",
    ),
)
def eval_compare_global(spark, folder):
    return rounded(evaluate.compare_global(_both(spark, folder), ["a", "b"]), 8, "a", "b")


@query(
    "eval_compare_f1",
    over(
        BOTH_SQL + "," + _report_sql("both_models", "model"),
        """SELECT class, round(coalesce(max(CASE WHEN model = 'a' THEN f END), 0), 8) AS a,
             round(coalesce(max(CASE WHEN model = 'b' THEN f END), 0), 8) AS b FROM rep GROUP BY 1""",
    ),
)
def eval_compare_f1(spark, folder):
    return rounded(evaluate.compare_f1(_both(spark, folder), ["a", "b"]), 8, "a", "b")


@query("eval_scores_long", over(_LONG, "SELECT class, score, pos = 1 AS positive FROM lng"))
def eval_scores_long(spark, folder):
    return evaluate.scores_long(scored(spark, folder), "scores")
