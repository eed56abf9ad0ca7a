"""Fitted trees whose result SQL can reach: the split search itself, over all rows, is done again by the twin.

One tree without bootstrap, with all features as candidates and a bin for every value, has one right answer: at each node the
split with the largest gain among all midpoints between neighbouring values. What is checked against it is what forests and
boosted models are made of: bins, gains, leaf statistics, scoring, class margins and feature importance.
"""

from pyspark.ml.classification import GBTClassifier, OneVsRest
from pyspark.sql import functions as F

from flowsift.operators import features, training
from flowsift.queries.registry import query, rounded
from flowsift.queries.views import FEAT_SQL, KEYS, feat, over

NAMES = ["quantity", "discount", "tax", "linenumber", "day_of_week"]

_ROWS_SQL = f"""{FEAT_SQL.strip()},
classes AS (SELECT rarity, row_number() OVER (ORDER BY count(*) DESC, rarity) - 1 AS y FROM feat GROUP BY rarity),
rows AS (SELECT {", ".join(KEYS)}, y::DOUBLE AS y, quantity::DOUBLE AS f0, discount::DOUBLE AS f1, tax::DOUBLE AS f2,
                linenumber::DOUBLE AS f3, day_of_week::DOUBLE AS f4 FROM feat JOIN classes USING (rarity))"""


def _level_sql(rows: str, name: str) -> str:
    """The best split of each node of `rows` (f0 to f4, y, node): feature `f`, threshold `t`, `gain` and rows `n`."""
    return f"""
{name}_values AS (
  SELECT node, f, v, y, count(*) AS k
  FROM (SELECT node, y, unnest([0, 1, 2, 3, 4]) AS f, unnest([f0, f1, f2, f3, f4]) AS v FROM {rows}) GROUP BY ALL
), {name}_places AS (
  SELECT node, f, v, lead(v) OVER (PARTITION BY node, f ORDER BY v) AS next_v FROM (SELECT DISTINCT node, f, v FROM {name}_values)
), {name}_sides AS (
  SELECT p.node, p.f, (p.v + p.next_v) / 2 AS t, x.y, sum(CASE WHEN x.v <= p.v THEN k ELSE 0 END) AS l, sum(CASE WHEN x.v > p.v THEN k ELSE 0 END) AS r
  FROM {name}_places p JOIN {name}_values x USING (node, f) WHERE p.next_v IS NOT NULL GROUP BY ALL
), {name}_gains AS (
  SELECT node, f, t, sum(l + r)::DOUBLE AS n, sum(l)::DOUBLE AS nl, sum(r)::DOUBLE AS nr,
         (1 - sum((l + r)::DOUBLE ** 2) / n ** 2) - nl / n * (1 - sum(l::DOUBLE ** 2) / nl ** 2) - nr / n * (1 - sum(r::DOUBLE ** 2) / nr ** 2) AS gain
  FROM {name}_sides GROUP BY node, f, t
), {name} AS (
  SELECT * FROM {name}_gains WHERE gain > 1e-12 QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, t) = 1
)"""


def _moved_sql(rows: str, splits: str) -> str:
    return f"""SELECT r.* EXCLUDE (node), CASE WHEN s.f IS NULL THEN r.node ELSE 2 * r.node + CASE WHEN [f0, f1, f2, f3, f4][s.f + 1] <= s.t THEN 0 ELSE 1 END END AS node
  FROM {rows} r LEFT JOIN {splits} s USING (node)"""


_TREE_SQL = f"""{_ROWS_SQL},
at_root AS (SELECT *, 1 AS node FROM rows),
{_level_sql("at_root", "first").strip()},
at_second AS ({_moved_sql("at_root", "first")}),
{_level_sql("at_second", "second").strip()},
at_third AS ({_moved_sql("at_second", "second")}),
{_level_sql("at_third", "third").strip()},
at_leaf AS ({_moved_sql("at_third", "third")})
"""


def _tree(spark, folder):
    """(rows with keys, a fitted tree of depth 3 over all of them)."""
    rows = features.assemble(features.label_index(feat(spark, folder), "rarity"), NAMES).select(*KEYS, "label_index", "features")
    stored = training.store_for_fit(rows, "tree", trees=1, width=len(NAMES))
    forest = training.sized_forest(stored, numTrees=1, maxDepth=3, maxBins=64, featureSubsetStrategy="all", bootstrap=False)
    return stored, forest.fit(stored)


@query(
    "ml_tree_predict",
    over(
        _TREE_SQL,
        f"""SELECT {', '.join(KEYS)}, prediction, p0, p1, p2 FROM at_leaf JOIN (
             SELECT node, arg_max(y2, (p, -y2))::DOUBLE AS prediction, round(max(CASE WHEN y2 = 0 THEN p END), 9) AS p0,
                    round(max(CASE WHEN y2 = 1 THEN p END), 9) AS p1, round(max(CASE WHEN y2 = 2 THEN p END), 9) AS p2
             FROM (SELECT node, y2, count_if(y = y2) / count(*)::DOUBLE AS p FROM at_leaf, (SELECT unnest([0, 1, 2]) AS y2) GROUP BY node, y2)
             GROUP BY node) USING (node)""",
    ),
)
def ml_tree_predict(spark, folder):
    """Class scores of every row, from the tree."""
    rows, model = _tree(spark, folder)
    scores = [F.get("scores", F.lit(k)).alias(f"p{k}") for k in range(3)]
    return rounded(training.score(model, rows, KEYS).select(*KEYS, "prediction", *scores), 9, "p0", "p1", "p2")


@query(
    "feat_tree_importance",
    over(
        _TREE_SQL,
        f"""SELECT (row_number() OVER (ORDER BY importance DESC, feature))::INT AS rank, feature, round(importance, 9) AS importance FROM (
             SELECT names[g.f + 1] AS feature, coalesce(sum(gain * n), 0) / (SELECT sum(gain * n) FROM (FROM first UNION ALL FROM second UNION ALL FROM third)) AS importance
             FROM (SELECT unnest([0, 1, 2, 3, 4]) AS f, {NAMES} AS names) g LEFT JOIN (FROM first UNION ALL FROM second UNION ALL FROM third) s USING (f)
             GROUP BY ALL)""",
    ),
)
def feat_tree_importance(spark, folder):
    """Importance of the features: gain times rows over all nodes, as a share."""
    _, model = _tree(spark, folder)
    weights = model.featureImportances.toArray()
    order = sorted(range(len(NAMES)), key=lambda i: (-weights[i], NAMES[i]))
    rows = [(rank + 1, NAMES[i], float(weights[i])) for rank, i in enumerate(order)]
    return rounded(spark.createDataFrame(rows, "rank int, feature string, importance double"), 9, "importance")


@query(
    "ml_boosted_stumps",
    over(
        _ROWS_SQL,
        """, sides AS (SELECT k, r.*, CASE WHEN y = k THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS z FROM rows r, (SELECT unnest([0, 1, 2]) AS k)),
        counts AS (SELECT k, f, v, count(*)::DOUBLE AS n, sum(z) AS s
                   FROM (SELECT k, z, unnest([0, 1, 2, 3, 4]) AS f, unnest([f0, f1, f2, f3, f4]) AS v FROM sides) GROUP BY ALL),
        running AS (SELECT k, f, v, lead(v) OVER w AS next_v, sum(n) OVER w AS nl, sum(s) OVER w AS sl,
                           sum(n) OVER (PARTITION BY k, f) AS n, sum(s) OVER (PARTITION BY k, f) AS s FROM counts WINDOW w AS (PARTITION BY k, f ORDER BY v)),
        gains AS (SELECT k, f, (v + next_v) / 2 AS t, sl / nl AS left_z, (s - sl) / (n - nl) AS right_z,
                         nl / n * (sl / nl) ** 2 + (n - nl) / n * ((s - sl) / (n - nl)) ** 2 - (s / n) ** 2 AS gain
                  FROM running WHERE next_v IS NOT NULL),
        best AS (SELECT * FROM gains QUALIFY row_number() OVER (PARTITION BY k ORDER BY gain DESC, f, t) = 1),
        margins AS (SELECT $keys, [CASE WHEN [f0, f1, f2, f3, f4][a.f + 1] <= a.t THEN a.left_z ELSE a.right_z END,
                                   CASE WHEN [f0, f1, f2, f3, f4][b.f + 1] <= b.t THEN b.left_z ELSE b.right_z END,
                                   CASE WHEN [f0, f1, f2, f3, f4][c.f + 1] <= c.t THEN c.left_z ELSE c.right_z END] AS m
                    FROM rows, (FROM best WHERE k = 0) a, (FROM best WHERE k = 1) b, (FROM best WHERE k = 2) c)
        SELECT $keys, (list_position(m, list_max(m)) - 1)::DOUBLE AS prediction, round(m[1], 9) AS m0, round(m[2], 9) AS m1, round(m[3], 9) AS m2
        FROM margins""".replace("$keys", ", ".join(KEYS)),
    ),
)
def ml_boosted_stumps(spark, folder):
    """Margins of one-vs-rest boosted models of one stump each: the first step of boosting, for every class and row."""
    rows = features.assemble(features.label_index(feat(spark, folder), "rarity"), NAMES).select(*KEYS, "label_index", "features")
    stored = training.store_for_fit(rows, "stumps", trees=1, width=len(NAMES))
    booster = GBTClassifier(labelCol="label_index", featuresCol="features", maxIter=1, maxDepth=1, maxBins=64, seed=42)
    model = OneVsRest(classifier=booster, labelCol="label_index", featuresCol="features", parallelism=3).fit(stored)
    margins = [F.get("scores", F.lit(k)).alias(f"m{k}") for k in range(3)]
    return rounded(training.score(model, stored, KEYS).select(*KEYS, "prediction", *margins), 9, "m0", "m1", "m2")
