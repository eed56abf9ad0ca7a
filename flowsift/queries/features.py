"""Feature preparation and selection."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from flowsift.operators import classes, features
from flowsift.operators.moments import correlation, gram
from flowsift.plans.layers import to_gold
from flowsift.queries.classes import INDEX_SQL
from flowsift.queries.distribution import CORR_NAMES, corr_sql
from flowsift.queries.registry import query, rounded, table
from flowsift.queries.views import FEAT_SQL, KEYS, feat, over

_SLIM = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
_RARITY_INDEX = ', idx AS (SELECT rarity, (row_number() OVER (ORDER BY count(*) DESC, rarity) - 1)::DOUBLE AS label_index FROM feat GROUP BY 1)'


@query("feat_label_index", over(FEAT_SQL + _RARITY_INDEX, f"SELECT {_SLIM}, label_index FROM feat JOIN idx USING (rarity)"))
def feat_label_index(spark, folder):
    return features.label_index(feat(spark, folder), "rarity").select(*KEYS, "label_index")


@query("feat_assemble", over(FEAT_SQL, f"SELECT {_SLIM}, quantity AS f0, discount AS f1, tax AS f2 FROM feat"))
def feat_assemble(spark, folder):
    packed = features.assemble(feat(spark, folder), ["quantity", "discount", "tax"])
    values = vector_to_array("features")
    return packed.select(*KEYS, *[values[i].alias(f"f{i}") for i in range(3)])


_Z = ["quantity", "price", "discount"]


@query(
    "feat_standard_scale",
    over(
        FEAT_SQL,
        f"SELECT {_SLIM}, "
        + ", ".join(f"round(({n} - (SELECT avg({n}) FROM feat)) / (SELECT stddev_samp({n}) FROM feat), 6) AS {n}" for n in _Z)
        + " FROM feat",
    ),
)
def feat_standard_scale(spark, folder):
    return rounded(features.standard_scale(feat(spark, folder), _Z).select(*KEYS, *_Z), 6, *_Z)


@query(
    "feat_scale_train_only",
    over(
        FEAT_SQL,
        f""", t AS (SELECT * FROM feat WHERE linenumber <= 3)
        SELECT {_SLIM}, round((price - (SELECT avg(price) FROM t)) / (SELECT stddev_samp(price) FROM t), 6) AS price
        FROM feat WHERE linenumber > 3""",
    ),
)
def feat_scale_train_only(spark, folder):
    """The spark.ml scaler, fitted on some lines and applied to the others."""
    packed = features.assemble(feat(spark, folder), ["price"], "features_raw")
    model = features.fit_scaler(packed.filter("linenumber <= 3"))
    scaled = model.transform(packed.filter("linenumber > 3"))
    return scaled.select(*KEYS, F.round(vector_to_array("features")[0], 6).alias("price"))


_PAIRS = f"""SELECT y AS feature, count(*) AS n_pairs, round(max(abs(r)), 8) AS max_r FROM ({corr_sql()})
     WHERE i < j AND abs(r) > 0.95 GROUP BY 1"""


@query("feat_corr_prune", over(FEAT_SQL, _PAIRS))
def feat_corr_prune(spark, folder):
    matrix = correlation(feat(spark, folder), CORR_NAMES)
    return rounded(features.correlated_features(matrix), 8, "max_r")


@query("feat_rf_importance")
def feat_rf_importance(spark, folder):
    rows = features.label_index(feat(spark, folder), "rarity")
    names = ["quantity", "price", "discount", "tax", "linenumber", "price_net", "day_of_week"]
    return features.rf_importance(rows, names, trees=30, depth=10)


@query("feat_pca_scree")
def feat_pca_scree(spark, folder):
    return features.pca_scree(feat(spark, folder), ["quantity", "price", "discount", "tax", "linenumber", "price_net"])


@query("feat_pca_2d")
def feat_pca_2d(spark, folder):
    names = ["quantity", "price", "discount", "tax", "linenumber", "price_net"]
    return features.pca_project(feat(spark, folder), names, [*KEYS, "Label"])


@query(
    "feat_pca_scree_pair",
    over(
        FEAT_SQL,
        """, r AS (SELECT abs(corr(price, quantity)) AS r FROM feat)
        SELECT 1::INT AS component, round((1 + r) / 2, 8) AS explained, round((1 + r) / 2, 8) AS cumulative, (1 + r) / 2 >= 0.9 AS reaches_share FROM r
        UNION ALL SELECT 2, round((1 - r) / 2, 8), 1.0, (1 + r) / 2 < 0.9 FROM r""",
    ),
)
def feat_pca_scree_pair(spark, folder):
    """Two columns, where the closed form is known; more are tested against numpy."""
    return rounded(features.pca_scree(feat(spark, folder), ["price", "quantity"], 0.9), 8, "explained", "cumulative")


@query(
    "feat_pca_2d_pair",
    over(
        FEAT_SQL,
        """, z AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (price - avg(price) OVER ()) / stddev_samp(price) OVER () AS a,
                     (quantity - avg(quantity) OVER ()) / stddev_samp(quantity) OVER () AS b FROM feat)
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(abs(a + s * b) / sqrt(2), 6) AS pc1, round(abs(a - s * b) / sqrt(2), 6) AS pc2
        FROM z, (SELECT sign(corr(price, quantity)) AS s FROM feat)""",
    ),
)
def feat_pca_2d_pair(spark, folder):
    """Distances along both components of two columns."""
    out = features.pca_project(feat(spark, folder), ["price", "quantity"], KEYS)
    return out.select(*KEYS, F.round(F.abs("pc1"), 6).alias("pc1"), F.round(F.abs("pc2"), 6).alias("pc2"))


_ANOVA_NAMES = ["quantity", "price", "discount", "tax", "linenumber", "day_of_week"]


def _anova_sql(by: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{n}' AS feature,
          (sum(k * pow(m - g, 2)) / (count(*) - 1)) / (sum(k * v) / (sum(k) - count(*))) AS f_score
        FROM (SELECT count(*) AS k, avg({n}) AS m, var_pop({n}) AS v, (SELECT avg({n}) FROM feat) AS g FROM feat GROUP BY {by})"""
        for n in _ANOVA_NAMES
    )


@query("feat_anova_f", over(FEAT_SQL, f"SELECT feature, round(f_score, 4) AS f_score FROM ({_anova_sql('rarity')})"))
def feat_anova_f(spark, folder):
    return rounded(features.anova_f(feat(spark, folder), _ANOVA_NAMES, "rarity").select("feature", "f_score"), 4, "f_score")


@query("feat_anova_p")
def feat_anova_p(spark, folder):
    """Scores with p values, which SQL has no function for."""
    return features.anova_f(feat(spark, folder), _ANOVA_NAMES, "Label")


@query(
    "feat_anova_p_three",
    over(
        FEAT_SQL,
        f""", p AS (SELECT feature, f_score, pow(1 + 2 * f_score / ((SELECT count(*) FROM feat) - 3), -((SELECT count(*) FROM feat) - 3) / 2.0::DOUBLE) AS p
             FROM ({_anova_sql('rarity')}))
        SELECT feature, round(f_score, 4) AS f_score, round(p, 8) AS p_value FROM p""",
    ),
)
def feat_anova_p_three(spark, folder):
    """Three classes, where the tail of the F distribution has a closed form."""
    return rounded(rounded(features.anova_f(feat(spark, folder), _ANOVA_NAMES, "rarity"), 4, "f_score"), 8, "p_value")


_GRAM = ["quantity", "discount", "tax", "linenumber"]


@query(
    "feat_gram",
    over(
        FEAT_SQL,
        " UNION ALL ".join(
            f"SELECT {i}::INT AS i, {j}::INT AS j, round(sum({_GRAM[i]}::DOUBLE * {_GRAM[j]}), 3) AS g FROM feat"
            for i in range(len(_GRAM))
            for j in range(i, len(_GRAM))
        ),
    ),
)
def feat_gram(spark, folder):
    return rounded(gram(feat(spark, folder), _GRAM), 3, "g")


@query(
    "feat_gram_wide",
    """WITH e AS (SELECT vec_id, unnest(range(64)) AS i, unnest(embedding)::DOUBLE AS v FROM embeddings),
       s AS (SELECT * FROM e)
       SELECT a.i::INT AS i, b.i::INT AS j, round(sum(a.v * b.v), 6) AS g FROM s a JOIN s b ON a.vec_id = b.vec_id AND a.i <= b.i GROUP BY 1, 2""",
)
def feat_gram_wide(spark, folder):
    """Gram matrix of more columns than fit one set of plain sums."""
    vectors = table(spark, folder, "embeddings")
    wide = vectors.select(*[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(64)])
    return rounded(gram(wide, wide.columns), 6, "g")


@query(
    "feat_vif",
    over(
        FEAT_SQL,
        """, s AS (SELECT sum(quantity * quantity) AS a, sum(tax * tax) AS b, sum(quantity * tax) AS ab FROM feat)
        SELECT 'quantity' AS feature, round(1 / (1 - ab * ab / (a * b)), 6) AS vif, 1 / (1 - ab * ab / (a * b)) > 10 AS above_limit FROM s
        UNION ALL SELECT 'tax', round(1 / (1 - ab * ab / (a * b)), 6), 1 / (1 - ab * ab / (a * b)) > 10 FROM s""",
    ),
)
def feat_vif(spark, folder):
    """Two columns, where the closed form is known; more columns are tested against numpy."""
    return rounded(features.vif(feat(spark, folder), ["quantity", "tax"]), 6, "vif")


def _vif3_sql(names: list[str]) -> str:
    a, b, d = names
    s = lambda x, y: f"sum({x}::DOUBLE * {y})"
    det = "aa * (bb * dd - bd * bd) - ab * (ab * dd - bd * ad) + ad * (ab * bd - bb * ad)"
    rows = ((a, "aa * (bb * dd - bd * bd)"), (b, "bb * (aa * dd - ad * ad)"), (d, "dd * (aa * bb - ab * ab)"))
    picked = " UNION ALL ".join(f"SELECT '{n}' AS feature, round({e} / ({det}), 6) AS vif, {e} / ({det}) > 10 AS above_limit FROM g" for n, e in rows)
    return f""", g AS (SELECT {s(a, a)} AS aa, {s(b, b)} AS bb, {s(d, d)} AS dd, {s(a, b)} AS ab, {s(a, d)} AS ad, {s(b, d)} AS bd FROM feat)
    {picked}"""


_VIF3 = ["quantity", "tax", "linenumber"]


@query("feat_vif_three", over(FEAT_SQL, _vif3_sql(_VIF3)))
def feat_vif_three(spark, folder):
    """Three columns by determinants."""
    return rounded(features.vif(feat(spark, folder), _VIF3), 6, "vif")


@query("feat_vif_all")
def feat_vif_all(spark, folder):
    names = ["quantity", "price", "discount", "tax", "linenumber", "day_of_week"]
    return features.vif(feat(spark, folder), names)


@query(
    "feat_method_table",
    over(
        FEAT_SQL,
        f""", f AS (SELECT feature, f_score, row_number() OVER (ORDER BY f_score DESC, feature) AS anova_rank FROM ({_anova_sql('rarity')})),
        gone AS ({_PAIRS})
        SELECT feature, feature NOT IN (SELECT feature FROM gone) AS kept, round(f_score, 4) AS f_score, anova_rank::INT AS anova_rank
        FROM (SELECT unnest([{", ".join(f"'{n}'" for n in CORR_NAMES)}]) AS feature) LEFT JOIN f USING (feature)""",
    ),
)
def feat_method_table(spark, folder):
    rows = feat(spark, folder)
    kept = features.prune_correlated(rows, CORR_NAMES)
    out = features.method_table(CORR_NAMES, kept, features.anova_f(rows, _ANOVA_NAMES, "rarity"))
    return rounded(out, 4, "f_score")


@query("feat_method_table_full")
def feat_method_table_full(spark, folder):
    """All methods side by side, forest ranking and inflation included."""
    rows = features.label_index(feat(spark, folder), "rarity")
    kept = features.prune_correlated(rows, CORR_NAMES)
    return features.method_table(
        CORR_NAMES,
        kept,
        features.anova_f(rows, kept, "rarity"),
        features.rf_importance(rows, kept, trees=5, depth=4),
        features.vif(rows, kept),
        top_importance=4,
        top_anova=4,
    )


@query(
    "setop_feature_consensus",
    over(
        FEAT_SQL,
        f"""(SELECT feature FROM ({_anova_sql('rarity')}) ORDER BY f_score DESC, feature LIMIT 4)
        INTERSECT (SELECT feature FROM ({_anova_sql('"Label"')}) ORDER BY f_score DESC, feature LIMIT 4)""",
    ),
)
def setop_feature_consensus(spark, folder):
    rows = feat(spark, folder)
    tops = [features.anova_f(rows, _ANOVA_NAMES, by).limit(4) for by in ("rarity", "Label")]
    return classes.consensus(*tops)


@query(
    "feat_gold",
    over(
        FEAT_SQL + ", " + INDEX_SQL.format("feat"),
        'SELECT "Label", label_index, quantity, price, discount, tax, linenumber, day_of_week, hour FROM feat JOIN idx USING ("Label")',
    ),
)
def feat_gold(spark, folder):
    table_, _ = to_gold(feat(spark, folder).drop("rarity", *[k for k in KEYS]))
    return table_
