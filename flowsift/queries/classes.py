"""Class distribution, rankings, set operations."""

from pyspark.sql import functions as F

from flowsift.operators import classes
from flowsift.operators.features import label_index
from flowsift.queries.labels import STAGED_SQL, repaired
from flowsift.queries.registry import query, rounded, table
from flowsift.queries.views import FEAT_SQL, FLOWS_SQL, feat, flows, over

_RARITY = "SELECT rarity AS \"Label\", count(*) AS n_rows FROM feat GROUP BY 1"


@query("class_counts", over(STAGED_SQL, """SELECT "Label", count(*) AS n_rows FROM repaired GROUP BY 1"""))
def class_counts(spark, folder):
    return classes.class_counts(repaired(spark, folder))


@query(
    "class_pct",
    over(
        STAGED_SQL,
        """SELECT "Label", count(*) AS n_rows, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 4) AS pct FROM repaired GROUP BY 1""",
    ),
)
def class_pct(spark, folder):
    return classes.class_share(repaired(spark, folder))


@query(
    "class_longtail_fold",
    over(
        FEAT_SQL,
        f"""SELECT CASE WHEN p < 2 THEN 'other' ELSE "Label" END AS "Label", sum(n_rows)::BIGINT AS n_rows,
              round(sum(p), 4) AS pct, count(*) AS n_classes
            FROM (SELECT *, n_rows * 100.0::DOUBLE / sum(n_rows) OVER () AS p FROM ({_RARITY})) GROUP BY 1""",
    ),
)
def class_longtail_fold(spark, folder):
    return classes.fold_long_tail(feat(spark, folder), "rarity")


@query(
    "class_longtail_members",
    over(
        FEAT_SQL,
        f"""SELECT "Label", n_rows, pct FROM (SELECT *, round(n_rows * 100.0::DOUBLE / sum(n_rows) OVER (), 4) AS pct
            FROM ({_RARITY})) WHERE pct < 2""",
    ),
)
def class_longtail_members(spark, folder):
    return classes.long_tail(feat(spark, folder), "rarity")


@query("class_n_distinct", over(STAGED_SQL, """SELECT count(DISTINCT "Label") AS n_classes FROM repaired"""))
def class_n_distinct(spark, folder):
    return classes.n_classes(repaired(spark, folder))


INDEX_SQL = """idx AS (SELECT "Label", (row_number() OVER (ORDER BY count(*) DESC, "Label") - 1)::DOUBLE AS label_index FROM {} GROUP BY 1)"""


@query("label_index_map", over(FEAT_SQL + ", " + INDEX_SQL.format("feat"), "SELECT * FROM idx"))
def label_index_map(spark, folder):
    return classes.label_index_map(label_index(feat(spark, folder)))


@query(
    "topk_class_filter",
    over(
        FEAT_SQL,
        """SELECT l_orderkey, l_linenumber, "Label" FROM feat WHERE "Label" IN (
             SELECT "Label" FROM feat GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 3)""",
    ),
)
def topk_class_filter(spark, folder):
    return classes.keep_top_classes(feat(spark, folder), 3).select("l_orderkey", "l_linenumber", "Label")


@query(
    "class_median_count",
    over(FEAT_SQL, f"SELECT median(n_rows)::DOUBLE AS median, floor(median(n_rows))::BIGINT AS target FROM ({_RARITY})"),
)
def class_median_count(spark, folder):
    return classes.median_class_size(feat(spark, folder), "rarity")


@query(
    "setop_union_by_name",
    """SELECT c_custkey AS key, c_acctbal AS balance, c_mktsegment AS segment, NULL AS name FROM customer
       UNION ALL SELECT s_suppkey, s_acctbal, NULL, s_name FROM supplier""",
)
def setop_union_by_name(spark, folder):
    left = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")
    )
    right = table(spark, folder, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("key")
    )
    return classes.union_by_name([left, right])


@query(
    "join_left_anti",
    "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 25)",
)
def join_left_anti(spark, folder):
    big = table(spark, folder, "lineitem").filter("l_quantity > 25").select(F.col("l_orderkey").alias("o_orderkey"))
    return classes.anti_join(table(spark, folder, "orders").select("o_orderkey", "o_orderpriority"), big, ["o_orderkey"])


_MEANS = ["quantity", "price", "discount", "linenumber"]


def _means(select: str) -> str:
    return " UNION ALL ".join(select.replace("@", n) for n in _MEANS)


@query(
    "class_mean_std",
    over(
        FEAT_SQL,
        _means("""SELECT "Label", '@' AS "column", round(avg(@), 4) AS mean, round(stddev_samp(@), 4) AS stddev FROM feat GROUP BY 1"""),
    ),
)
def class_mean_std(spark, folder):
    return rounded(classes.class_mean_std(feat(spark, folder), _MEANS), 4, "mean", "stddev")


@query(
    "class_profile_minmax",
    over(
        FEAT_SQL,
        ", m AS ("
        + _means("""SELECT "Label", '@' AS "column", avg(@) AS mean FROM feat GROUP BY 1""")
        + """), s AS (SELECT *, min(mean) OVER (PARTITION BY "column") AS lo, max(mean) OVER (PARTITION BY "column") AS hi FROM m)
        SELECT "Label", "column", round(CASE WHEN hi > lo THEN (mean - lo) / (hi - lo) ELSE mean END, 5) AS profile FROM s""",
    ),
)
def class_profile_minmax(spark, folder):
    return rounded(classes.class_profile(feat(spark, folder), _MEANS), 5, "profile")


@query(
    "class_id_sorted",
    over(FEAT_SQL, """SELECT l_orderkey, l_linenumber, "Label", (dense_rank() OVER (ORDER BY "Label") - 1)::INT AS class_id FROM feat"""),
)
def class_id_sorted(spark, folder):
    return classes.class_id(feat(spark, folder)).select("l_orderkey", "l_linenumber", "Label", "class_id")


@query(
    "class_mean_std_dirty",
    over(
        FLOWS_SQL,
        """SELECT "Src IP" IS NULL AS "Label", 'Flow Byts/s' AS "column", round(avg("Flow Byts/s"), 3) AS mean, round(stddev_samp("Flow Byts/s"), 3) AS stddev
           FROM flows WHERE isfinite("Flow Byts/s") GROUP BY 1""",
    ),
)
def class_mean_std_dirty(spark, folder):
    """Means of a column with infinities, NaN and nulls."""
    rows = flows(spark, folder).withColumn("side", F.col("`Src IP`").isNull())
    return rounded(classes.class_mean_std(rows, ["Flow Byts/s"], "side"), 3, "mean", "stddev")
