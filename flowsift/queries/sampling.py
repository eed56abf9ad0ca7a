"""Samples, splits and balance."""

from pyspark.sql import functions as F

from flowsift.functions.hashing import fast_uniform, key_uniform
from flowsift.operators import sampling
from flowsift.queries.registry import query, table
from flowsift.queries.views import FEAT_SQL, KEYS, feat, key_u, key_u_sql, over

_U42 = key_u_sql(42)
_SLIM = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
_COUNTS = "cnt AS (SELECT rarity, count(*) AS n_rows FROM feat GROUP BY 1)"


def _slim(df, *more):
    return df.select(*KEYS, *more)


@query("sample_fraction", over(FEAT_SQL, f"SELECT {_SLIM} FROM feat WHERE {_U42} < 0.1"))
def sample_fraction(spark, folder):
    return _slim(sampling.sample_fraction(feat(spark, folder), 0.1, key_u(42)))


@query("sample_capped_fraction", over(FEAT_SQL, f"SELECT {_SLIM} FROM feat WHERE {_U42} < 5000.0::DOUBLE / (SELECT count(*) FROM feat)"))
def sample_capped_fraction(spark, folder):
    """About 5,000 rows, drawn row by row."""
    rows = feat(spark, folder)
    return _slim(sampling.sample_fraction(rows, sampling.fraction_for(rows, 5000), key_u(42)))


@query("sample_fixed_n", over(FEAT_SQL, f"SELECT {_SLIM} FROM feat ORDER BY {_U42}, {_SLIM} LIMIT 1000"))
def sample_fixed_n(spark, folder):
    return _slim(sampling.sample_rows(feat(spark, folder), 1000, key_u(42), tie=KEYS))


_RANKED = f"""SELECT *, row_number() OVER (PARTITION BY rarity ORDER BY {_U42}, {_SLIM}) AS rn FROM feat"""


@query("sample_stratified_cap", over(FEAT_SQL, f"SELECT {_SLIM}, rarity FROM ({_RANKED}) WHERE rn <= 500"))
def sample_stratified_cap(spark, folder):
    return _slim(sampling.sample_per_class(feat(spark, folder), 500, key_u(42), "rarity", KEYS), "rarity")


@query(
    "sample_equal_shares",
    over(FEAT_SQL, f"SELECT {_SLIM}, rarity FROM ({_RANKED}) WHERE rarity IN ('common', 'mid') AND rn <= 300"),
)
def sample_equal_shares(spark, folder):
    out = sampling.sample_equal_shares(feat(spark, folder), 600, ["common", "mid"], key_u(42), "rarity", KEYS)
    return _slim(out, "rarity")


@query(
    "split_stratified",
    over(
        FEAT_SQL,
        f"""SELECT rarity, CASE WHEN {_U42} < 0.8 THEN 'train' ELSE 'test' END AS side, count(*) AS n_rows FROM feat GROUP BY ALL""",
    ),
)
def split_stratified(spark, folder):
    marked = sampling.mark_split(feat(spark, folder), key_u(42), "rarity")
    return marked.groupBy("rarity", "side").agg(F.count(F.lit(1)).alias("n_rows"))


@query("split_test_rows", over(FEAT_SQL, f"SELECT {_SLIM} FROM feat WHERE NOT {_U42} < CASE rarity WHEN 'rare' THEN 0.5 ELSE 0.8 END"))
def split_test_rows(spark, folder):
    """Test side with a fraction of its own for one class."""
    fractions = {"rare": 0.5, "mid": 0.8, "common": 0.8}
    return _slim(sampling.split(feat(spark, folder), key_u(42), "rarity", fractions)[1])


@query("split_anti_join", over(FEAT_SQL, f"SELECT {_SLIM} FROM feat WHERE NOT {_U42} < 0.8"))
def split_anti_join(spark, folder):
    """The test side once more, as rows whose key is not in train."""
    from flowsift.operators.classes import anti_join

    rows = feat(spark, folder)
    return _slim(anti_join(rows, sampling.sample_fraction(rows, 0.8, key_u(42)), KEYS))


_RATIO = f"""{_COUNTS}, r AS (SELECT rarity, (SELECT floor(median(n_rows)) FROM cnt)::DOUBLE / n_rows AS ratio FROM cnt),
    cp AS (SELECT f.*, (floor(ratio) + CASE WHEN {_U42} < ratio - floor(ratio) THEN 1 ELSE 0 END)::BIGINT AS copies
           FROM feat f JOIN r USING (rarity)),
    bal AS (SELECT *, unnest(range(1, copies + 1)) AS copy FROM cp WHERE copies > 0)"""


@query("balance_to_median", over(FEAT_SQL, f", {_RATIO} SELECT {_SLIM}, rarity, copy FROM bal"))
def balance_to_median(spark, folder):
    return _slim(sampling.balance(feat(spark, folder), key_u(42), "rarity"), "rarity", "copy")


@query(
    "balance_report",
    over(
        FEAT_SQL,
        f""", {_RATIO} SELECT cnt.rarity AS "Label", cnt.n_rows AS rows_before, coalesce(b.n, 0) AS rows_after
            FROM cnt LEFT JOIN (SELECT rarity, count(*) AS n FROM bal GROUP BY 1) b USING (rarity)""",
    ),
)
def balance_report(spark, folder):
    rows = feat(spark, folder)
    return sampling.balance_report(rows, sampling.balance(rows, key_u(42), "rarity"), "rarity")


@query(
    "balance_labels",
    """WITH cnt AS (SELECT toxic, count(*) AS n FROM labels GROUP BY 1),
       r AS (SELECT toxic, (SELECT floor(median(n)) FROM cnt)::DOUBLE / n AS ratio FROM cnt),
       cp AS (SELECT doc_id, toxic, (floor(ratio) + CASE WHEN ('0x' || substr(md5(concat_ws('|', '42', doc_id::VARCHAR)), 1, 8))::BIGINT
                / 4294967296.0::DOUBLE < ratio - floor(ratio) THEN 1 ELSE 0 END)::BIGINT AS copies FROM labels JOIN r USING (toxic))
       SELECT doc_id, toxic::VARCHAR AS toxic, unnest(range(1, copies + 1)) AS copy FROM cp WHERE copies > 0""",
)
def balance_labels(spark, folder):
    rows = table(spark, folder, "labels").select("doc_id", F.col("toxic").cast("string").alias("toxic"))
    return sampling.balance(rows, key_uniform(42, "doc_id"), "toxic")


@query(
    "split_random",
    over(FEAT_SQL, f"SELECT {_SLIM}, CASE WHEN {_U42} < 0.75 THEN 0 ELSE 1 END::INT AS part FROM feat"),
)
def split_random(spark, folder):
    return _slim(sampling.mark_parts(feat(spark, folder), [0.75, 0.25], key_u(42)), "part")


@query("split_fast_hash")
def split_fast_hash(spark, folder):
    """The split with the cheaper hash, which only Spark computes: rows per class and side."""
    marked = sampling.mark_split(feat(spark, folder), fast_uniform(42, *KEYS), "rarity")
    return marked.groupBy("rarity", "side").agg(F.count(F.lit(1)).alias("n_rows"))
