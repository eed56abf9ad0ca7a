"""Data-quality audit."""

from flowsift.functions.columns import c, select_numeric
from flowsift.operators import audit, clean
from flowsift.plans.layers import silver_report
from flowsift.queries.labels import STAGED_SQL, repaired
from flowsift.queries.registry import query, rounded, table
from flowsift.queries.views import FEAT_SQL, FLOWS_DUP_SQL, FLOWS_SQL, feat, flows, flows_dup, over, text_of, text_of_sql

_FLOW_COLUMNS = ["event_id", "source_file", "Timestamp", "Label", "Flow Duration", "Flow Byts/s", "Init Win Byts", "Const", "Src IP"]


def _each(names, body, view="flows"):
    """UNION ALL of one SELECT per column; `@` stands for the quoted name and `$` for its text."""
    return "\nUNION ALL ".join(body.replace("@", f'"{n}"').replace("$", f"'{n}'") + f" FROM {view}" for n in names)


@query("profile_shape", over(FLOWS_SQL, "SELECT count(*) AS n_rows, 9::INT AS n_columns FROM flows"))
def profile_shape(spark, folder):
    return audit.shape(flows(spark, folder))


@query(
    "audit_nulls",
    over(
        FLOWS_SQL,
        "SELECT * FROM ("
        + _each(
            _FLOW_COLUMNS,
            'SELECT $ AS "column", count_if(@ IS NULL)::BIGINT AS n_null, round(count_if(@ IS NULL) * 100.0::DOUBLE / count(*), 2) AS pct_null',
        )
        + ") WHERE n_null > 0",
    ),
)
def audit_nulls(spark, folder):
    return audit.null_counts(flows(spark, folder))


@query(
    "audit_duplicates",
    over(
        FLOWS_DUP_SQL,
        """SELECT count_if(n > 1)::BIGINT AS duplicate_groups, sum(CASE WHEN n > 1 THEN n ELSE 0 END)::BIGINT AS duplicate_rows,
             sum(n - 1)::BIGINT AS surplus_rows, sum(n)::BIGINT AS n_rows,
             round(sum(CASE WHEN n > 1 THEN n ELSE 0 END) * 100.0::DOUBLE / sum(n), 2) AS pct_duplicate
           FROM (SELECT count(*) AS n FROM flows_dup
                 GROUP BY "Timestamp", "Label", "Flow Duration", "Flow Byts/s", "Init Win Byts", "Const", "Src IP")""",
    ),
)
def audit_duplicates(spark, folder):
    return audit.duplicates(flows_dup(spark, folder), ignore=["source_file"])


@query(
    "audit_nonfinite",
    over(
        FLOWS_SQL,
        "SELECT * FROM ("
        + _each(
            ["Flow Duration", "Flow Byts/s"],
            'SELECT $ AS "column", count_if(isinf(@))::BIGINT AS n_inf, count_if(isnan(@))::BIGINT AS n_nan, count_if(@ IS NULL)::BIGINT AS n_null',
        )
        + ") WHERE n_inf + n_nan > 0",
    ),
)
def audit_nonfinite(spark, folder):
    return audit.nonfinite_counts(flows(spark, folder))


@query(
    "audit_constant_cols",
    over(
        FLOWS_SQL,
        "SELECT * FROM ("
        + _each(
            _FLOW_COLUMNS,
            'SELECT $ AS "column", CASE WHEN count(DISTINCT @) + max((@ IS NULL)::INT) <= 1 THEN min(@)::VARCHAR END AS value',
        )
        + ") WHERE value IS NOT NULL",
    ),
)
def audit_constant_cols(spark, folder):
    return audit.constant_columns(flows(spark, folder))


_DESCRIBED = ["quantity", "price", "discount", "tax", "linenumber", "price_net", "day_of_week", "hour"]
_NUMBER_SQL = """SELECT $ AS "column", count(@) AS n, round(avg(@), 4) AS mean, round(stddev_samp(@), 4) AS stddev,
  round(min(@)::DOUBLE, 4) AS min, round(max(@)::DOUBLE, 4) AS max, NULL::VARCHAR AS first, NULL::VARCHAR AS last"""
_TEXT_SQL = """SELECT $ AS "column", count(@) AS n, NULL::DOUBLE AS mean, NULL::DOUBLE AS stddev, NULL::DOUBLE AS min, NULL::DOUBLE AS max,
  min(@) AS first, max(@) AS last"""


@query("profile_describe", over(FEAT_SQL, _each(_DESCRIBED, _NUMBER_SQL, "feat") + " UNION ALL " + _each(["Label", "rarity"], _TEXT_SQL, "feat")))
def profile_describe(spark, folder):
    return rounded(audit.describe(feat(spark, folder), [*_DESCRIBED, "Label", "rarity"]), 4, "mean", "stddev", "min", "max")


@query(
    "profile_describe_texts",
    _each(["doc_id", "n_chars"], _NUMBER_SQL, "documents")
    + " UNION ALL "
    + _each(["text", "lang", "source"], _TEXT_SQL, "documents"),
)
def profile_describe_texts(spark, folder):
    """Every column of `documents`, most of them texts."""
    return rounded(audit.describe(table(spark, folder, "documents")), 4, "mean", "stddev")


@query(
    "audit_label_validity",
    over(
        STAGED_SQL,
        """SELECT count_if("Label_raw" IN (FROM nm))::BIGINT AS n_valid,
             count_if("Label_raw" IS NOT NULL AND "Label_raw" NOT IN (FROM nm))::BIGINT AS n_invalid,
             count_if("Label_raw" IS NULL)::BIGINT AS n_missing FROM repaired""",
    ),
)
def audit_label_validity(spark, folder):
    return audit.label_validity(flows(spark, folder))


_BY_FILE = """SELECT source_file, count(*) AS total_filas, count_if("Label" IN (FROM nm))::BIGINT AS labels_validos,
     count(*) - count_if("Label" IN (FROM nm))::BIGINT AS labels_invalidos,
     round((count(*) - count_if("Label" IN (FROM nm))) * 100.0::DOUBLE / count(*), 2) AS pct_corrupcion
   FROM repaired GROUP BY source_file"""


@query("audit_by_file", over(STAGED_SQL, _BY_FILE))
def audit_by_file(spark, folder):
    return audit.quality_by_file(repaired(spark, folder))


@query(
    "audit_files_flagged",
    over(STAGED_SQL, f"SELECT *, pct_corrupcion > 3 AS warning FROM ({_BY_FILE}) WHERE pct_corrupcion > 0"),
)
def audit_files_flagged(spark, folder):
    return audit.flagged_files(audit.quality_by_file(repaired(spark, folder)), warn_pct=3.0)


@query(
    "audit_id_columns",
    over(
        FLOWS_SQL,
        _each(["Src IP", "event_id"], 'SELECT $ AS "column", count_if(@ IS NULL)::BIGINT AS n_null, count(DISTINCT @) AS n_distinct'),
    ),
)
def audit_id_columns(spark, folder):
    return audit.id_columns(flows(spark, folder), ["Src IP", "Dst IP", "event_id"])


@query(
    "audit_negatives",
    over(
        FLOWS_SQL,
        "SELECT * FROM ("
        + _each(["event_id", "Flow Duration", "Flow Byts/s", "Init Win Byts", "Const"], 'SELECT $ AS "column", count_if(@ < 0)::BIGINT AS n_negative')
        + ") WHERE n_negative > 0",
    ),
)
def audit_negatives(spark, folder):
    return audit.negative_counts(flows(spark, folder))


@query(
    "audit_integrity",
    over(
        FLOWS_SQL,
        """, v AS (SELECT
             count_if(event_id IS NULL) + count_if("Flow Duration" IS NULL) + count_if("Flow Byts/s" IS NULL)
               + count_if("Init Win Byts" IS NULL) + count_if("Const" IS NULL) AS a,
             count_if(isinf("Flow Duration")) + count_if(isinf("Flow Byts/s")) AS b,
             count_if("Flow Duration" < 0) + count_if("Flow Byts/s" < 0) + count_if("Init Win Byts" < 0) AS d FROM flows),
           r AS (SELECT 'null_numbers' AS "check", a AS violations FROM v UNION ALL SELECT 'infinite_values', b FROM v
             UNION ALL SELECT 'negative_values', d FROM v UNION ALL SELECT 'id_columns_left', 1 FROM v
             UNION ALL SELECT 'time_column_lost', 0 FROM v)
           SELECT "check", violations::BIGINT AS violations, violations = 0 AS passed FROM r""",
    ),
)
def audit_integrity(spark, folder):
    return audit.integrity(flows(spark, folder))


SILVER_SQL = (
    FLOWS_DUP_SQL
    + """,
z0 AS (SELECT * EXCLUDE (source_file) FROM flows_dup),
z1 AS (SELECT * EXCLUDE ("Src IP") FROM z0),
z2 AS (SELECT DISTINCT * FROM z1),
z3 AS (SELECT * FROM z2 WHERE isfinite("Flow Duration") AND isfinite("Flow Byts/s")),
z4 AS (SELECT * FROM z3 WHERE year(try_strptime("Timestamp", '%d/%m/%Y %H:%M:%S')) >= 2000),
z5 AS (SELECT "Timestamp", "Label", greatest("Flow Duration", 0) AS "Flow Duration", greatest("Flow Byts/s", 0) AS "Flow Byts/s",
         greatest("Init Win Byts", 0)::INT AS "Init Win Byts", "Const" FROM z4),
z6 AS (SELECT * EXCLUDE ("Const") FROM z5)"""
)
_STAGES = ["bronze", "drop_ids", "deduplicate", "finite_rows", "valid_times", "clip_negatives", "drop_constant"]
_WIDTH = [7, 6, 6, 6, 6, 6, 5]


@query(
    "audit_stage_report",
    over(
        SILVER_SQL,
        ", c AS ("
        + " UNION ALL ".join(
            f"SELECT {i}::INT AS stage_no, '{s}' AS stage, count(*) AS n_rows, {w}::INT AS n_columns FROM z{i}"
            for i, (s, w) in enumerate(zip(_STAGES, _WIDTH))
        )
        + """), l AS (SELECT *, lag(n_rows) OVER (ORDER BY stage_no) AS p FROM c)
        SELECT stage_no, stage, n_rows, n_columns, coalesce(p - n_rows, 0) AS rows_removed,
          coalesce(round((p - n_rows) * 100.0::DOUBLE / p, 2), 0.0) AS pct_removed FROM l""",
    ),
)
def audit_stage_report(spark, folder):
    return silver_report(flows_dup(spark, folder).drop("source_file"))


@query(
    "audit_stage_counts",
    over(
        FLOWS_SQL,
        """, a AS (SELECT count(*) AS x, count_if(isfinite("Flow Byts/s")) AS y,
             count_if(isfinite("Flow Byts/s") AND year(try_strptime("Timestamp", '%d/%m/%Y %H:%M:%S')) >= 2000) AS z FROM flows)
        SELECT 0::INT AS stage_no, 'flows' AS stage, x AS n_rows, 9::INT AS n_columns, 0::BIGINT AS rows_removed, 0.0::DOUBLE AS pct_removed FROM a
        UNION ALL SELECT 1, 'finite', y::BIGINT, 9, (x - y)::BIGINT, round((x - y) * 100.0::DOUBLE / x, 2) FROM a
        UNION ALL SELECT 2, 'timely', z::BIGINT, 9, (y - z)::BIGINT, round((y - z) * 100.0::DOUBLE / y, 2) FROM a""",
    ),
)
def audit_stage_counts(spark, folder):
    rows = flows(spark, folder)
    finite = clean.finite_rows(rows)
    return audit.stage_report([("flows", rows), ("finite", finite), ("timely", clean.drop_bad_times(finite))])


@query(
    "audit_missing_pattern",
    over(
        FLOWS_SQL,
        "SELECT "
        + " || ".join(f"""CASE WHEN "{n}" IS NULL THEN '1' ELSE '0' END""" for n in _FLOW_COLUMNS)
        + " AS pattern, count(*) AS n_rows FROM flows GROUP BY 1",
    ),
)
def audit_missing_pattern(spark, folder):
    return audit.missing_pattern(flows(spark, folder), _FLOW_COLUMNS)


_NUMBERS = ["quantity", "price", "discount", "tax", "linenumber", "price_net", "price_usd", "day_of_week", "hour"]
_VARIANCES = _each(_NUMBERS, 'SELECT $ AS "column", round(var_samp(@), 3) AS variance', "feat")


@query("profile_variance", over(FEAT_SQL, _VARIANCES))
def profile_variance(spark, folder):
    return rounded(audit.variance(feat(spark, folder), _NUMBERS), 3, "variance")


@query("topk_variance", over(FEAT_SQL, f"""SELECT * FROM ({_VARIANCES}) ORDER BY variance DESC, "column" LIMIT 5"""))
def topk_variance(spark, folder):
    return rounded(audit.top_columns(audit.variance(feat(spark, folder), _NUMBERS), "variance", 5), 3, "variance")


@query("proj_numeric", over(FLOWS_SQL, f'SELECT event_id, "Flow Duration", {text_of_sql(chr(34) + "Flow Byts/s" + chr(34))} AS "Flow Byts/s", "Init Win Byts" FROM flows'))
def proj_numeric(spark, folder):
    numbers = select_numeric(flows(spark, folder), exclude=["Const"])
    return numbers.withColumn("Flow Byts/s", text_of(c("Flow Byts/s")))
