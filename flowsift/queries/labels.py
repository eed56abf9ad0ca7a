"""Label repair."""

from pyspark.sql import functions as F

from flowsift.operators import labels
from flowsift.queries.registry import query
from flowsift.queries.views import FLOWS_SQL, flows, over


def _values(rows) -> str:
    return ", ".join("(" + ", ".join("'" + v + "'" for v in row) + ")" for row in rows)


NAMES_SQL = f"""
nm(name) AS (VALUES {_values((n,) for n in labels.CLASS_NAMES)}),
vr(variant, canonical) AS (VALUES {_values(labels.KNOWN_VARIANTS.items())})"""

STAGED_SQL = (
    FLOWS_SQL
    + ","
    + NAMES_SQL
    + r""",
st3 AS (
  SELECT *, "Label" AS s0, trim("Label", ' ') AS s1, regexp_replace(trim("Label", ' '), '\s+', ' ', 'g') AS s2,
    trim(regexp_replace(regexp_replace(trim("Label", ' '), '\s+', ' ', 'g'), '[\x00-\x1f]', '', 'g'), ' ') AS s3
  FROM flows),
st4 AS (SELECT a.*, coalesce(n.name, a.s3) AS s4 FROM st3 a LEFT JOIN nm n ON lower(trim(a.s3)) = lower(n.name)),
st5 AS (SELECT a.*, coalesce(v.canonical, a.s4) AS s5 FROM st4 a LEFT JOIN vr v ON a.s4 = v.variant),
staged AS (
  SELECT a.*, CASE WHEN a.s5 IN (SELECT name FROM nm) THEN a.s5 ELSE coalesce(n.name, a.s5) END AS s6
  FROM st5 a LEFT JOIN nm n ON lower(regexp_replace(a.s5, '[\s\-_]', '', 'g')) = lower(regexp_replace(n.name, '[\s\-_]', '', 'g'))),
repaired AS (
  SELECT event_id, source_file, "Timestamp", "Flow Duration", "Flow Byts/s", "Init Win Byts", "Const", "Src IP",
    s0 AS "Label_raw", s6 AS "Label",
    CASE WHEN s0 IS NULL THEN 'missing' WHEN s0 IN (FROM nm) THEN 'initial' WHEN s1 IN (FROM nm) THEN 'trim'
      WHEN s2 IN (FROM nm) THEN 'collapse' WHEN s3 IN (FROM nm) THEN 'strip_control' WHEN s4 IN (FROM nm) THEN 'case'
      WHEN s5 IN (FROM nm) THEN 'variant' WHEN s6 IN (FROM nm) THEN 'separator' ELSE 'unrepaired' END AS repair_step
  FROM staged)"""
)


def repaired(spark, folder):
    return flows(spark, folder).transform(labels.normalize)


def _one_step(step):
    def run(spark, folder):
        return flows(spark, folder).select("event_id", step(F.col("Label")).alias("Label"))

    return run


query("label_trim", over(FLOWS_SQL, """SELECT event_id, trim("Label", ' ') AS "Label" FROM flows"""))(
    _one_step(labels.trim_label)
)
query("label_collapse", over(FLOWS_SQL, r"""SELECT event_id, regexp_replace("Label", '\s+', ' ', 'g') AS "Label" FROM flows"""))(
    _one_step(labels.collapse_blanks)
)
query(
    "label_strip_ctrl",
    over(FLOWS_SQL, r"""SELECT event_id, trim(regexp_replace("Label", '[\x00-\x1f]', '', 'g'), ' ') AS "Label" FROM flows"""),
)(_one_step(labels.strip_control))


@query(
    "label_case_match",
    over(
        FLOWS_SQL + "," + NAMES_SQL,
        r"""SELECT event_id, coalesce(n.name, f."Label") AS "Label" FROM flows f
            LEFT JOIN nm n ON lower(regexp_replace(f."Label", '^\s+|\s+$', '', 'g')) = lower(n.name)""",
    ),
)
def label_case_match(spark, folder):
    return labels.match_case(flows(spark, folder)).select("event_id", "Label")


@query(
    "label_variant_map",
    over(
        FLOWS_SQL + "," + NAMES_SQL,
        """SELECT event_id, coalesce(v.canonical, f."Label") AS "Label" FROM flows f LEFT JOIN vr v ON f."Label" = v.variant""",
    ),
)
def label_variant_map(spark, folder):
    return labels.map_variants(flows(spark, folder)).select("event_id", "Label")


@query(
    "label_variant_hits",
    over(
        STAGED_SQL,
        "SELECT v.variant, v.canonical, count(*) AS n_rows FROM staged s JOIN vr v ON s.s4 = v.variant GROUP BY 1, 2",
    ),
)
def label_variant_hits(spark, folder):
    return labels.variant_hits(flows(spark, folder))


@query(
    "label_fuzzy_match",
    over(
        FLOWS_SQL + "," + NAMES_SQL,
        r"""SELECT event_id, CASE WHEN f."Label" IN (FROM nm) THEN f."Label" ELSE coalesce(n.name, f."Label") END AS "Label"
            FROM flows f LEFT JOIN nm n ON lower(regexp_replace(f."Label", '[\s\-_]', '', 'g'))
              = lower(regexp_replace(n.name, '[\s\-_]', '', 'g'))""",
    ),
)
def label_fuzzy_match(spark, folder):
    return labels.match_letters(flows(spark, folder)).select("event_id", "Label")


@query("label_normalize", over(STAGED_SQL, 'SELECT event_id, source_file, "Label_raw", "Label", repair_step FROM repaired'))
def label_normalize(spark, folder):
    return repaired(spark, folder).select("event_id", "source_file", "Label_raw", "Label", "repair_step")


_LOG = "\nUNION ALL ".join(
    f"""SELECT {i}::INT AS step_no, '{name}' AS step,
      count_if(s{i} IN (FROM nm)) - count_if(s{max(i - 1, 0)} IN (FROM nm)) AS recovered,
      count_if(s{i} IN (FROM nm)) AS valid, count(s0) - count_if(s{i} IN (FROM nm)) AS invalid,
      count(*) - count(s0) AS missing, round(count_if(s{i} IN (FROM nm)) * 100.0::DOUBLE / count(*), 2) AS pct_valid FROM staged"""
    for i, name in enumerate(labels.REPAIR_STEPS)
)


@query("label_recovery_log", over(STAGED_SQL, f"SELECT step_no, step, recovered::BIGINT AS recovered, valid::BIGINT AS valid, invalid::BIGINT AS invalid, missing, pct_valid FROM ({_LOG})"))
def label_recovery_log(spark, folder):
    return labels.recovery_log(flows(spark, folder))


@query(
    "label_raw_inventory",
    over(
        FLOWS_SQL + "," + NAMES_SQL,
        """SELECT "Label" AS "Label_raw", count(*) AS n_rows, coalesce(trim("Label", ' ') IN (FROM nm), false) AS known
           FROM flows GROUP BY "Label" """,
    ),
)
def label_raw_inventory(spark, folder):
    return labels.raw_inventory(flows(spark, folder))


@query(
    "label_unrecoverable",
    over(STAGED_SQL, """SELECT "Label", count(*) AS n_rows FROM repaired WHERE "Label" IS NULL OR "Label" NOT IN (FROM nm) GROUP BY 1"""),
)
def label_unrecoverable(spark, folder):
    return labels.unrecoverable(repaired(spark, folder))


@query(
    "label_unrecoverable_by_file",
    over(
        STAGED_SQL,
        """SELECT source_file, "Label", count(*) AS n_rows FROM repaired
           WHERE "Label" IS NULL OR "Label" NOT IN (FROM nm) GROUP BY 1, 2""",
    ),
)
def label_unrecoverable_by_file(spark, folder):
    return labels.unrecoverable(repaired(spark, folder), by=["source_file"])


@query(
    "label_drop_report",
    over(
        STAGED_SQL,
        """SELECT count(*) AS rows_before,
             count_if("Label" IN (FROM nm) AND NOT coalesce("Label_raw" IN (FROM nm), false))::BIGINT AS rows_recovered,
             count_if(NOT coalesce("Label" IN (FROM nm), false))::BIGINT AS rows_removed,
             count_if("Label" IN (FROM nm))::BIGINT AS rows_kept,
             round(count_if("Label" IN (FROM nm)) * 100.0::DOUBLE / count(*), 2) AS pct_kept FROM repaired""",
    ),
)
def label_drop_report(spark, folder):
    return labels.drop_report(repaired(spark, folder))


@query("label_classes_lost", over(STAGED_SQL, """SELECT name AS "Label" FROM nm WHERE name NOT IN (SELECT "Label" FROM repaired WHERE "Label" IS NOT NULL)"""))
def label_classes_lost(spark, folder):
    return labels.classes_lost(repaired(spark, folder))


@query("filter_valid_labels", over(STAGED_SQL, """SELECT event_id, "Label" FROM repaired WHERE "Label" IN (FROM nm)"""))
def filter_valid_labels(spark, folder):
    return labels.keep_valid(repaired(spark, folder)).select("event_id", "Label")


@query(
    "filter_invalid_labels",
    over(STAGED_SQL, """SELECT event_id, "Label" FROM repaired WHERE "Label" IS NULL OR "Label" NOT IN (FROM nm)"""),
)
def filter_invalid_labels(spark, folder):
    return labels.drop_valid(repaired(spark, folder)).select("event_id", "Label")
