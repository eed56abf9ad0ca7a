"""Class-label repair against a closed catalogue of names."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsift.functions.columns import c, pct

# The official class names, spelling kept.
CLASS_NAMES = (
    "Benign",
    "Bot",
    "Brute Force -Web",
    "Brute Force -XSS",
    "DDoS attacks-LOIC-HTTP",
    "DDoS attack-HOIC",
    "DDoS attack-LOIC-UDP",
    "DoS attacks-GoldenEye",
    "DoS attacks-Hulk",
    "DoS attacks-SlowHTTPTest",
    "DoS attacks-Slowloris",
    "FTP-BruteForce",
    "Infilteration",
    "SQL Injection",
    "SSH-Bruteforce",
)

# Known variants of class names and what they stand for.
KNOWN_VARIANTS = {
    "DDOS attack-LOIC-UDP": "DDoS attack-LOIC-UDP",
    "DDOS attack-HOIC": "DDoS attack-HOIC",
    "DDOS attacks-LOIC-HTTP": "DDoS attacks-LOIC-HTTP",
    "Brute Force-Web": "Brute Force -Web",
    "Brute Force-XSS": "Brute Force -XSS",
    "BruteForce-Web": "Brute Force -Web",
    "BruteForce-XSS": "Brute Force -XSS",
    "Brute Force - Web": "Brute Force -Web",
    "Brute Force - XSS": "Brute Force -XSS",
    "SSH-BruteForce": "SSH-Bruteforce",
    "SSH-Brute Force": "SSH-Bruteforce",
    "SSH-bruteforce": "SSH-Bruteforce",
    "FTP-BruteForce": "FTP-BruteForce",
    "FTP-Brute Force": "FTP-BruteForce",
    "FTP-bruteforce": "FTP-BruteForce",
    "Infiltration": "Infilteration",
    "infilteration": "Infilteration",
    "Infiltering": "Infilteration",
    "DOS attacks-GoldenEye": "DoS attacks-GoldenEye",
    "DOS attacks-Hulk": "DoS attacks-Hulk",
    "DOS attacks-SlowHTTPTest": "DoS attacks-SlowHTTPTest",
    "DOS attacks-Slowloris": "DoS attacks-Slowloris",
}

# The repair steps in their order.
REPAIR_STEPS = ("initial", "trim", "collapse", "strip_control", "case", "variant", "separator")

VALID, INVALID, MISSING = "valid", "invalid", "missing"


@dataclass(frozen=True)
class LabelCatalogue:
    """Closed list of class names plus known variants of them."""

    names: Sequence[str] = CLASS_NAMES
    variants: Mapping[str, str] = field(default_factory=lambda: dict(KNOWN_VARIANTS))

    def lookup(self, spark: SparkSession, rows: Mapping[str, str], key: str, value: str) -> DataFrame:
        """A local relation: Spark knows its size, broadcasts it below its threshold and shuffles beyond."""
        return spark.createDataFrame(pa.table({key: list(rows.keys()), value: list(rows.values())}))

    def by_case(self, spark: SparkSession) -> DataFrame:
        return self.lookup(spark, {n.lower(): n for n in self.names}, "_case_key", "_case_name")

    def by_variant(self, spark: SparkSession) -> DataFrame:
        return self.lookup(spark, self.variants, "_variant_key", "_variant_name")

    def by_letters(self, spark: SparkSession) -> DataFrame:
        keys = {re.sub(r"[\s\-_]", "", n).lower(): n for n in self.names}
        return self.lookup(spark, keys, "_letters_key", "_letters_name")

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(pa.table({"Label": list(self.names)}))

    def is_valid(self, label: Column) -> Column:
        return F.coalesce(label.isin(list(self.names)), F.lit(False))

    def state(self, label: Column) -> Column:
        """valid, invalid or missing; a null label is its own state."""
        return F.when(label.isNull(), MISSING).when(self.is_valid(label), VALID).otherwise(INVALID)


DEFAULT = LabelCatalogue()


def trim_label(label: Column) -> Column:
    return F.trim(label)


def collapse_blanks(label: Column) -> Column:
    return F.regexp_replace(label, r"\s+", " ")


def strip_control(label: Column) -> Column:
    return F.trim(F.regexp_replace(label, r"[\t\r\n\x00-\x1f]", ""))


def letters_key(label: Column) -> Column:
    return F.lower(F.regexp_replace(label, r"(?U)[\s\-_]", ""))


def case_key(label: Column) -> Column:
    return F.lower(F.regexp_replace(label, r"(?U)^\s+|\s+$", ""))


def match_case(df: DataFrame, source: str = "Label", target: str = "Label", catalogue: LabelCatalogue = DEFAULT):
    """Label that equals a class name up to case takes that name."""
    side = catalogue.by_case(df.sparkSession)
    joined = df.withColumn("_k", case_key(c(source))).join(side, F.col("_k") == F.col("_case_key"), "left")
    return joined.withColumn(target, F.coalesce("_case_name", c(source))).drop("_k", "_case_key", "_case_name")


def map_variants(df: DataFrame, source: str = "Label", target: str = "Label", catalogue: LabelCatalogue = DEFAULT):
    """Known variants take the name they stand for."""
    joined = df.join(catalogue.by_variant(df.sparkSession), c(source) == F.col("_variant_key"), "left")
    return joined.withColumn(target, F.coalesce("_variant_name", c(source))).drop("_variant_key", "_variant_name")


def match_letters(df: DataFrame, source: str = "Label", target: str = "Label", catalogue: LabelCatalogue = DEFAULT):
    """Invalid labels that equal a class name without blanks, hyphens and underscores take that name."""
    key = F.when(~catalogue.is_valid(c(source)), letters_key(c(source)))
    joined = df.withColumn("_k", key).join(
        catalogue.by_letters(df.sparkSession), F.col("_k") == F.col("_letters_key"), "left"
    )
    return joined.withColumn(target, F.coalesce("_letters_name", c(source))).drop("_k", "_letters_key", "_letters_name")


def _staged(df: DataFrame, label: str, catalogue: LabelCatalogue) -> DataFrame:
    """`df` with the label after every step in `_s0` … `_s6`; no shuffle, one pass."""
    out = df.withColumn("_s0", c(label))
    out = out.withColumn("_s1", trim_label(F.col("_s0")))
    out = out.withColumn("_s2", collapse_blanks(F.col("_s1")))
    out = out.withColumn("_s3", strip_control(F.col("_s2")))
    out = match_case(out, "_s3", "_s4", catalogue)
    out = map_variants(out, "_s4", "_s5", catalogue)
    return match_letters(out, "_s5", "_s6", catalogue)


def normalize(df: DataFrame, label: str = "Label", catalogue: LabelCatalogue = DEFAULT, raw: str = "Label_raw"):
    """All repair steps at once.

    Keeps the raw label and adds `repair_step`: the first step after which the label was valid
    (`initial` if it always was), `unrepaired`, or `missing`.
    """
    staged = _staged(df, label, catalogue)
    step = F.when(F.col("_s0").isNull(), MISSING)
    for i, name in enumerate(REPAIR_STEPS):
        step = step.when(catalogue.is_valid(F.col(f"_s{i}")), name)
    staged = staged.withColumn("repair_step", step.otherwise("unrepaired")).withColumn(raw, F.col("_s0"))
    return staged.withColumn(label, F.col("_s6")).drop(*[f"_s{i}" for i in range(7)])


def recovery_log(df: DataFrame, label: str = "Label", catalogue: LabelCatalogue = DEFAULT) -> DataFrame:
    """Valid, invalid and recovered labels after each step, all counted in one pass."""
    staged = _staged(df, label, catalogue)
    aggs = [F.count(F.lit(1)).alias("_all"), F.count("_s0").alias("_known")]
    aggs += [F.count_if(catalogue.is_valid(F.col(f"_s{i}"))).alias(f"_v{i}") for i in range(7)]
    rows = [
        F.struct(
            F.lit(i).alias("step_no"),
            F.lit(name).alias("step"),
            (F.col(f"_v{i}") - F.col(f"_v{max(i - 1, 0)}")).alias("recovered"),
            F.col(f"_v{i}").alias("valid"),
            (F.col("_known") - F.col(f"_v{i}")).alias("invalid"),
            (F.col("_all") - F.col("_known")).alias("missing"),
            pct(F.col(f"_v{i}"), F.col("_all")).alias("pct_valid"),
        )
        for i, name in enumerate(REPAIR_STEPS)
    ]
    return staged.agg(*aggs).select(F.inline(F.array(*rows)))


def variant_hits(df: DataFrame, label: str = "Label", catalogue: LabelCatalogue = DEFAULT) -> DataFrame:
    """Rows per known variant that the variant step meets, that is after the steps before it."""
    staged = df.select(strip_control(collapse_blanks(trim_label(c(label)))).alias("_l"))
    cased = match_case(staged, "_l", "_l", catalogue)
    hit = cased.join(catalogue.by_variant(df.sparkSession), F.col("_l") == F.col("_variant_key"))
    return hit.groupBy(F.col("_variant_key").alias("variant"), F.col("_variant_name").alias("canonical")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def raw_inventory(df: DataFrame, label: str = "Label", catalogue: LabelCatalogue = DEFAULT) -> DataFrame:
    """Distinct raw labels with their rows and whether a mere trim makes them valid."""
    counts = df.groupBy(c(label).alias("Label_raw")).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.withColumn("known", catalogue.is_valid(F.trim("Label_raw")))


def keep_valid(df: DataFrame, label: str = "Label", catalogue: LabelCatalogue = DEFAULT) -> DataFrame:
    return df.filter(c(label).isin(list(catalogue.names)))


def drop_valid(df: DataFrame, label: str = "Label", catalogue: LabelCatalogue = DEFAULT) -> DataFrame:
    """Rows whose label is invalid or missing."""
    return df.filter(~catalogue.is_valid(c(label)))


def unrecoverable(df: DataFrame, label: str = "Label", catalogue: LabelCatalogue = DEFAULT, by: Sequence[str] = ()):
    """Labels that stay outside the catalogue, counted overall or per `by`; missing labels count as such."""
    bad = drop_valid(df, label, catalogue)
    counts = bad.groupBy(*[c(b) for b in by], c(label)).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.orderBy(*[c(b) for b in by], F.desc("n_rows"), c(label))


def drop_report(df: DataFrame, raw: str = "Label_raw", label: str = "Label", catalogue: LabelCatalogue = DEFAULT):
    """Rows before, recovered, removed and kept when only valid labels stay."""
    ok = catalogue.is_valid(c(label))
    sums = df.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(ok & ~catalogue.is_valid(c(raw))).alias("rows_recovered"),
        F.count_if(~ok).alias("rows_removed"),
        F.count_if(ok).alias("rows_kept"),
    )
    return sums.withColumn("pct_kept", pct(F.col("rows_kept"), F.col("rows_before")))


def classes_lost(df: DataFrame, label: str = "Label", catalogue: LabelCatalogue = DEFAULT) -> DataFrame:
    """Catalogue names no row carries."""
    present = keep_valid(df, label, catalogue).select(c(label).alias("Label")).distinct()
    return catalogue.frame(df.sparkSession).join(present, "Label", "left_anti")
