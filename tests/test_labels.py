import pytest
from pyspark.sql import functions as F

from flowsift.operators import labels

CASES = {
    "Benign": ("Benign", "initial"),
    "  Benign ": ("Benign", "trim"),
    "SQL   Injection": ("SQL Injection", "collapse"),
    "Bot\t": ("Bot", "strip_control"),
    "Bot\x01": ("Bot", "strip_control"),
    "bENIGN": ("Benign", "case"),
    "DDOS attack-HOIC": ("DDoS attack-HOIC", "case"),
    "Brute Force-Web": ("Brute Force -Web", "variant"),
    "Infiltration": ("Infilteration", "variant"),
    "SSH-Brute Force": ("SSH-Bruteforce", "variant"),
    "sqlinjection": ("SQL Injection", "separator"),
    "brute_force web": ("Brute Force -Web", "separator"),
    "Label": ("Label", "unrepaired"),
    "": ("", "unrepaired"),
    None: (None, "missing"),
}


def frame(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, Label string")


def test_normalize_names_the_step_that_repaired(spark):
    rows = frame(spark, CASES).transform(labels.normalize).collect()
    assert {r["Label_raw"]: (r["Label"], r["repair_step"]) for r in rows} == CASES


def test_normalize_twice_changes_nothing(spark):
    once = frame(spark, CASES).transform(labels.normalize).drop("Label_raw", "repair_step")
    twice = once.transform(labels.normalize)
    assert {r["id"]: r["Label"] for r in once.collect()} == {r["id"]: r["Label"] for r in twice.collect()}


def test_null_label_is_its_own_state(spark):
    df = frame(spark, ["Benign", "x", None])
    states = [r[0] for r in df.select(labels.DEFAULT.state(F.col("Label"))).collect()]
    assert states == ["valid", "invalid", "missing"]
    assert labels.drop_valid(df).count() == 2


def test_recovery_log_adds_up(spark):
    log = labels.recovery_log(frame(spark, CASES)).orderBy("step_no").collect()
    assert [r["step"] for r in log] == list(labels.REPAIR_STEPS)
    assert log[-1]["valid"] == 12 and log[-1]["invalid"] == 2 and log[-1]["missing"] == 1
    assert sum(r["recovered"] for r in log) == log[-1]["valid"] - log[0]["valid"]


def test_variant_hits_count_rows_after_the_case_step(spark):
    df = frame(spark, ["Infiltration", "Infiltration", "DDOS attack-HOIC", "FTP-BruteForce", "FTP-Brute Force"])
    hits = {r["variant"]: r["n_rows"] for r in labels.variant_hits(df).collect()}
    assert hits == {"Infiltration": 2, "FTP-BruteForce": 1, "FTP-Brute Force": 1}


def test_classes_lost(spark):
    lost = {r[0] for r in labels.classes_lost(frame(spark, ["Benign", "Bot", None])).collect()}
    assert lost == set(labels.CLASS_NAMES) - {"Benign", "Bot"}


def test_own_catalogue(spark):
    own = labels.LabelCatalogue(("Cat", "Dog"), {"Hund": "Dog"})
    out = frame(spark, ["cat", "Hund", "d-o g"]).transform(labels.normalize, "Label", own)
    assert [r["Label"] for r in out.orderBy("id").collect()] == ["Cat", "Dog", "Dog"]


@pytest.mark.parametrize("make", [labels.normalize, labels.recovery_log, labels.variant_hits])
def test_no_python_and_no_row_shuffle(spark, make):
    plan = make(frame(spark, CASES))._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "SortMergeJoin" not in plan and "Cartesian" not in plan
