"""Physical plans of all registered queries."""

import pytest

from flowsift.queries import REGISTRY

FOLDER = "/root/testdata/sf0.001"
FITS = ("ml_", "model_", "feat_rf", "feat_pca", "feat_method_table_full")


@pytest.mark.parametrize("name", [n for n in REGISTRY if not n.startswith(FITS)])
def test_no_cross_join_and_no_python_rows(spark, name):
    plan = REGISTRY[name].run(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan


def test_only_needed_columns_are_read(spark):
    plan = REGISTRY["class_n_distinct"].run(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in plan


def test_trim_bounds_reach_the_scan(spark):
    from flowsift.operators.distribution import trim

    df = trim(spark.read.parquet(f"{FOLDER}/lineitem.parquet"), "l_extendedprice", 0.01, 0.99)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_extendedprice" in plan


@pytest.mark.parametrize(
    "name, scans, shuffles",
    [
        ("audit_nulls", 1, 0),
        ("audit_duplicates", 1, 1),
        ("label_recovery_log", 1, 0),
        ("label_normalize", 1, 0),
        ("split_stratified", 1, 1),
        ("clean_silver", 1, 1),
        ("corr_matrix", 1, 1),
        ("sample_fixed_n", 1, 1),
        ("sample_stratified_cap", 1, 2),
    ],
)
def test_one_scan_and_few_shuffles(spark, name, scans, shuffles):
    """Scans and shuffles by key of the plan as it is handed to adaptive execution."""
    plan = REGISTRY[name].run(spark, FOLDER)._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert (plan.count("FileScan"), plan.count("Exchange hashpartitioning")) == (scans, shuffles)
