"""Temporary tables: who owns them and when they go."""

import os

import pytest
from pyspark.sql import functions as F

from flowsift import session
from flowsift.functions.hashing import fast_uniform
from flowsift.operators import evaluate
from flowsift.plans.modelling import prepare_sides
from flowsift.queries import REGISTRY

FOLDER = "/root/testdata/sf0.001"


def folders(spark):
    root = f"{session.shared_dir(spark)}/flowsift".removeprefix("file:")
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def test_a_scope_deletes_what_it_does_not_keep(spark):
    before = folders(spark)
    with session.temporary_tables(spark) as scope:
        first = session.materialize(spark.range(5), "first")
        with session.temporary_tables(spark) as inner:
            second = session.materialize(first.where("id > 1"), "second")
            third = inner.keep(session.materialize(second.where("id > 2"), "third"))
            assert len(folders(spark) - before) == 3
        assert len(folders(spark) - before) == 2
        fourth = session.materialize(third.where("id > 3"), "fourth", spent=[third])
        assert len(folders(spark) - before) == 2  # first and fourth
        assert [r.id for r in fourth.collect()] == [4] and first.count() == 5
        kept = scope.keep(fourth)
    assert len(folders(spark) - before) == 1 and kept.count() == 1
    session.current_scope(spark).drop(kept)
    assert folders(spark) == before


def test_a_scope_ends_with_an_error_too(spark):
    before = folders(spark)
    with pytest.raises(ValueError):
        with session.temporary_tables(spark):
            session.materialize(spark.range(2))
            raise ValueError
    assert folders(spark) == before and session.current_scope(spark) is session.session_scope(spark)


def test_spent_tables_of_another_scope_stay(spark):
    outer = session.materialize(spark.range(3))
    with session.temporary_tables(spark):
        session.materialize(outer.where("id > 0"), spent=[outer, spark.range(1)])
        assert outer.count() == 3
    assert outer.count() == 3


def test_release(spark):
    held = session._SESSION_SCOPES.pop(spark.sparkContext.applicationId, None)
    try:
        before = folders(spark)
        session.materialize(spark.range(3))
        assert len(folders(spark) - before) == 1
        session.release(spark)
        assert folders(spark) == before
    finally:
        if held is not None:
            session._SESSION_SCOPES[spark.sparkContext.applicationId] = held


def test_ranked_scores_leave_nothing_behind(spark):
    before = folders(spark)
    rows = spark.range(500).select(
        (F.col("id") % 3).alias("class"), (F.col("id") % 97).cast("double").alias("score"), (F.col("id") % 2 == 0).alias("positive")
    )
    with session.temporary_tables(spark):
        ranked = evaluate.ranked_scores(rows)
        assert len(folders(spark) - before) == 1
        found = evaluate.roc_auc(ranked).collect()
    assert len(found) == 3 and folders(spark) == before


def test_prepared_sides_hold_three_tables(spark):
    before = folders(spark)
    gold = spark.range(900).select(
        (F.col("id") % 3).cast("double").alias("label_index"), (F.col("id") % 17).cast("double").alias("a"), fast_uniform(3, "id").alias("b")
    )
    with session.temporary_tables(spark):
        sides = prepare_sides(gold, ["a", "b"])
        assert len(folders(spark) - before) == 3  # the stored gold is gone
        assert sides.train.count() + sides.test.count() == 900 and sides.balanced.count() > 0
    assert folders(spark) == before


def test_a_whole_pipeline_leaves_nothing_behind(spark):
    before = folders(spark)
    with session.temporary_tables(spark):
        rows = REGISTRY["pipeline_gold"].run(spark, FOLDER).collect()
        assert rows and len(folders(spark) - before) >= 2
    assert folders(spark) == before
