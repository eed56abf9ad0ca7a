"""From a gold table to train and test sides, and to judged models."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import StandardScalerModel
from pyspark.sql import Column, DataFrame

from flowsift.functions.hashing import fast_uniform, row_key
from flowsift.operators import features, sampling
from flowsift.session import materialize


@dataclass
class Sides:
    train: DataFrame
    test: DataFrame
    balanced: DataFrame
    scaler: StandardScalerModel


def prepare_sides(
    gold: DataFrame,
    names: Sequence[str],
    label: str = "label_index",
    train: float = 0.8,
    seed: int = 42,
    key: Column | None = None,
    store: bool = True,
) -> Sides:
    """Assemble, split, scale on train, balance train.

    Gold has no key, so rows are split by a hash of the whole row: equal rows share a side and cannot leak.
    The three sides are written once, since they are read many times; the stored gold they come from is then deleted.
    """
    if store:
        gold = materialize(gold, "gold")
    base = key if key is not None else row_key(gold)
    marked = gold.withColumn("_key", base)
    packed = features.assemble(marked, names, "features_raw").select(label, "_key", "features_raw")
    train_raw, test_raw = sampling.split(packed, fast_uniform(seed, "_key"), label, train)
    scaler = features.fit_scaler(train_raw)
    train_side, test_side = scaler.transform(train_raw), scaler.transform(test_raw)
    balanced = sampling.balance(train_side, fast_uniform(seed + 1, "_key"), label)
    slim = [label, "_key", "features"]
    frames = [train_side.select(*slim), test_side.select(*slim), balanced.select(*slim)]
    if store:
        names_of = ("train", "test", "balanced")
        frames = [materialize(f, n, spent=[gold] if n == "balanced" else []) for f, n in zip(frames, names_of)]
    return Sides(*frames, scaler)
