"""Training, tuning and scoring of tree ensembles with spark.ml.

The training side is read many times by one fit. Callers hand in a frame that is cheap to read again (`store_for_fit` writes
one to the shared folder, in even parts), so a lost executor costs a re-read and no re-run.
"""

from __future__ import annotations

import math
import threading
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import FIRST_EXCEPTION, CancelledError, ThreadPoolExecutor, wait
from functools import reduce
from itertools import product

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import GBTClassifier, OneVsRest, OneVsRestModel, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsift.functions.columns import c
from flowsift.operators.evaluate import confusion_counts, global_metrics
from flowsift.operators.sampling import mark_parts
from flowsift.session import materialize

# Parameters of the base models and of the two grids.
RF_BASE = {"numTrees": 50, "maxDepth": 10, "maxBins": 16, "seed": 42}
RF_GRID = {"numTrees": (100, 200), "maxDepth": (8, 10), "featureSubsetStrategy": ("sqrt", "log2")}
GBT_BASE = {"maxIter": 50, "maxDepth": 5, "stepSize": 0.1, "seed": 42}
GBT_GRID = {"maxIter": (50, 100), "maxDepth": (5, 8), "stepSize": (0.05, 0.1)}
VOLUMES = (0.10, 0.25, 0.50, 0.75, 1.0)

#: Rows that a task of a fit should have at least, and at most.
FIT_TASK_ROWS = (10_000, 4_000_000)
#: Bytes of points that a task of a fit should read at most in one pass.
FIT_TASK_BYTES = 128 * 2**20
#: Fits of a grid that run at the same time.
GRID_FITS = 2


def point_bytes(n_features: int, trees: int) -> int:
    """Bytes of a row as a fit keeps it in memory: a bin per feature, a count of draws per tree, and the objects around them."""
    return 104 + 4 * (n_features + trees)


def fit_parts(rows: int, cores: int, each: int) -> int:
    """Parts for a table of `rows`: one for each core unless they would be too short, or too long in rows or (`each` a row) in bytes."""
    least, most = FIT_TASK_ROWS
    most = max(1, min(most, FIT_TASK_BYTES // each))
    return max(1, min(cores, -(-rows // least)), -(-rows // most))


def _width(df: DataFrame) -> int:
    """Features of a row: the length of its vectors, seen on the first one."""
    vectors = [f.name for f in df.schema if isinstance(f.dataType, VectorUDT)]
    row = df.select(*[c(v) for v in vectors]).first() if vectors else None
    return sum(len(v) for v in row if v is not None) if row else 0


def store_for_fit(
    df: DataFrame, name: str = "fit", tasks: int | None = None, trees: int = max(RF_GRID["numTrees"]), width: int | None = None
) -> DataFrame:
    """`df` written in parts of equal size, one for each core (or `tasks`) unless they would be too short or too long.

    Every level of every tree is one pass over the table, and a pass takes as long as its longest task: a table that a few
    large files hold leaves cores idle in each of them. What a task reads in a pass are points, whose size follows the features
    (`width`, else that of the first row) and the `trees` of a fit. More parts than cores are written in groups of one a core at
    most: read at once, small files would be put together into one task again.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    each = point_bytes(_width(df) if width is None else width, trees)
    parts = fit_parts(df.count(), tasks or cores, each)
    dealt, groups = df.repartition(parts), -(-parts // cores)
    if groups == 1:
        return materialize(dealt, name)
    stored = materialize(dealt.withColumn("_fit_group", F.spark_partition_id() % groups), name, ("_fit_group",))
    table = reduce(DataFrame.unionAll, [stored.filter(F.col("_fit_group") == g).drop("_fit_group") for g in range(groups)])
    table.temporary_folder = stored.temporary_folder
    return table


def node_bytes(n_features: int, n_classes: int, bins: int, subset: str = "auto", trees: int = 2) -> int:
    """Bytes of the counts that a fit holds for one open node: bins of the candidate features times classes and total."""
    share = {"all": n_features, "log2": math.log2(max(2, n_features)), "onethird": n_features / 3, "sqrt": math.sqrt(n_features)}
    candidates = share["all" if trees == 1 else "sqrt"] if subset == "auto" else share.get(subset, n_features)
    return 8 * max(1, math.ceil(candidates)) * bins * (n_classes + 1)


def fit_memory(
    n_features: int, n_classes: int, trees: int, depth: int, bins: int, subset: str = "auto", most_mb: int = 1024
) -> tuple[int, int]:
    """(megabytes for `maxMemoryInMB`, passes over the rows): enough for the widest level of all trees at once, within `most_mb`.

    Nodes that do not fit wait for another pass, so a wide level under a small limit costs many.
    """
    each = node_bytes(n_features, n_classes, bins, subset, trees)
    widest = trees * 2 ** (depth - 1) * each / 2**20
    megabytes = int(min(most_mb, max(256, math.ceil(widest * 1.1))))
    at_once = max(1, int(megabytes * 2**20 // each))
    return megabytes, sum(-(-trees * 2**level // at_once) for level in range(depth))


def sized_forest(train: DataFrame, label: str = "label_index", features: str = "features", most_mb: int = 1024, **params):
    """`random_forest` whose memory follows the width of the features and the classes of `train`."""
    chosen = {**RF_BASE, **params}
    row = train.select(F.max(c(label)).alias("top")).first()
    first = train.select(c(features)).first()
    if first is None:
        raise ValueError("nothing to fit: the training side has no rows")
    subset = chosen.get("featureSubsetStrategy", "auto")
    megabytes, _ = fit_memory(
        len(first[0]), int(row["top"]) + 1, chosen["numTrees"], chosen["maxDepth"], chosen["maxBins"], subset, most_mb
    )
    return random_forest(label, features, **{"maxMemoryInMB": megabytes, **params})


def run_grid(spark: SparkSession, jobs: Sequence[Callable[[], object]], at_once: int = GRID_FITS) -> list:
    """Results of `jobs` in their order, `at_once` of them running, each in a scheduler pool of its own.

    The first error ends the grid: waiting jobs are dropped, the Spark jobs of running ones are cancelled, and it is raised.
    """
    context, tag, over = spark.sparkContext, f"grid-{uuid.uuid4().hex}", threading.Event()

    def run(number: int, job: Callable[[], object]):
        if over.is_set():
            raise CancelledError
        context.addJobTag(tag)
        context.setLocalProperty("spark.scheduler.pool", f"fit-{number % at_once}")
        try:
            return job()
        except BaseException:
            over.set()
            raise
        finally:
            context.setLocalProperty("spark.scheduler.pool", None)
            context.removeJobTag(tag)

    with ThreadPoolExecutor(max(1, at_once)) as pool:
        waiting = [pool.submit(inheritable_thread_target(spark)(run), i, job) for i, job in enumerate(jobs)]
        done, left = wait(waiting, return_when=FIRST_EXCEPTION)
        failed = next((f for f in waiting if f in done and f.exception() and not isinstance(f.exception(), CancelledError)), None)
        if failed is not None:
            for future in left:
                future.cancel()
            context.cancelJobsWithTag(tag)
            raise failed.exception()
        return [f.result() for f in waiting]


def random_forest(label: str = "label_index", features: str = "features", **params) -> RandomForestClassifier:
    return RandomForestClassifier(labelCol=label, featuresCol=features, **{**RF_BASE, **params})


def gbt_one_vs_rest(label: str = "label_index", features: str = "features", parallelism: int = 4, **params) -> OneVsRest:
    """One boosted binary model per class; `parallelism` of them are fitted at once."""
    booster = GBTClassifier(labelCol=label, featuresCol=features, **{**GBT_BASE, **params})
    return OneVsRest(classifier=booster, labelCol=label, featuresCol=features, parallelism=parallelism)


def evaluator(metric: str = "f1", label: str = "label_index") -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction", metricName=metric)


def fit_timed(estimator: Estimator, train: DataFrame) -> tuple[Model, float]:
    start = time.monotonic()
    model = estimator.fit(train)
    return model, time.monotonic() - start


def score(model: Model, df: DataFrame, keep: Sequence[str] = ("label_index",)) -> DataFrame:
    """Predictions beside the columns to keep, with the class scores as `scores` (array, one per class).

    Forests give probabilities; one-vs-rest gives the margins of its binary models.
    """
    from pyspark.ml.functions import vector_to_array

    out = model.transform(df)
    source = "probability" if "probability" in out.columns else "rawPrediction"
    return out.select(*[c(k) for k in keep], "prediction", vector_to_array(c(source)).alias("scores"))


def test_metrics(scored: DataFrame, label: str = "label_index") -> dict[str, float]:
    """Accuracy and weighted F1, precision, recall from one pass over the predictions."""
    return global_metrics(confusion_counts(scored, label)).first().asDict()


def fit_and_judge(
    estimators: Mapping[str, Estimator], train: DataFrame, test: DataFrame, label: str = "label_index"
) -> tuple[dict[str, Model], DataFrame]:
    """Fit every estimator; returns the models and their ranking (`modelo`, accuracy, f1, `tiempo_s`)."""
    models, rows = {}, []
    for name, estimator in estimators.items():
        models[name], seconds = fit_timed(estimator, train)
        found = test_metrics(score(models[name], test, (label,)), label)
        rows.append((name, found["accuracy"], found["f1"], seconds))
    return models, leaderboard(train.sparkSession, rows)


def leaderboard(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    # fixed values: the names of the ranking's columns
    frame = spark.createDataFrame(list(rows), "modelo string, accuracy double, f1 double, tiempo_s double")
    return frame.orderBy(F.desc("f1"))


def _grid(grid: Mapping[str, Sequence]) -> list[dict]:
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def _parts(train: DataFrame, u: Column, weights: Sequence[float], prepare, trees: int) -> tuple[DataFrame, DataFrame]:
    """The side to fit, prepared, and the side to check, both written: every fit reads them again."""
    marked = mark_parts(train, weights, u, "_part")
    fit_side = store_for_fit(prepare(marked.filter(F.col("_part") == 0).drop("_part")), "fit_side", trees=trees, width=_width(train))
    return fit_side, materialize(marked.filter(F.col("_part") == 1).drop("_part"), "check_side")


def tune_forest(
    train: DataFrame,
    u: Column,
    prepare: Callable[[DataFrame], DataFrame] = lambda part: part,
    grid: Mapping[str, Sequence] = RF_GRID,
    train_ratio: float = 0.75,
    label: str = "label_index",
    at_once: int = GRID_FITS,
    **params,
) -> tuple[Model, DataFrame]:
    """Grid search by weighted F1 on a held-back part; returns the best model, refitted on all of `train`, and F1 per combination.

    Rows are split by `u`, so the parts do not depend on the partition layout, and only what is fitted goes through `prepare`
    (class balance, say), so no copy of a row can be on both sides. `at_once` combinations are fitted side by side; of equal
    ones the first in the order of the grid is the best.
    """
    most_trees = max(grid.get("numTrees", (params.get("numTrees", RF_BASE["numTrees"]),)))
    fit_side, check_side = _parts(train, u, (train_ratio, 1 - train_ratio), prepare, most_trees)

    def judged(chosen: dict) -> float:
        model = sized_forest(fit_side, label, **{**params, **chosen}).fit(fit_side)
        return test_metrics(score(model, check_side, (label,)), label)["f1"]

    combinations = _grid(grid)
    found = run_grid(train.sparkSession, [lambda p=p: judged(p) for p in combinations], at_once)
    best = combinations[found.index(max(found))]
    whole = store_for_fit(prepare(train), "refit", trees=most_trees, width=_width(train))
    model = sized_forest(whole, label, **{**params, **best}).fit(whole)
    rows = [({n: str(v) for n, v in p.items()}, f1) for p, f1 in zip(combinations, found)]
    return model, _grid_table(train.sparkSession, list(grid), rows)


def _grid_table(spark: SparkSession, names: Sequence[str], rows: Sequence[tuple[dict, float]]) -> DataFrame:
    fields = ", ".join(f"{n} string" for n in names)
    best = max(f1 for _, f1 in rows)
    flat = [(*[params[n] for n in names], f1, f1 == best) for params, f1 in rows]
    return spark.createDataFrame(flat, f"{fields}, f1 double, best boolean").orderBy(F.desc("f1"))


def tune_gbt(
    train: DataFrame,
    u: Column,
    prepare: Callable[[DataFrame], DataFrame] = lambda part: part,
    grid: Mapping[str, Sequence] = GBT_GRID,
    weights: Sequence[float] = (0.75, 0.25),
    parallelism: int = 4,
    label: str = "label_index",
    at_once: int = GRID_FITS,
    **params,
) -> tuple[OneVsRestModel, DataFrame]:
    """Grid search for boosted one-vs-rest models; returns the best model and F1 and seconds per combination.

    The rows are split by `u` first and only the fitted part goes through `prepare` (class balance, say), so no
    copy of a row can be on both sides. `at_once` combinations are fitted side by side, each with `parallelism` binary models.
    """
    fit_side, check_side = _parts(train, u, weights, prepare, trees=1)

    def judged(chosen: dict) -> tuple[float, float, OneVsRestModel]:
        model, seconds = fit_timed(gbt_one_vs_rest(label, parallelism=parallelism, **{**params, **chosen}), fit_side)
        return test_metrics(score(model, check_side, (label,)), label)["f1"], seconds, model

    combinations = _grid(grid)
    found = run_grid(train.sparkSession, [lambda p=p: judged(p) for p in combinations], at_once)
    best = max(range(len(found)), key=lambda i: (found[i][0], -i))
    rows = [(*[str(v) for v in p.values()], f1, seconds) for p, (f1, seconds, _) in zip(combinations, found)]
    fields = ", ".join(f"{n} string" for n in grid)
    table = train.sparkSession.createDataFrame(rows, f"{fields}, f1 double, seconds double").orderBy(F.desc("f1"))
    return found[best][2], table


def nested_shares(
    train: DataFrame, fractions: Sequence[float], u: Column, trees: int = max(RF_GRID["numTrees"])
) -> list[DataFrame]:
    """A frame per entry of `fractions` with the rows whose `u` is below it, all of them reads of one table.

    The table is laid out by the ranges between the fractions, so a share reads the files of its ranges and no others. Parts are
    sized, and those of a long share read apart, as `store_for_fit` does for fits of `trees`.
    """
    edges = sorted(set(float(f) for f in fractions))
    ring = F.lit(len(edges))
    for i, edge in reversed(list(enumerate(edges))):
        ring = F.when(u < edge, i).otherwise(ring)
    marked = train.withColumn("_share", ring).filter(F.col("_share") < len(edges))
    sizes = {r["_share"]: r["count"] for r in marked.groupBy("_share").count().collect()}
    cores = train.sparkSession.sparkContext.defaultParallelism
    each = point_bytes(_width(train), trees)
    parts = {i: fit_parts(n, cores, each) for i, n in sizes.items()}
    groups = {i: -(-n // cores) for i, n in parts.items()}
    # every range in as many files as one fit has use for, with rows dealt evenly
    place, before = F.lit(0).cast("long"), 0
    group = F.lit(0).cast("long")
    for i, n in sorted(parts.items()):
        inside = F.pmod(F.xxhash64(F.lit("deal"), u), F.lit(n))
        place = F.when(F.col("_share") == i, inside + before).otherwise(place)
        group = F.when(F.col("_share") == i, inside % groups[i]).otherwise(group)
        before += n
    dealt = marked.withColumn("_fit_group", group.cast("int")).repartitionById(max(1, before), place.cast("int"))
    table = materialize(dealt, "shares", ("_share", "_fit_group"))
    shares = []
    for last in (edges.index(float(f)) for f in fractions):
        inner = [i for i in sorted(sizes) if i <= last]
        reads = [F.col("_share") <= last]
        if fit_parts(sum(sizes[i] for i in inner), cores, each) > cores:
            reads = [(F.col("_share") == i) & (F.col("_fit_group") == g) for i in inner for g in range(groups[i])]
        shares.append(reduce(DataFrame.unionAll, [table.filter(r).drop("_share", "_fit_group") for r in reads]))
    return shares


def learning_curve(
    train: DataFrame,
    test: DataFrame,
    u: Column,
    makers: Mapping[str, Callable[[], Estimator]],
    fractions: Sequence[float] = VOLUMES,
    label: str = "label_index",
    trees: int = max(RF_GRID["numTrees"]),
) -> DataFrame:
    """Rows, fit seconds and test F1 of each model (of at most `trees`) at growing shares of the training side."""
    rows = []
    for fraction, part in zip(fractions, nested_shares(train, fractions, u, trees)):
        n = part.count()
        for name, make in makers.items():
            model, seconds = fit_timed(make(), part)
            rows.append((name, float(fraction), n, seconds, test_metrics(score(model, test, (label,)), label)["f1"]))
    return train.sparkSession.createDataFrame(rows, "model string, frac double, n long, time double, f1 double")


def save_model(model: Model, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_forest(path: str) -> RandomForestClassificationModel:
    return RandomForestClassificationModel.load(path)


def load_one_vs_rest(path: str) -> OneVsRestModel:
    return OneVsRestModel.load(path)
