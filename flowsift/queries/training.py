"""Training, tuning and scoring. Results are fitted models, so there is no SQL to compare with."""

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from flowsift.functions.hashing import fast_uniform
from flowsift.operators import evaluate, sampling, training
from flowsift.operators.training import store_for_fit
from flowsift.plans.modelling import prepare_sides
from flowsift.queries.registry import query, table
from flowsift.queries.views import feat
from flowsift.session import materialize, scratch_path

# Small ensembles: the queries are about the work around them.
FOREST = {"numTrees": 20, "maxDepth": 5}
BOOSTED = {"maxIter": 3, "maxDepth": 3}


def _vectors(spark, folder):
    """Embeddings as features, their label as class, split 80/20 by the key."""
    rows = table(spark, folder, "embeddings").select(
        "vec_id", F.col("label").cast("double").alias("label_index"), array_to_vector(F.col("embedding").cast("array<double>")).alias("features")
    )
    return sampling.split(rows, fast_uniform(42, "vec_id"), "label_index")


def _stored(spark, folder):
    train, test = _vectors(spark, folder)
    return store_for_fit(train, "train", trees=FOREST["numTrees"]), materialize(test, "test")


@query("ml_rf_predict")
def ml_rf_predict(spark, folder):
    train, test = _stored(spark, folder)
    return training.score(training.random_forest(**FOREST).fit(train), test, ("vec_id", "label_index"))


@query("ml_rf_tune")
def ml_rf_tune(spark, folder):
    train, _ = _stored(spark, folder)
    grid = {"numTrees": (5, 10), "maxDepth": (3, 5), "featureSubsetStrategy": ("sqrt", "log2")}
    return training.tune_forest(train, fast_uniform(6, "vec_id"), grid=grid)[1]


@query("ml_rf_tune_balanced")
def ml_rf_tune_balanced(spark, folder):
    """The same grid, the fitted part balanced and the checked part as it is."""
    train, _ = _stored(spark, folder)
    grid = {"numTrees": (5, 10), "maxDepth": (3, 5), "featureSubsetStrategy": ("sqrt", "log2")}

    def prepare(part):
        return sampling.balance(part, fast_uniform(8, "vec_id"), "label_index")

    return training.tune_forest(train, fast_uniform(6, "vec_id"), prepare, grid)[1]


@query("ml_gbt_ovr_predict")
def ml_gbt_ovr_predict(spark, folder):
    train, test = _stored(spark, folder)
    model = training.gbt_one_vs_rest(parallelism=8, **BOOSTED).fit(train)
    return training.score(model, test, ("vec_id", "label_index"))


@query("ml_gbt_tune")
def ml_gbt_tune(spark, folder):
    """All eight combinations of small models, balanced only on the fitted part."""
    train, _ = _stored(spark, folder)
    u = fast_uniform(7, "vec_id")

    def prepare(part):
        return materialize(sampling.balance(part, fast_uniform(8, "vec_id"), "label_index"), "balanced")

    grid = {"maxIter": (1, 2), "maxDepth": (2, 3), "stepSize": (0.05, 0.1)}
    return training.tune_gbt(train, u, prepare, grid, parallelism=8)[1]


@query("ml_score")
def ml_score(spark, folder):
    train, test = _stored(spark, folder)
    path = training.save_model(training.random_forest(**FOREST).fit(train), scratch_path(spark, "forest"))
    return training.score(training.load_forest(path), test, ("vec_id", "label_index"))


@query("model_roundtrip_truth", "SELECT true AS any_rows, true AS all_same")
def model_roundtrip_truth(spark, folder):
    return model_roundtrip(spark, folder).select((F.col("n_rows") > 0).alias("any_rows"), (F.col("n_rows") == F.col("n_same")).alias("all_same"))


@query("ml_rf_truth", "SELECT true AS all_scored, true AS scores_sum_to_one, true AS predicts_the_best")
def ml_rf_truth(spark, folder):
    """What must hold of any fitted forest: every row is scored, its scores sum to one, and the prediction is the best class."""
    train, test = _stored(spark, folder)
    scored = training.score(training.random_forest(**FOREST).fit(train), test, ("vec_id", "label_index"))
    total = F.aggregate("scores", F.lit(0.0), lambda a, x: a + x)
    return scored.agg(
        (F.count(F.lit(1)) == test.agg(F.count(F.lit(1))).scalar()).alias("all_scored"),
        F.bool_and(F.abs(total - 1) < 1e-5).alias("scores_sum_to_one"),
        F.bool_and(F.get("scores", F.col("prediction").cast("int")) == F.array_max("scores")).alias("predicts_the_best"),
    )


@query("model_roundtrip")
def model_roundtrip(spark, folder):
    """Rows whose prediction changes when the model is saved and loaded: none may."""
    train, test = _stored(spark, folder)
    model = training.random_forest(numTrees=5, maxDepth=4).fit(train)
    back = training.load_forest(training.save_model(model, scratch_path(spark, "forest")))
    sides = [
        training.score(m, test, ("vec_id",)).select("vec_id", F.col("prediction").alias(name))
        for name, m in (("before", model), ("after", back))
    ]
    same = F.count_if(F.col("before") == F.col("after"))
    return sides[0].join(sides[1], "vec_id").agg(F.count(F.lit(1)).alias("n_rows"), same.alias("n_same"))


@query("ml_leaderboard")
def ml_leaderboard(spark, folder):
    train, test = _stored(spark, folder)
    makers = {
        "RF": training.random_forest(**FOREST),
        "GBT OVR": training.gbt_one_vs_rest(parallelism=8, maxIter=2, maxDepth=2),
    }
    return training.fit_and_judge(makers, train, test)[1]


@query("ml_learning_curve")
def ml_learning_curve(spark, folder):
    train, test = _stored(spark, folder)
    makers = {
        "rf": lambda: training.random_forest(numTrees=5, maxDepth=4),
        "gbt": lambda: training.gbt_one_vs_rest(parallelism=8, maxIter=1, maxDepth=2),
    }
    return training.learning_curve(train, test, fast_uniform(9, "vec_id"), makers, trees=5)


@query("ml_roc_of_margins")
def ml_roc_of_margins(spark, folder):
    """Area under the ROC curve of boosted one-vs-rest models, from their margins."""
    train, test = _stored(spark, folder)
    scored = training.score(training.gbt_one_vs_rest(parallelism=8, maxIter=2, maxDepth=2).fit(train), test)
    return evaluate.roc_auc(evaluate.ranked_scores(evaluate.scores_long(scored, "scores")))


@query("ml_prepared_sides")
def ml_prepared_sides(spark, folder):
    """Split, scaling on train, balance of train: rows per class and side."""
    from flowsift.operators.features import label_index

    gold = label_index(feat(spark, folder), "rarity")
    sides = prepare_sides(gold, ["quantity", "price", "discount", "tax"])
    frames = [("train", sides.train), ("balanced", sides.balanced), ("test", sides.test)]
    parts = [df.select(F.lit(name).alias("side"), "label_index") for name, df in frames]
    counted = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return counted.groupBy("side", "label_index").agg(F.count(F.lit(1)).alias("n_rows"))
