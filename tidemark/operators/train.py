"""Three classifiers on a (key, label, features) table, and their scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from hashlib import md5

from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    LogisticRegressionModel,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from tidemark.operators.metrics import SUFFIX, ranking_metrics, to_long
from tidemark.operators.prep import with_class_weight
from tidemark.operators.ranking import hash_order
from tidemark.session import use_checkpoints

MODEL_CLASSES = {
    "logistic_regression": LogisticRegressionModel,
    "random_forest": RandomForestClassificationModel,
    "gradient_boosting": GBTClassificationModel,
}

# Trees that are grown together, and the numbers (rows times features) of a task then.
TREES_A_FIT = 32
TASK_CELLS = 1 << 25


def train_logistic(train: DataFrame, label: str, c: float = 1.0, max_iter: int = 2000) -> LogisticRegressionModel:
    """L2 logistic regression with balanced classes.

    The penalty is stated as 1/C over a summed loss; Spark averages the loss, so
    C is scaled by the total weight, which balancing leaves at the row count.
    """
    weighted = with_class_weight(train, label)
    return LogisticRegression(
        labelCol=label,
        weightCol="weight",
        regParam=1.0 / (c * train.count()),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=max_iter,
        tol=1e-8,
    ).fit(weighted)


def logistic_gradient(
    model: LogisticRegressionModel, train: DataFrame, label: str, names: Sequence[str], c: float = 1.0
) -> DataFrame:
    """(feature, gradient): the slope of the loss that `train_logistic` minimises at
    the fit, per feature and for the intercept, as a share of the total weight. All
    are 0 at the optimum. One pass; entries of a vector are added up map-side.
    """
    weighted = model.transform(with_class_weight(train, label))
    off = vector_to_array("probability")[1] - F.col(label)
    rows = weighted.select(F.col("weight"), (F.col("weight") * off).alias("_off"), vector_to_array("features").alias("_x"))
    entries = F.concat(F.col("_x"), F.array(F.lit(1.0)))
    sums = rows.select("weight", "_off", F.posexplode(entries).alias("_i", "_v")).groupBy("_i").agg(
        F.sum(F.col("_off") * F.col("_v")).alias("_sum"), F.sum("weight").alias("_total")
    )
    spark = train.sparkSession
    # One row per feature.
    fitted = [*zip(names, model.coefficients.toArray().tolist()), ("intercept", 0.0)]
    table = spark.createDataFrame([(i, n, w / c) for i, (n, w) in enumerate(fitted)], "_i int, feature string, _pull double")
    joined = sums.join(F.broadcast(table), "_i")
    return joined.select("feature", ((F.col("_sum") + F.col("_pull")) / F.col("_total")).alias("gradient"))


def train_forest(
    train: DataFrame,
    label: str,
    trees: int = 500,
    min_leaf: int = 5,
    depth: int = 30,
    seed: int = 42,
    bootstrap: bool = True,
) -> RandomForestClassificationModel:
    """Balanced random forest; 30 is the deepest tree Spark grows.

    Node statistics are merged from all tasks for a bounded group of nodes at a
    time, so memory does not grow with the rows. Every task holds those of all nodes
    of the group, mostly zeros deep in a tree, and all are merged; so rows lie in as few
    tasks as TASK_CELLS allows, and TREES_A_FIT trees at a time are grown side by side
    where that leaves cores free. Rows and trees alone say how they are dealt out.
    """
    rows = with_class_weight(train, label)
    vector = rows.select("features").first()
    if vector:
        rows = rows.coalesce(max(1, -(-train.count() * vector.features.size // TASK_CELLS)))

    def grow(part: int) -> RandomForestClassificationModel:
        return RandomForestClassifier(
            labelCol=label,
            weightCol="weight",
            numTrees=min(TREES_A_FIT, trees - part * TREES_A_FIT),
            minInstancesPerNode=min_leaf,
            featureSubsetStrategy="sqrt",
            maxDepth=depth,
            maxMemoryInMB=1024,
            bootstrap=bootstrap,
            seed=_part_seed(seed, part),
        ).fit(rows)

    parts = max(1, -(-trees // TREES_A_FIT))
    at_once = max(1, train.sparkSession.sparkContext.defaultParallelism // rows.rdd.getNumPartitions())
    with ThreadPoolExecutor(min(parts, at_once)) as pool:
        return _one_forest(list(pool.map(inheritable_thread_target(train.sparkSession)(grow), range(parts))))


def _part_seed(seed: int, part: int) -> int:
    """The first part has the seed itself."""
    return int(md5(f"{seed}:{part}".encode()).hexdigest()[:15], 16) if part else seed


def _one_forest(parts: Sequence[RandomForestClassificationModel]) -> RandomForestClassificationModel:
    """The trees of all parts as one model."""
    if len(parts) == 1:
        return parts[0]
    grown = [tree for part in parts for tree in part._java_obj.trees()]
    first, sc = parts[0]._java_obj, SparkContext._active_spark_context
    kind = sc._jvm.org.apache.spark.ml.classification
    array = sc._gateway.new_array(kind.DecisionTreeClassificationModel, len(grown))
    for i, tree in enumerate(grown):
        array[i] = tree
    forest = RandomForestClassificationModel(
        kind.RandomForestClassificationModel(first.uid(), array, first.numFeatures(), first.numClasses())
    )
    forest = parts[0]._copyValues(forest)._set(numTrees=len(grown))
    forest._transfer_params_to_java()
    return forest


def train_boosting(
    train: DataFrame,
    label: str,
    rounds: int = 300,
    rate: float = 0.05,
    depth: int = 5,
    bins: int = 255,
    seed: int = 42,
    validation: float = 0.0,
    key: str | None = None,
    tolerance: float = 0.01,
) -> GBTClassificationModel:
    """Gradient-boosted trees, unweighted; depth 5 allows 32 leaves.

    With a `validation` share, that part of the rows, drawn by a seeded hash of
    `key`, is not fitted; boosting stops once its loss no longer falls by
    `tolerance` of itself, and keeps the best round. Every tenth round is
    checkpointed, so a lost executor costs ten rounds at most.
    """
    use_checkpoints(train.sparkSession)
    booster = GBTClassifier(
        labelCol=label,
        maxIter=rounds,
        stepSize=rate,
        maxDepth=depth,
        maxBins=bins,
        minInstancesPerNode=20,
        checkpointInterval=10,
        seed=seed,
    )
    if not validation:
        return booster.fit(train)
    if key is None or not 0 < validation < 1:
        raise ValueError("a validation share lies between 0 and 1 and needs a key")
    cut = f"{int(validation * 16**8):08x}"
    held = train.withColumn("_held", F.substring(hash_order(key, seed), 1, 8) < F.lit(cut))
    booster = booster.setValidationIndicatorCol("_held")
    return booster.setParams(validationTol=tolerance).fit(held)


def train_all(train: DataFrame, label: str, **options: Mapping) -> dict[str, Model]:
    """All three; `options` holds keyword arguments by model name."""
    return {
        "logistic_regression": train_logistic(train, label, **options.get("logistic_regression", {})),
        "random_forest": train_forest(train, label, **options.get("random_forest", {})),
        "gradient_boosting": train_boosting(train, label, **options.get("gradient_boosting", {})),
    }


def score(models: Mapping[str, Model], df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """`<model>_probability` of the positive class per row.

    Models are applied one after the other to the same row: no join, no shuffle.
    """

    def add(frame: DataFrame, item: tuple[str, Model]) -> DataFrame:
        name, model = item
        scored = model.transform(frame)
        positive = vector_to_array("probability")[1].alias(f"{name}{SUFFIX}")
        done = [c for c in frame.columns if c.endswith(SUFFIX)]
        return scored.select(*keep, "features", *done, positive)

    return reduce(add, models.items(), df.select(*keep, "features")).drop("features")


def model_summary(predictions: DataFrame, y: str) -> DataFrame:
    """AUROC and average precision per model of a wide prediction table."""
    return ranking_metrics(to_long(predictions, y))


def save_model(model: Model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(name: str, path: str) -> Model:
    return MODEL_CLASSES[name].load(path)
