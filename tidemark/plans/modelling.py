"""Prepare, train, evaluate and interpret, from one wide table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark import rules
from tidemark.operators import explain as ex, metrics as me, prep as pp, train as tr
from tidemark.operators.profile import assert_clean, duplicate_rows, require_valid_target, split_types
from tidemark.session import stage
from tidemark.sources.io import write_csv, write_json, write_table


@dataclass(frozen=True)
class Prepared:
    """Rows with their split, the fitted preprocessor and the feature vectors."""

    rows: DataFrame
    preprocessor: pp.Preprocessor
    vectors: DataFrame
    key: str
    target: str

    @property
    def train(self) -> DataFrame:
        return self.vectors.filter(F.col("split") == "train")

    @property
    def test(self) -> DataFrame:
        return self.vectors.filter(F.col("split") == "test")


def prepare(
    wide: DataFrame,
    key: str = "stay_id",
    target: str = rules.TARGET,
    exclude: Sequence[str] = rules.EXCLUDED_FEATURES,
    fraction: float = 0.2,
    seed: int = 42,
) -> Prepared:
    """Validate, split, fit on the training rows, transform both (runs jobs).

    Excluded columns stay on `rows` for joins and audit; they are never features.
    """
    rows = stage(pp.stratified_split(require_valid_target(wide, target), target, key, fraction, seed), "split")
    train = rows.filter(F.col("split") == "train")
    banned = [*exclude, key, target, "split"]
    numeric, categorical = split_types(rows, banned)
    fitted = pp.Preprocessor.fit(train, numeric, categorical, banned)
    labelled = rows.withColumn("y", F.col(target).cast("int"))
    vectors = stage(fitted.transform_vector(labelled, [key, "y", "split"]), "vectors")
    return Prepared(rows, fitted, vectors, key, target)


def write_prepared(prepared: Prepared, folder: str) -> None:
    """Processed tables, split membership, feature names, summary, fitted state."""
    spark, fitted = prepared.rows.sparkSession, prepared.preprocessor
    for part in ("train", "test"):
        rows = prepared.rows.filter(F.col("split") == part)
        processed = fitted.transform(rows, [prepared.key, prepared.target])
        write_table(processed, f"{folder}/{part}_processed")
        assert_clean(spark.read.schema(processed.schema).parquet(f"{folder}/{part}_processed"), fitted.feature_names)
    names = [(i, n) for i, n in enumerate(fitted.feature_names)]
    write_json(spark.createDataFrame(names, "position int, feature string"), f"{folder}/feature_names")
    write_json(pp.split_table(prepared.rows, prepared.key), f"{folder}/split")
    summary = pp.prep_summary(prepared.rows, prepared.target, fitted)
    features = [c for f in (fitted.numeric, fitted.categorical) for c in (x.column for x in f)]
    write_json(summary, f"{folder}/summary")
    write_json(duplicate_rows(prepared.rows, features), f"{folder}/duplicate_feature_rows")
    fitted.save(spark, f"{folder}/preprocessor")


def fit_and_score(prepared: Prepared, **options: Mapping) -> tuple[dict[str, Model], DataFrame]:
    """All models and the wide prediction table of the test rows (runs jobs)."""
    models = tr.train_all(prepared.train, "y", **options)
    scores = tr.score(models, prepared.test, [prepared.key, "y"]).withColumnRenamed("y", "y_true")
    return models, stage(scores, "predictions")


def write_models(models: Mapping[str, Model], predictions: DataFrame, folder: str) -> None:
    for name, model in models.items():
        tr.save_model(model, f"{folder}/{name}")
    write_csv(predictions, f"{folder}/test_predictions")
    write_csv(tr.model_summary(predictions, "y_true"), f"{folder}/model_summary")


def load_models(folder: str, names: Sequence[str] = tuple(tr.MODEL_CLASSES)) -> dict[str, Model]:
    return {name: tr.load_model(name, f"{folder}/{name}") for name in names}


def evaluate(predictions: DataFrame, threshold: float = 0.5) -> dict[str, DataFrame]:
    """Report name -> table, from a prediction table with `y_true`."""
    long = me.to_long(predictions)
    models = [c.removesuffix(me.SUFFIX) for c in predictions.columns if c.endswith(me.SUFFIX)]
    sweep = me.threshold_sweep(long)
    at_half = me.threshold_metrics(long, threshold)
    return {
        "performance_summary": me.performance_summary(me.performance(long), me.calibration_slope(long, models)),
        "threshold_metrics": sweep,
        "threshold_series": me.threshold_series(sweep),
        "metrics_at_threshold": at_half,
        "confusion_matrices": me.confusion_cells(at_half),
        "roc_curves": me.roc_curve(long),
        "precision_recall_curves": me.pr_curve(long),
        "prevalence": me.event_rate(long),
        "calibration_curves": me.calibration_curve(long),
    }


def interpret(
    spark: SparkSession,
    prepared: Prepared,
    models: Mapping[str, Model],
    predictions: DataFrame,
    n_repeats: int = 10,
    subgroups: Mapping[str, str] = rules.SUBGROUPS,
) -> dict[str, DataFrame]:
    """Coefficients, permutation importance and subgroup performance (runs jobs)."""
    names = prepared.preprocessor.feature_names
    coefficients = ex.coef_table(spark, models["logistic_regression"], names)
    importance = ex.importance_all(models, prepared.test, "y", prepared.key, names, n_repeats=n_repeats)
    return {
        "logistic_coefficients": coefficients,
        "logistic_top_features": ex.top_bottom(coefficients, "coefficient"),
        "permutation_importance": importance,
        "importance_comparison": ex.compare_importance(importance, list(models)),
        "subgroup_performance": subgroups_of(prepared, predictions, subgroups),
    }


def subgroups_of(prepared: Prepared, predictions: DataFrame, subgroups: Mapping[str, str], min_n: int = 50) -> DataFrame:
    """Subgroup performance of scored test rows, by rules over the raw columns.

    A rule is worked out where its columns are; one that names an unknown column
    raises.
    """
    attributes = prepared.rows.drop("split", prepared.target)
    members = {f"member_{i}": group for i, group in enumerate(subgroups)}
    flags = attributes.select(prepared.key, *[F.expr(subgroups[g]).alias(flag) for flag, g in members.items()])
    long = ex.attach(me.to_long(predictions, keep=[prepared.key]), flags, prepared.key)
    return ex.subgroup_performance(long, {group: flag for flag, group in members.items()}, min_n=min_n)
