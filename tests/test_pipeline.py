"""From warehouse tables to interpretation, with everything written and read."""

import pytest

from checks.features import wide_table
from tidemark import rules
from tidemark.operators.profile import split_types
from tidemark.plans.exploration import explore, write_reports
from tidemark.plans import modelling as mo
from tidemark.operators import prep as pp
from tidemark.session import stage
from tidemark.sources.io import read_csv, read_split

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def wide(spark):
    return stage(wide_table(spark, SF), "wide")


@pytest.fixture(scope="module")
def prepared(wide):
    return mo.prepare(wide)


@pytest.fixture(scope="module")
def fitted(prepared):
    return mo.fit_and_score(
        prepared, random_forest={"trees": 10, "depth": 6}, gradient_boosting={"rounds": 5, "depth": 3}
    )


def test_reports(spark, wide, tmp_path):
    reports = explore(wide)
    assert len(reports) == 17
    write_reports(reports, str(tmp_path))
    back = read_csv(spark, str(tmp_path / "cohort_summary"), "metric string, value double")
    values = {r.metric: r.value for r in back.collect()}
    assert values["rows"] == values["unique_stay_id"] == wide.count() and values["columns"] == 192
    assert len(split_types(wide.drop(*rules.EXCLUDED_FEATURES, rules.TARGET))[0]) == 171


def test_prepared(spark, prepared, tmp_path):
    names = prepared.preprocessor.feature_names
    assert len(set(names)) == len(names) > 171
    assert not set(names) & set(rules.EXCLUDED_FEATURES)
    mo.write_prepared(prepared, str(tmp_path))
    train = spark.read.parquet(str(tmp_path / "train_processed"))
    test = spark.read.parquet(str(tmp_path / "test_processed"))
    assert train.count() + test.count() == prepared.rows.count()
    assert train.columns[2:] == names
    split = read_split(spark, str(tmp_path / "split"), "stay_id long, split string")
    assert split.exceptAll(pp.split_table(prepared.rows, "stay_id")).isEmpty()
    assert pp.Preprocessor.load(spark, str(tmp_path / "preprocessor")) == prepared.preprocessor


def test_evaluate_and_interpret(spark, prepared, fitted, tmp_path):
    models, predictions = fitted
    mo.write_models(models, predictions, str(tmp_path / "models"))
    assert set(mo.load_models(str(tmp_path / "models"))) == set(models)
    reports = mo.evaluate(predictions)
    write_reports(reports, str(tmp_path / "evaluation"))
    summary = {r.model: r for r in reports["performance_summary"].collect()}
    assert set(summary) == set(models)
    for r in summary.values():
        assert 0 <= r.roc_auc <= 1 and 0 <= r.brier_score <= 1 and r.calibration_slope is not None
    assert reports["threshold_metrics"].count() == 3 * 19
    # All features and all models, as a user runs it; two repeats of each shuffle.
    names = prepared.preprocessor.feature_names
    found = mo.interpret(spark, prepared, models, predictions, n_repeats=2)
    write_reports(found, str(tmp_path / "interpretation"))
    read = lambda name: read_csv(spark, str(tmp_path / "interpretation" / name), found[name].schema).collect()
    assert {r.feature for r in read("logistic_coefficients")} == set(names)
    assert [r.side for r in read("logistic_top_features")].count("top") == 15
    importance = read("permutation_importance")
    assert {(r.model, r.feature) for r in importance} == {(m, n) for m in models for n in names}
    best = {n: max(r.importance_mean for r in importance if r.feature == n) for n in names}
    expected = sorted(names, key=lambda n: (-best[n], n))[:20]
    assert {r.feature for r in read("importance_comparison")} == set(expected)
    groups = read("subgroup_performance")
    assert {r.model for r in groups} == set(models)
    assert {r.subgroup for r in groups} <= set(rules.SUBGROUPS)
