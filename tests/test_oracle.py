"""Every registered query with a twin gives the twin's rows."""

import pytest

from checks import all_checks, modelling
from checks.compare import compare

# The fits of the registered queries have the library's own sizes.
modelling.MODELS["random_forest"].update(trees=10, depth=5)
modelling.MODELS["gradient_boosting"].update(rounds=5)

WITH_TWIN = [name for name, (_, sql) in all_checks().items() if sql]
ROWS_ONLY = [name for name, (_, sql) in all_checks().items() if not sql]


@pytest.mark.parametrize("name", WITH_TWIN)
def test_matches_twin(spark, con, sf, name):
    verdict, _, _ = compare(spark, con, sf, name)
    assert verdict == "ok"


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_has_rows(spark, con, sf, name):
    _, _, n = compare(spark, con, sf, name)
    assert n > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert len(e.entry(spark).columns) == 192
    assert set(e.oracle_sql()) <= set(e.queries())
