"""Registration, SQL twins, and the folder's independence."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from checks.compare import rows_of
from tidemark.llm.queries import ORACLE_SQL, QUERIES

TOP = Path(__file__).resolve().parents[2]


def test_every_operator_is_registered_once():
    numbers = [int(name[2:].split("_")[0]) for name in QUERIES]
    assert sorted(numbers) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLE_SQL) <= set(QUERIES) and set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_its_twin(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    twin = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in twin.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    assert rows_of(df.collect(), df.columns, order) == rows_of(twin.fetchall(), names, order)


def test_nothing_else_imports_this_folder():
    for file in TOP.rglob("*.py"):
        inside = "llm" in file.relative_to(TOP).parts or file.name in ("corpus_pipeline.py", "__spark_entry__.py")
        assert inside or "tidemark.llm" not in file.read_text(), file


def test_native_operators_hold_no_python_functions():
    for name in ("mixing", "secret_scan", "pii", "spans", "warc", "html_text"):
        text = (TOP / "tidemark" / "llm" / f"{name}.py").read_text()
        assert not any(word in text for word in ("in_arrow", "mapIn", "udf", "applyIn", "import pandas", ".rdd")), name
