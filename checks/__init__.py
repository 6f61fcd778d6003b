"""Registered queries over the driver's tables, each with its DuckDB twin."""


def all_checks():
    from checks import explaining, features, ingest, modelling, profiling, scoring  # noqa: F401
    from checks.registry import QUERIES

    return QUERIES
