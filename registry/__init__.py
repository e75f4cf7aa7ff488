"""Registered queries: every operator on the given tables, with the equivalent SQL where there is one."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator: enter a query under ``name``, with its SQL if given."""
    def enter(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run
    return enter


def load_all() -> None:
    from registry import (  # noqa: F401
        columns, dedup, filelayer, gold, increments, jobs, quality, rules, scalars, scans, streams, versions)
