"""Registered queries: a function of the roles, and the SQL that checks it where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from supplyloom.queries.roles import Roles
from supplyloom.session import apply_defaults

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Dates and times as text, decimals as doubles, booleans as 0/1, so that engines compare alike."""
    picked = []
    for name, kind in df.dtypes:
        col = F.col(f"`{name}`")
        if kind in ("date", "timestamp", "timestamp_ntz"):
            col = col.cast("string")
        elif kind.startswith("decimal"):
            col = col.cast("double")
        elif kind == "boolean":
            col = col.cast("int")
        picked.append(col.alias(name))
    return df.select(*picked)


def query(name: str, sql: str | None = None):
    def register(build: Callable[[Roles], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain(build(Roles(apply_defaults(spark), folder)))

        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return build

    return register
