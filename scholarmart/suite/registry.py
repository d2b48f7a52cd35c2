"""Registered queries and their SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from scholarmart.session import configure
from scholarmart.suite.roles import ROLE_SQL, Roles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
_ROLE_NAMES = re.compile(r"\b(" + "|".join(sorted(ROLE_SQL, key=len, reverse=True)) + r")\b")


def with_roles(body: str) -> str:
    """Put the definitions of the roles a statement uses in front of it."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name in _ROLE_NAMES.findall(sql):
            if name not in needed:
                visit_role(name)

    def visit_role(name: str) -> None:
        for inner in _ROLE_NAMES.findall(ROLE_SQL[name]):
            if inner != name and inner not in needed:
                visit_role(inner)
        if name not in needed:
            needed.append(name)

    visit(body)
    if not needed:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({ROLE_SQL[n]})" for n in needed) + f"\nSELECT * FROM ({body})"


def query(name: str, sql: str | None = None):
    """Register a query; its function receives the roles."""

    def register(function: Callable[[Roles], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(Roles(configure(spark), sf_dir))

        run.__name__ = name
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = with_roles(sql)
        return function

    return register


def rnd(expression: str, digits: int) -> str:
    """SQL that rounds half away from zero on the decimal value."""
    return f"(CAST(round(CAST({expression} AS DECIMAL(28,10)), {digits}) AS DOUBLE) + CAST(0 AS DOUBLE))"
