"""Registers a query with its output columns and its SQL twin.

The column list is shared: `name:i` is a whole number, `name:f` a double rounded to six
digits, `name:f2` to two, `name:a` an array shown as text, no suffix leaves it alone."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from checks.fragments import FRAGMENTS

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def _parse(columns: str) -> list[tuple[str, str]]:
    return [(c.split(":") + [""])[:2] for c in columns.split()]


def _spark_column(name: str, kind: str):
    c = F.col(name)
    if kind == "i":
        return c.cast("bigint").alias(name)
    if kind.startswith("f"):
        return F.round(c.cast("double"), int(kind[1:] or 6)).alias(name)
    if kind == "a":
        return F.array_join(c, "|").alias(name)
    return c


def _sql_column(name: str, kind: str) -> str:
    if kind == "i":
        return f"{name}::BIGINT AS {name}"
    if kind.startswith("f"):
        return f"round({name}::DOUBLE, {int(kind[1:] or 6)}) AS {name}"
    if kind == "a":
        return f"array_to_string({name}, '|') AS {name}"
    return name


def with_fragments(body: str) -> str:
    """Prefix the named fragments a statement mentions, dependencies first."""
    done: list[str] = []

    def need(text: str) -> None:
        for name, sql in FRAGMENTS.items():
            if name not in done and re.search(rf"\b{name}\b", text):
                need(sql)
                if name not in done:
                    done.append(name)

    need(body)
    ctes = ",\n".join(f"{name} AS ({FRAGMENTS[name]})" for name in done)
    return f"WITH {ctes}\n{body}" if ctes else body


def check(columns: str, sql: str | None = None):
    """Register a function `(spark, sf_dir) -> DataFrame` under its own name."""
    spec = _parse(columns)

    def register(fn):
        def run(spark, sf_dir):
            return fn(spark, sf_dir).select(*[_spark_column(n, k) for n, k in spec])

        run.__name__ = fn.__name__
        QUERIES[fn.__name__] = run
        if sql is not None:
            outer = ", ".join(_sql_column(n, k) for n, k in spec)
            body = with_fragments(f"SELECT {outer} FROM (\n{sql}\n) AS result")
            ORACLES[fn.__name__] = body
        return run

    return register
