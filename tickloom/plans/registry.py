"""Named queries and the SQL each one is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def plain_zero(sql: str) -> str:
    """Add 0 to every ``round(...)``: DuckDB rounds a small negative number to -0.0, Spark to 0.0."""
    out, at = [], 0
    while (start := sql.find("round(", at)) >= 0:
        depth, end = 1, start + len("round(")
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        out.append(f"{sql[at:start]}(round({plain_zero(sql[start + 6:end - 1])}) + 0)")
        at = end
    return "".join(out) + sql[at:]


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = plain_zero(oracle)
        return fn
    return register


def rounded(digits: int, *names: str) -> list[Column]:
    return [F.round(n, digits).alias(n) for n in names]


def sql_rounded(digits: int, *names: str) -> str:
    return ", ".join(f"round({n}, {digits}) AS {n}" for n in names)
