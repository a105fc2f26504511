"""The catalogue: named queries over the driver's tables, each with the SQL that checks it.

An adapter turns driver tables into a domain table by one SELECT that both engines read after small dialect tokens are
filled in. A query gets the adapters as DataFrames and applies operators; its SQL names the adapters as CTEs.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strandloom.functions.workers import importable

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
ADAPTERS: dict[str, str] = {}
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: Dialect tokens of adapters: Spark's and the checking engine's spelling.
TOKENS = {
    "<ts>": ("date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")", "strftime(ts, '%Y-%m-%dT%H:%M:%SZ')"),
    "<array>": ("array", "list_value"),
    "<strings>": ("array<string>", "varchar[]"),
    "<json_k>": ("get_json_object(props, '$.k')", "json_extract_string(props, '$.k')"),
}


def adapter(name: str, sql: str) -> None:
    ADAPTERS[name] = sql.strip()


def _spelled(sql: str, engine: int) -> str:
    for token, both in TOKENS.items():
        sql = sql.replace(token, both[engine])
    return sql


def _names(sql: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", sql)))


class Tables:
    """Driver tables and adapters by attribute, read or planned when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir, self._made = spark, sf_dir, {}
        importable(spark)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._made:
            if name in ADAPTERS:
                sql = _spelled(ADAPTERS[name], 0)
                self._made[name] = self._spark.sql(sql, **{n: getattr(self, n) for n in _names(sql)})
            else:
                self._made[name] = self._spark.read.parquet(f"{self._dir}/{name}.parquet")
        return self._made[name]

    def rows(self, sql: str) -> DataFrame:
        """A table from SQL over adapters in braces."""
        sql = _spelled(sql, 0)
        return self._spark.sql(sql, **{n: getattr(self, n) for n in _names(sql)})


def oracle(sql: str) -> str:
    """The SQL with the adapters that it names, and theirs, as CTEs."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in _names(text):
            if name in ADAPTERS and name not in order:
                visit(ADAPTERS[name])
                order.append(name)

    visit(sql)
    plain = lambda text: re.sub(r"\{(\w+)\}", r"\1", _spelled(text, 1))
    ctes = [f"{name} AS ({plain(ADAPTERS[name])})" for name in order]
    body = plain(sql).strip()
    if body.upper().startswith("WITH "):
        return f"WITH {', '.join([*ctes, body[5:]])}"
    return f"WITH {', '.join(ctes)} {body}" if ctes else body


def query(name: str, make: Callable[[Tables], DataFrame], sql: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"{name} is registered twice")
    QUERIES[name] = lambda spark, sf_dir: make(Tables(spark, sf_dir))
    if sql:
        ORACLES[name] = oracle(sql)
