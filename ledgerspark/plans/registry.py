"""All registered telemetry queries: name -> Spark job, name -> equivalent SQL."""

from __future__ import annotations

import importlib
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerspark.plans.views import DUCK, SPARK, VIEWS, tables_of

MODULES = ("conform", "usage", "costs", "gitlog", "reviews", "outcomes", "corpus", "merges", "files", "streams")
_queries: dict[str, Callable] = {}
_oracles: dict[str, str] = {}


class Tables:
    """Given tables and the views over them, by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __call__(self, name: str) -> DataFrame:
        if name in VIEWS:
            sql = VIEWS[name](SPARK)
            return self.spark.sql(sql, **{t: self(t) for t in tables_of(sql)})
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def query(name: str, oracle: str | None = None):
    """Register a job over ``Tables``; names of views in its SQL become common table expressions."""

    def add(job: Callable[[Tables], DataFrame]):
        _queries[name] = lambda spark, sf_dir: job(Tables(spark, sf_dir))
        if oracle:
            _oracles[name] = with_views(oracle)
        return job

    return add


def with_views(sql: str) -> str:
    """Prefix DuckDB SQL with the views it names, inner ones first."""
    need: list[str] = []

    def visit(text: str) -> None:
        for v in VIEWS:
            if v not in need and re.search(rf"\b{v}\b", text):
                visit(re.sub(rf"\b{v}\b", " ", VIEWS[v](DUCK)))
                need.append(v)

    visit(sql)
    if not need:
        return sql
    ctes = ", ".join(f"{v} AS ({VIEWS[v](DUCK)})" for v in need)
    body = sql.strip()
    for head in ("WITH RECURSIVE ", "WITH "):
        if body.upper().startswith(head):
            return f"{head}{ctes}, {body[len(head):].strip()}"
    return f"WITH {ctes} {body}"


def _load() -> None:
    for m in MODULES:
        importlib.import_module(f"ledgerspark.plans.{m}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_oracles)
