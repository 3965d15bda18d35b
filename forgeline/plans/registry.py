"""Query registry: one entry per inventory ID, a Spark plan and its DuckDB restatement.

Each entry names the double-typed output columns; both sides round them to
6 decimals (summation order differs between engines).  Queries read the
driver tables through ``Domain`` at the given scale directory.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgeline.plans.oracle_sql import r2, with_ctes
from forgeline.sources.tables import Domain


@dataclass
class Query:
    name: str
    build: Callable[[Domain], DataFrame]
    sql: str | None
    doubles: list[str] = field(default_factory=list)
    doc: str = ""


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None, doubles: list[str] | None = None,
             ctes: list[str] | None = None):
    """Decorator: add a Spark plan builder with its oracle (``None`` = rows-only check)."""
    def deco(fn: Callable[[Domain], DataFrame]):
        body = None
        if sql is not None:
            body = with_ctes(ctes, sql) if ctes else sql
            if doubles:
                body = (f"SELECT * REPLACE ({', '.join(f'{r2(c, 6)} AS {c}' for c in doubles)}) "
                        f"FROM ({body}) __out")
        REGISTRY[name] = Query(name, fn, body, list(doubles or []), (fn.__doc__ or "").strip())
        return fn
    return deco


def spark_callable(q: Query) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = q.build(Domain(spark, sf_dir))
        for c in q.doubles:
            df = df.withColumn(c, F.round(F.col(c), 6))
        return df
    run.__name__ = q.name
    run.__doc__ = q.doc
    return run


def load_all() -> dict[str, Query]:
    """Import every module that registers queries."""
    # in this order: later modules use the SQL that earlier ones define
    from forgeline.plans import queries_etl, queries_quality, queries_eval, queries_scoring  # noqa: F401
    from forgeline.plans import queries_ml, queries_stream, queries_io, queries_analytics  # noqa: F401
    return REGISTRY
