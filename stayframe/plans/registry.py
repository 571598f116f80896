"""Query registry: name -> (Spark plan builder, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            return round_doubles(fn(spark, sf_dir))

        build.__name__ = fn.__name__
        build.__doc__ = fn.__doc__
        QUERIES[name] = Query(name, build, sql)
        return fn
    return deco


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round floating outputs to 6 places (the oracles do the same) and
    widen float to double."""
    exprs = []
    for f in df.schema.fields:
        q = "`" + f.name.replace("`", "``") + "`"
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            exprs.append(f"round(CAST({q} AS DOUBLE), {digits}) AS {q}")
        else:
            exprs.append(q)
    return df.selectExpr(*exprs)   # one driver round trip for any width


def round_sql(sql: str, double_cols: list[str], digits: int = 6) -> str:
    """Wrap an oracle statement so the listed columns are rounded."""
    if not double_cols:
        return sql
    rep = ", ".join(f'round(CAST("{c}" AS DOUBLE), {digits}) AS "{c}"' for c in double_cols)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) q"
