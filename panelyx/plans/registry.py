"""Named queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f: Callable) -> Callable:
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def clean(x: Column, places: int = 6) -> Column:
    """Rounded; NaN and infinities are NULL."""
    x = x.cast("double")
    return F.round(F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x), places)


def tidy(df: DataFrame, keys: list[str], values: list[str], places: int = 6) -> DataFrame:
    return df.select(*keys, *(clean(F.col(v), places).alias(v) for v in values))


def sql_clean(x: str, name: str, places: int = 6) -> str:
    return f"round(CASE WHEN isfinite(CAST({x} AS DOUBLE)) THEN CAST({x} AS DOUBLE) END, {places}) AS {name}"


def sql_tidy(keys: str, values: list[str], source: str, places: int = 6) -> str:
    return f"SELECT {keys}, {', '.join(sql_clean(v, v, places) for v in values)} FROM {source}"
