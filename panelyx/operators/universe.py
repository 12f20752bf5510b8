"""Universe: which names may be held on which date. Every mask is a table of (td, tk); they combine by semi- and anti-joins."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import interval_join

KEYS = ["td", "tk"]


def listed(days: DataFrame, names: DataFrame, n: int = 365, *, start: str = "list_dt", end: str = "delist_dt") -> DataFrame:
    """Dates from n calendar days after listing to the delisting (NULL: still listed)."""
    return interval_join(days, names.withColumn("__start", F.date_add(start, n)), "__start", end).select(*KEYS)


def thinly_traded(panel: DataFrame, w: int = 20, traded: Column | None = None) -> DataFrame:
    """Rows with a bar in the last w positions that did not trade: low, amount and volume not all over 1."""
    good = traded if traded is not None else (F.col("low") > 1) & (F.col("amount") > 1) & (F.col("volume") > 1)
    last = Window.partitionBy("tk").orderBy("ix").rangeBetween(-(w - 1), 0)
    bad = F.max((~F.coalesce(good, F.lit(False))).cast("int")).over(last)
    return panel.withColumn("__bad", bad).filter((F.col("__bad") == 1) & (F.col("ix") >= w - 1)).select(*KEYS)


def special_treatment(days: DataFrame, intervals: DataFrame, *, start: str = "entry_dt", end: str = "remove_dt", kind: str = "kind", lifted: str = "R") -> DataFrame:
    """Dates inside an interval of any kind but the one that lifts the treatment."""
    return interval_join(days, intervals.filter(F.col(kind) != lifted), start, end).select(*KEYS).distinct()


def suspended(status: DataFrame, code: str = "status") -> DataFrame:
    return status.filter(F.col(code) == 0).select(*KEYS)


def price_limited(panel: DataFrame, *, close: str = "close", up: str = "up_limit", down: str = "down_limit") -> DataFrame:
    """Rows whose next calendar position closes at a limit, or that have no next position: they cannot be traded then."""
    ahead = Window.partitionBy("tk").orderBy("ix").rangeBetween(1, 1)
    hit = F.max(((F.col(close) >= F.col(up)) | (F.col(close) <= F.col(down))).cast("int")).over(ahead)
    return panel.withColumn("__hit", hit).filter(F.coalesce("__hit", F.lit(1)) == 1).select(*KEYS)


def members(days: DataFrame, intervals: DataFrame, code: str, *, start: str = "in_dt", end: str = "out_dt", index: str = "code") -> DataFrame:
    return interval_join(days, intervals.filter(F.col(index) == code), start, end).select(*KEYS).distinct()


def industry(days: DataFrame, intervals: DataFrame, *, start: str = "in_dt", end: str = "out_dt", name: str = "industry") -> DataFrame:
    """td, tk and the industry as a column (not one dummy for each)."""
    return interval_join(days, intervals, start, end).select(*KEYS, name)


def universe(names: DataFrame, inside: Iterable[DataFrame] = (), outside: Iterable[DataFrame] = ()) -> DataFrame:
    """Rows of names (td, tk) that are in every mask of inside and in none of outside."""
    for mask in inside:
        names = names.join(mask, KEYS, "left_semi")
    for mask in outside:
        names = names.join(mask, KEYS, "left_anti")
    return names
