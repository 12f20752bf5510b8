"""Readers, table specifications and keyed sinks."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import keep_last, roll_back_sync, upsert_by_date

FORMATS = {".parquet": "parquet", ".orc": "orc", ".csv": "csv", ".json": "json"}


def load(spark: SparkSession, path: str, columns: Iterable[str] | None = None, **options) -> DataFrame:
    """Reads a table by its suffix; chosen columns reach the scan."""
    reader = spark.read.options(header=True, **options) if path.endswith(".csv") else spark.read.options(**options)
    df = reader.format(FORMATS[PurePosixPath(path).suffix]).load(path)
    return df.select(*columns) if columns else df


def load_tree(spark: SparkSession, path: str, suffix: str = ".parquet", *, key: str | None = None, values: Iterable | None = None, **options) -> DataFrame:
    """All files of a suffix below a folder, at any depth; rows whose key is among values, if given (the filter reaches the scan)."""
    df = spark.read.options(recursiveFileLookup=True, pathGlobFilter=f"*{suffix}", **options).format(FORMATS[suffix]).load(path)
    return df.filter(F.col(key).isin(list(values))) if key and values is not None else df


def list_tables(spark: SparkSession, path: str) -> DataFrame:
    """name, path and length of every file below a folder whose suffix is known; contents are not read."""
    files = spark.read.option("recursiveFileLookup", True).format("binaryFile").load(path).select("path", "length")
    suffix = F.concat(F.lit("."), F.substring_index("path", ".", -1))
    return files.filter(suffix.isin(list(FORMATS))).select(F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1).alias("name"), "path", "length")


def stacked(features: dict[str, DataFrame], keys: list[str], value: str = "value") -> DataFrame:
    """Features (keys and a value each) side by side, one column for each; a row for every key that any of them has."""
    out = None
    for name, df in features.items():
        one = df.select(*keys, F.col(value).alias(name))
        out = one if out is None else out.join(one, keys, "full")
    return out


def run_named(functions: dict, available: dict[str, DataFrame]) -> dict:
    """Calls every function with the tables that its arguments name; results serve later functions under the function's name."""
    from inspect import signature

    held = dict(available)
    for name, f in functions.items():
        held[name] = f(**{a: held[a] for a in signature(f).parameters})
    return {name: held[name] for name in functions}


def days(df: DataFrame, start: str, end: str, date: str = "td") -> DataFrame:
    """Inclusive slice of dates; on a table partitioned by date only those partitions are read."""
    return df.filter(F.col(date).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


@dataclass(frozen=True)
class TableSpec:
    """What is read from a database table: columns, row filter, and how it is kept in step."""

    name: str
    source: str
    columns: tuple[str, ...] = ("*",)
    where: str | None = None
    date_field: str | None = None  # incremental if given
    key: tuple[str, ...] = ()
    omit: tuple[str, ...] = ()

    def sql(self, since: str | None = None) -> str:
        """The query; filters are joined as parts, not searched for in text."""
        parts = [f"({self.where})"] if self.where else []
        if self.date_field and since:
            parts.append(f"{self.date_field} > '{since}'")
        return f"SELECT {', '.join(self.columns)} FROM {self.source}" + (f" WHERE {' AND '.join(parts)}" if parts else "")

    def read(self, spark: SparkSession, since: str | None = None, **jdbc) -> DataFrame:
        """Through JDBC; url, driver, user and the like come from the caller."""
        return spark.read.format("jdbc").options(fetchsize=100_000, query=self.sql(since), **jdbc).load().drop(*self.omit)

    def merge(self, old: DataFrame | None, fresh: DataFrame, roll_back: int = 30) -> DataFrame:
        """A full table, or the old rows with the newer ones put in by key."""
        fresh = fresh.drop(*self.omit)
        if old is None or not self.date_field:
            return fresh.dropDuplicates(list(self.key)) if self.key else fresh.distinct()
        return roll_back_sync(old, fresh, self.date_field, list(self.key) or fresh.columns, days=roll_back)


def run_all(tasks: dict, run) -> dict[str, str]:
    """Runs every task; one that fails does not stop the others. Returns the errors by name."""
    failed = {}
    for name, task in tasks.items():
        try:
            run(task)
        except Exception as error:
            failed[name] = f"{type(error).__name__}: {error}"
    return failed


def corrected_date(announced: Column, changed_at: Column, early_hour: int = 5) -> Column:
    """Rows changed in the small hours belong to the day before; an announcement dated that day moves to the next."""
    day = F.to_date(changed_at)
    own = F.when(F.hour(changed_at) < early_hour, F.date_sub(day, 1)).otherwise(day)
    return F.when(F.to_date(announced) == own, F.date_add(F.to_date(announced), 1)).otherwise(F.to_date(announced))


def append_panel(spark: SparkSession, path: str, new: DataFrame, date: str = "td") -> None:
    """Replaces the stored rows of the dates that the new rows hold; all other stored dates stay."""
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date).parquet(path)


__all__ = ["TableSpec", "append_panel", "corrected_date", "days", "keep_last", "list_tables", "load", "load_tree", "roll_back_sync", "run_all", "run_named", "stacked", "upsert_by_date"]
