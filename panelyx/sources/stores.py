"""Tables kept by date, and managers that bring them up to date by reading only the dates that they need."""

from __future__ import annotations

import inspect
import tempfile
import uuid
import warnings
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from types import ModuleType

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import joins
from .tables import run_all


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that the driver and all executors share: below spark.checkpoint.dir, or a temporary one where all runs on one machine."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{root or tempfile.mkdtemp(prefix='stores-')}/{name}-{uuid.uuid4().hex}"


class DateStore:
    """A Parquet table with a folder for each date: slices read only their dates, writes replace whole dates."""

    def __init__(self, spark: SparkSession, path: str, date: str = "td") -> None:
        self.spark, self.path, self.date = spark, path, date

    def _folder(self, path: str):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()), folder

    def exists(self) -> bool:
        fs, folder = self._folder(self.path)
        return bool(fs.exists(folder)) and bool(self._names())

    def _names(self) -> list[str]:
        fs, folder = self._folder(self.path)
        return [s.getPath().getName() for s in fs.listStatus(folder) if s.getPath().getName().startswith(f"{self.date}=")]

    def dates(self) -> list[str]:
        """The stored dates in order, from the names of the folders alone."""
        fs, folder = self._folder(self.path)
        return sorted(n.split("=", 1)[1] for n in self._names()) if fs.exists(folder) else []

    def read(self, *columns: str) -> DataFrame:
        df = self.spark.read.parquet(self.path)
        return df.select(*columns) if columns else df

    def between(self, start: str | None = None, end: str | None = None) -> DataFrame:
        """Dates from start to end, both included; other folders are not opened."""
        df, d = self.read(), F.col(self.date)
        if start is not None:
            df = df.filter(d >= F.lit(start).cast("date"))
        return df.filter(d <= F.lit(end).cast("date")) if end is not None else df

    def on(self, dates: DataFrame) -> DataFrame:
        """The dates of a small table that is known at run time only; the scan prunes folders by the broadcast dates."""
        return self.read().join(F.broadcast(dates.select(F.to_date(self.date).alias(self.date)).distinct()), self.date)

    def replace(self, df: DataFrame, since: str | None = None) -> None:
        """Writes df's dates anew; from since on, stored dates that df does not have go."""
        before = [] if since is None else [d for d in self.dates() if d >= since]
        df.repartition(self.date).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.date).parquet(self.path)
        if before:
            now = {str(r[0]) for r in df.select(F.col(self.date).cast("string")).distinct().collect()}  # dates of a calendar
            for d in set(before) - now:
                fs, folder = self._folder(f"{self.path}/{self.date}={d}")
                fs.delete(folder, True)


# --- registry of functions ------------------------------------------------------------------------------------------------


def feature(reach: int = 0) -> Callable:
    """Marks a function: how many dates before a date its value there depends on."""

    def mark(f: Callable) -> Callable:
        f.reach = reach
        return f

    return mark


def registry(modules: Iterable[ModuleType]) -> dict[str, Callable]:
    """Every public function of the modules by its name; of two with one name the first stays, with a warning."""
    found: dict[str, Callable] = {}
    for m in modules:
        for name, f in vars(m).items():
            if name.startswith("_") or not callable(f) or inspect.isclass(f):
                continue
            if name in found and found[name] is not f:
                warnings.warn(f"{name} of {m.__name__} is ignored: {found[name].__module__} has registered that name", stacklevel=2)
            found.setdefault(name, f)
    return found


def finite(value: Column) -> Column:
    """Infinities are 0."""
    return F.when(F.abs(value) == float("inf"), F.lit(0.0)).otherwise(value)


@dataclass
class FeatureManager:
    """Features of stored tables, those of one function in one store (td, tk, a column each), brought up to date from a date on.

    A run replaces the dates from ``roll_back`` dates before its first one on. A feature reads these and as many dates before
    them as its reach says, so that its values are the ones that a run over everything would give. Functions get
    the stores' slices by the names of their arguments and return td, tk and a column for each feature; a single column v takes the
    function's name. A function that fails leaves its store as it was, and the others are stored.
    """

    spark: SparkSession
    names: list[str]
    functions: Mapping[str, Callable]
    sources: Mapping[str, DateStore]
    folder: str
    roll_back: int = 20

    def store(self, name: str) -> DateStore:
        return DateStore(self.spark, f"{self.folder}/{name}")

    def span(self, since: str, reach: int, dates: list[str]) -> tuple[str, str] | None:
        """First date to read and first date to replace."""
        later = [i for i, d in enumerate(dates) if d >= since]
        if not later:
            return None
        first = max(0, later[0] - self.roll_back)
        return dates[max(0, first - reach)], dates[first]

    def _arguments(self, f: Callable) -> list[str]:
        return [p.name for p in inspect.signature(f).parameters.values() if p.kind is not inspect.Parameter.KEYWORD_ONLY]

    def compute(self, name: str, since: str) -> tuple[DataFrame, str] | None:
        """Values from the first replaced date on, and that date; None if there is no date from since on."""
        f = self.functions[name]
        arguments = self._arguments(f)
        dates = sorted(set().union(*(self.sources[a].dates() for a in arguments)))
        span = self.span(since, getattr(f, "reach", 0), dates)
        if span is None:
            return None
        read, replace = span
        made = f(*(self.sources[a].between(read) for a in arguments)).filter(F.col("td") >= F.lit(replace).cast("date"))
        values = [c for c in made.columns if c not in ("td", "tk")]
        return made.select("td", "tk", *(finite(F.col(c).cast("double")).alias(name if values == ["v"] else c) for c in values)), replace

    def run(self, since: str = "0001-01-01") -> dict[str, str]:
        """Returns the errors by name of the function."""

        def one(name: str) -> None:
            if made := self.compute(name, since):
                self.store(name).replace(*made)

        return run_all({n: n for n in self.names}, one)

    def read(self, *names: str) -> DataFrame:
        """Stored features of these functions (all of the manager's if none is named) side by side; a row for every date and name that any of them has."""
        out = None
        for n in names or self.names:
            df = self.store(n).read()
            out = df if out is None else out.join(df, ["td", "tk"], "full")
        return out


# --- basic sets -----------------------------------------------------------------------------------------------------------

#: What basic sets take from a source: column of the set, column of the source, factor. Percent to shares, ten thousands to units.
QUOTE = {"open": ("open", 1.0), "high": ("high", 1.0), "low": ("low", 1.0), "close": ("close", 1.0), "vwap": ("vwap", 1.0), "pctchg": ("pctchg", 0.01), "volume": ("volume", 1.0), "amount": ("amount", 1.0), "adjfactor": ("adjfactor", 1.0)}
SIZE = {"total_mv": ("total_mv", 1e4), "float_mv": ("float_mv", 1e4), "total_share": ("total_share", 1e4), "float_share": ("float_share", 1e4)}
INDEX_QUOTE = {k: v for k, v in QUOTE.items() if k not in ("vwap", "adjfactor")}


def basic_set(source: DataFrame, columns: Mapping[str, tuple[str, float]], keys: tuple[str, ...] = ("td", "tk")) -> DataFrame:
    scaled = lambda c, f: F.col(c) if f == 1.0 else F.col(c) / (1 / f) if f < 1 else F.col(c) * f
    return source.select(*keys, *(scaled(c, f).alias(name) for name, (c, f) in columns.items()))


def description(names: DataFrame, members: DataFrame, *, name: str = "name", listed: str = "list_dt", delisted: str = "delist_dt") -> DataFrame:
    """tk, name, list_dt, delist_dt of the names that the panel has; open ends are 1900 and 2100."""
    end = lambda c, d: F.coalesce(F.to_date(c), F.lit(d).cast("date")).alias(c)
    return names.join(members.select("tk").distinct(), "tk", "left_semi").select("tk", F.col(name).alias("name"), end(listed, "1900-01-01"), end(delisted, "2100-01-01"))


def ticker_number(code: Column, first: str = "036") -> Column:
    """The six digits of a code such as 600000.XY as a number; NULL for other codes, and for those that begin otherwise."""
    digits = F.regexp_extract(code, r"^(\d{6})(?:\D|$)", 1)
    return F.when(F.instr(F.lit(first), F.substring(digits, 1, 1)).cast("int") > 0, F.when(digits != "", digits.cast("int")))


@dataclass
class Maintainer:
    """Basic sets in stores of their own, each replaced from some positions before the calendar's end, or from a date, on."""

    spark: SparkSession
    folder: str
    sources: Mapping[str, DateStore]
    sets: Mapping[str, tuple[str, Mapping]]  # set: source, columns
    roll_back: int = 60

    def store(self, name: str) -> DateStore:
        return DateStore(self.spark, f"{self.folder}/{name}")

    def index(self) -> tuple[DataFrame, DataFrame]:
        """The calendar, and the names, of all sources."""
        dates = sorted(set().union(*(s.dates() for s in self.sources.values())))
        days = joins.calendar(self.spark.createDataFrame([(d,) for d in dates], "td string"))
        names = None
        for s in self.sources.values():
            one = s.read("tk")
            names = one if names is None else names.unionByName(one)
        return days, names.distinct()

    def update(self, name: str, since: str | None = None) -> str:
        """Returns the first replaced date."""
        source, columns = self.sets[name]
        dates = self.sources[source].dates()
        if since is None:
            first = dates[max(0, len(dates) - self.roll_back)]
        else:
            # not within the last roll_back dates: those are always replaced
            early = dates[: max(0, len(dates) - self.roll_back)]
            first = next((d for d in early if d >= since), dates[len(early)])
        if not self.store(name).exists():
            first = dates[0]
        self.store(name).replace(basic_set(self.sources[source].between(first), columns), first)
        return first

    def run(self, since: str | None = None) -> dict[str, str]:
        return run_all({n: n for n in self.sets}, lambda n: self.update(n, since))
