"""Datasets for learning: a catalogue of features, windows of several features, and stages that are fitted, saved and loaded.

A window is an array for each feature, oldest value first. Stages are ``pyspark.ml`` transformers over such columns; each says whether it
takes part in training, in prediction, or in both (``train``, ``pred``). ``cols`` names the features that a stage works on, ``at`` the positions
in the window that it looks at (none: all; negative ones count from the end).
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .dataset import medians

MAD_SCALE = 1.483


# --- catalogue ------------------------------------------------------------------------------------------------------------


@dataclass
class Catalogue:
    """What data there is: name, type (feature, label, risk ...), group, and the table (td, tk, columns) that it comes from."""

    spark: SparkSession
    tables: dict[str, DataFrame] = field(default_factory=dict)
    entries: list[tuple[str, str, str]] = field(default_factory=list)
    prepared: bool = False

    def register(self, group: str, table: DataFrame, *, type: str = "feature", names: Iterable[str] | str | None = None) -> Catalogue:  # noqa: A002
        """All columns of the table besides td and tk unless names says which."""
        if self.prepared:
            raise ValueError("the data are prepared; nothing more can be registered")
        there = [c for c in table.columns if c not in ("td", "tk")]
        chosen = there if names is None else [names] if isinstance(names, str) else list(names)
        if missing := set(chosen) - set(there):
            raise ValueError(f"{group} has no {', '.join(sorted(missing))}")
        if taken := {n for n, _, _ in self.entries} & set(chosen):
            raise ValueError(f"registered already: {', '.join(sorted(taken))}")
        self.tables[group] = table.select("td", "tk", *chosen)
        self.entries += [(n, type, group) for n in chosen]
        return self

    def names(self, **fields: str | Iterable[str]) -> list[str]:
        """Names by type, group or data, in the order of registration."""
        known = ("data", "type", "group")
        if unknown := set(fields) - set(known):
            raise ValueError(f"{', '.join(sorted(unknown))}: no such field, there are {', '.join(known)}")
        wanted = {k: {v} if isinstance(v, str) else set(v) for k, v in fields.items()}
        return [e[0] for e in self.entries if all(e[known.index(k)] in v for k, v in wanted.items())]

    def info(self) -> DataFrame:
        return self.spark.createDataFrame(self.entries, "data string, type string, group string")

    def prepare(self) -> DataFrame:
        """Everything side by side: a row for each date and name of any table."""
        self.prepared = True
        out = None
        for df in self.tables.values():
            out = df if out is None else out.join(df, ["td", "tk"], "full")
        return out


def window_columns(df: DataFrame, cols: list[str], length: int, stride: int = 1, *, order: str = "ix") -> DataFrame:
    """Each column as the array of its last ``length`` values, every stride-th row back from the row itself; full windows only; others stay."""
    span = length * stride
    w = Window.partitionBy("tk").orderBy(order).rowsBetween(-(span - 1), 0)
    rows = df.withColumn("__all", F.collect_list(F.struct(*(F.col(c).cast("double").alias(c) for c in cols))).over(w)).filter(F.size("__all") == span)
    taken = F.filter("__all", lambda x, i: (i + 1) % stride == 0)
    return rows.withColumn("__all", taken).withColumns({c: F.col(f"__all.{c}") for c in cols}).drop("__all")


# --- stages ---------------------------------------------------------------------------------------------------------------


class _Stage(Params, DefaultParamsReadable, DefaultParamsWritable):
    cols = Param(Params._dummy(), "cols", "features", TypeConverters.toListString)
    at = Param(Params._dummy(), "at", "positions in the window; none: all", TypeConverters.toListInt)
    train = Param(Params._dummy(), "train", "takes part in training", TypeConverters.toBoolean)
    pred = Param(Params._dummy(), "pred", "takes part in prediction", TypeConverters.toBoolean)

    def __init__(self, **given) -> None:
        super().__init__()
        self._setDefault(at=[], train=True, pred=True, **self.defaults)
        self._set(**given)

    defaults: dict = {}

    def value(self, name: str):
        return self.getOrDefault(name)

    def seen(self, c: str) -> Column:
        """The column's values at the positions that count."""
        at = self.value("at")
        return F.array(*(F.element_at(c, i + 1 if i >= 0 else i) for i in at)) if at else F.col(c)

    def changed(self, c: str, f) -> Column:
        """The column with f(value, position) in place of the values at the positions that count."""
        at = self.value("at")
        if not at:
            return F.transform(c, f)
        size = F.size(c)
        here = lambda i: F.array_contains(F.array(*(F.lit(a) if a >= 0 else size + a for a in at)), i)
        return F.transform(c, lambda v, i: F.when(here(i), f(v, i)).otherwise(v))


class _Filter(Transformer, _Stage):
    """Keeps rows whose windows pass."""

    def passes(self) -> Column:
        raise NotImplementedError

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.filter(F.coalesce(self.passes(), F.lit(False)))

    def every(self, test, whole: bool) -> Column:
        """The test at every position of every feature that counts, or (whole false) at any of any."""
        parts = [(F.forall if whole else F.exists)(self.seen(c), lambda v: F.coalesce(test(v), F.lit(False))) for c in self.value("cols")]
        out = parts[0]
        for p in parts[1:]:
            out = out & p if whole else out | p
        return out


class AllPositive(_Filter):
    def passes(self) -> Column:
        return F.array_min(F.concat(*(F.transform(self.seen(c), lambda v: F.coalesce(v, F.lit(float("-inf")))) for c in self.value("cols")))) > 0


class NotAllZero(_Filter):
    """At every position that counts some feature is not 0."""

    def passes(self) -> Column:
        top = F.transform(self.seen(self.value("cols")[0]), lambda v: F.abs(F.coalesce(v, F.lit(0.0))))
        for c in self.value("cols")[1:]:
            top = F.zip_with(top, self.seen(c), lambda a, v: F.greatest(a, F.abs(F.coalesce(v, F.lit(0.0)))))
        return F.array_min(top) > 0


class InRange(_Filter):
    low = Param(Params._dummy(), "low", "least value", TypeConverters.toFloat)
    high = Param(Params._dummy(), "high", "greatest value", TypeConverters.toFloat)
    how = Param(Params._dummy(), "how", "all or any", TypeConverters.toString)
    defaults = {"how": "all"}

    def passes(self) -> Column:
        return self.every(lambda v: (v >= self.value("low")) & (v <= self.value("high")), self.value("how") == "all")


class WithoutValue(_Filter):
    """how "any": rows with the value anywhere go; "all": only rows that hold nothing else."""

    unwanted = Param(Params._dummy(), "unwanted", "the value", TypeConverters.toFloat)
    how = Param(Params._dummy(), "how", "any or all", TypeConverters.toString)
    defaults = {"how": "all"}

    def passes(self) -> Column:
        return self.every(lambda v: v.isNull() | (v != self.value("unwanted")), self.value("how") == "any")


class DropMissing(_Filter):
    """how "any": rows with a gap anywhere go; "all": only rows without any value."""

    how = Param(Params._dummy(), "how", "any or all", TypeConverters.toString)
    defaults = {"how": "any"}

    def passes(self) -> Column:
        return self.every(lambda v: v.isNotNull() & ~F.isnan(v), self.value("how") == "any")


class _Change(Transformer, _Stage):
    """Changes values."""

    def one(self, c: str) -> Column:
        raise NotImplementedError

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: self.one(c) for c in self.value("cols")})


class FillMissing(_Change):
    filler = Param(Params._dummy(), "filler", "value for gaps", TypeConverters.toFloat)
    defaults = {"filler": 0.0}

    def one(self, c: str) -> Column:
        return self.changed(c, lambda v, i: F.coalesce(F.nanvl(v, F.lit(None).cast("double")), F.lit(self.value("filler"))))


class Bound(_Change):
    low = Param(Params._dummy(), "low", "least value", TypeConverters.toFloat)
    high = Param(Params._dummy(), "high", "greatest value", TypeConverters.toFloat)

    def one(self, c: str) -> Column:
        return self.changed(c, lambda v, i: F.when(v.isNotNull(), F.least(F.greatest(v, F.lit(self.value("low"))), F.lit(self.value("high")))))


class LastValue(_Change):
    """Over the last value of the feature itself, or of the one in ``by`` at the same place."""

    by = Param(Params._dummy(), "by", "features to divide by", TypeConverters.toListString)
    defaults = {"by": []}

    def _transform(self, df: DataFrame) -> DataFrame:
        cols, by = self.value("cols"), self.value("by") or self.value("cols")
        if len(by) != len(cols):
            raise ValueError("by names as many features as cols, or none")
        over = lambda c, b: F.transform(c, lambda v: F.try_divide(v, F.element_at(b, -1)))
        return df.withColumns({c: over(c, b) for c, b in zip(cols, by, strict=True)})


class SelfStandard(_Change):
    """Every position less the mean of its date, over its sample deviation."""

    def _transform(self, df: DataFrame) -> DataFrame:
        date = Window.partitionBy("td")
        for c in self.value("cols"):
            positions = self.value("at")
            if not positions:
                raise ValueError("positions have to be named")
            new = {}
            for a in positions:
                x = F.element_at(c, a + 1 if a >= 0 else a)
                new[a] = (x - F.avg(x).over(date)) / (F.stddev_samp(x).over(date) + 1e-8)
            df = df.withColumns({f"__p{k}": v for k, v in enumerate(new.values())})
            size = F.size(c)
            at = lambda i, c=c: F.coalesce(*(F.when(i == (F.lit(a) if a >= 0 else size + a), F.struct(F.col(f"__p{k}").alias("v"))) for k, a in enumerate(new)))  # noqa: B023, E731
            df = df.withColumn(c, F.transform(c, lambda v, i: F.when(at(i).isNotNull(), at(i)["v"]).otherwise(v))).drop(*(f"__p{k}" for k in range(len(new))))  # noqa: B023
        return df


# --- fitted stages --------------------------------------------------------------------------------------------------------


def window_statistics(df: DataFrame, cols: list[str], *, min_names: int = 1) -> dict[str, dict[str, list[float]]]:
    """By feature and position over all rows of dates with at least min_names names: median, mad, mean, std, min, max.

    min and max are median -+ 5 * 1.483 * mad. What comes to the driver is a few numbers for each feature and position.
    """
    rows = df.withColumn("__names", F.count("*").over(Window.partitionBy("td"))).filter(F.col("__names") >= min_names) if min_names > 1 else df
    kept = rows.select(*cols).persist()
    sizes = kept.agg(*(F.max(F.size(c)) for c in cols)).first()
    names = [(c, i) for c, n in zip(cols, sizes, strict=True) for i in range(max(n or 0, 0))]
    values = {f"{c}/{i}": F.get(F.col(c), F.lit(i)).cast("double") for c, i in names}
    values = {k: F.when(~F.isnan(v), v) for k, v in values.items()}
    med = medians(kept, values)
    mad = medians(kept, {k: F.abs(v - F.lit(med[k])) for k, v in values.items()})
    moments = kept.agg(*(f(v) for v in values.values() for f in (F.avg, F.stddev_samp))).first() if values else []
    kept.unpersist()
    out: dict[str, dict[str, list[float]]] = {c: {} for c in cols}
    for j, (c, i) in enumerate(names):
        k = f"{c}/{i}"
        if med[k] is None:
            continue
        own = {"median": med[k], "mad": mad[k], "mean": moments[2 * j], "std": moments[2 * j + 1] or 0.0}
        own |= {"min": own["median"] - 5 * MAD_SCALE * own["mad"], "max": own["median"] + 5 * MAD_SCALE * own["mad"]}
        for name, v in own.items():
            out[c].setdefault(name, []).append(float(v))
    return out


class FittedWindows(_Change):
    """Values clipped to the fitted bounds, or scaled by the fitted mean and deviation, of their feature and position."""

    kind = Param(Params._dummy(), "kind", "clip or scale", TypeConverters.toString)
    fitted = Param(Params._dummy(), "fitted", "statistics, as JSON", TypeConverters.toString)

    def one(self, c: str) -> Column:
        own = json.loads(self.value("fitted"))[c]
        at = lambda k, i: F.element_at(F.array(*(F.lit(x) for x in own[k])), i + 1)
        if self.value("kind") == "clip":
            return self.changed(c, lambda v, i: F.when(v.isNotNull(), F.least(F.greatest(v, at("min", i)), at("max", i))))
        return self.changed(c, lambda v, i: (v - at("mean", i)) / (at("std", i) + 1e-8))


class FitWindows(Estimator, _Stage):
    """Learns window_statistics; its model clips or scales by them."""

    kind = Param(Params._dummy(), "kind", "clip or scale", TypeConverters.toString)
    min_names = Param(Params._dummy(), "min_names", "dates with fewer names do not count", TypeConverters.toInt)
    defaults = {"min_names": 100}

    def _fit(self, df: DataFrame) -> FittedWindows:
        return self.model(window_statistics(df, self.value("cols"), min_names=self.value("min_names")))

    def model(self, found: dict) -> FittedWindows:
        return FittedWindows(cols=self.value("cols"), at=self.value("at"), train=self.value("train"), pred=self.value("pred"), kind=self.value("kind"), fitted=json.dumps(found))


def fit(stages: Iterable, df: DataFrame) -> PipelineModel:
    """Goes through the stages as in training and fits those that learn, each on what the ones before it leave.

    Successive stages that learn are fitted on the same rows, as their bounds and scales are those of the data before either.
    """
    done, pending, kept = [], [], None
    for s in stages:
        if isinstance(s, Estimator):
            # all that learn from the same rows read them from here, and what they learn alike is learned once
            if kept is None:
                kept, learned = df.persist(), {}
            if not isinstance(s, FitWindows):
                pending.append(s.fit(kept))
                continue
            key = (tuple(s.value("cols")), s.value("min_names"))
            if key not in learned:
                learned[key] = window_statistics(kept, s.value("cols"), min_names=s.value("min_names"))
            pending.append(s.model(learned[key]))
            continue
        if kept is not None:
            kept.unpersist()
            kept = None
        for model in pending:
            df = model.transform(df) if model.value("train") else df
        done += pending
        pending = []
        done.append(s)
        df = s.transform(df) if s.value("train") else df
    if kept is not None:
        kept.unpersist()
    return PipelineModel(done + pending)


def process(model: PipelineModel, df: DataFrame, *, mode: str) -> DataFrame:
    """df through the stages that take part: mode 'train' or 'pred'."""
    if mode not in ("train", "pred"):
        raise ValueError(f"mode {mode}: train or pred")
    for s in model.stages:
        df = s.transform(df) if s.value(mode) else df
    return df


def split(df: DataFrame, parts: Mapping[str, list[str]]) -> DataFrame:
    """td, tk and one column for each part: an array of its features' windows (labels: of their values)."""
    return df.select("td", "tk", *(F.array(*cols).alias(name) for name, cols in parts.items()))


__all__ = ["AllPositive", "Bound", "Catalogue", "DropMissing", "FillMissing", "FitWindows", "FittedWindows", "InRange", "LastValue", "NotAllZero", "SelfStandard", "WithoutValue", "fit", "process", "split", "window_columns", "window_statistics"]
