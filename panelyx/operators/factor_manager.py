"""Factors in three stages, each kept in a store by date: as computed, standardised, and freed of what styles explain."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import cross_section as xs
from ..sources.stores import DateStore
from ..sources.tables import run_all
from . import graph

STAGES = ("primitive", "standardized", "orthogonalized")
KEYS = ["td", "tk"]


@dataclass(frozen=True)
class Spec:
    """A factor: its formula, the steps that standardise it (see graph.STEPS), and the panel's columns that it is made orthogonal to."""

    name: str
    formula: str
    params: Mapping = field(default_factory=dict)
    standardize: tuple[str, ...] = ()
    orthogonalize: tuple[str, ...] = ()


@dataclass
class FactorManager:
    """Computes factors from a date on and keeps all three stages; a factor that fails leaves its stores as they were, others are kept.

    panel: td, tk, ix, weight and the formulas' columns, with as many dates before the first as windows need. A stage that a factor does not ask for
    repeats the one before.
    """

    spark: SparkSession
    folder: str
    specs: Sequence[Spec]
    formulas: Mapping[str, Callable]

    def store(self, name: str, stage: str) -> DateStore:
        if stage not in STAGES:
            raise ValueError(f"no stage {stage}: {', '.join(STAGES)}")
        return DateStore(self.spark, f"{self.folder}/{stage}/{name}")

    def stages(self, spec: Spec, panel: DataFrame, tables: Mapping[str, DataFrame], *, weight: str, member: str | None = None, universes: Mapping[str, DataFrame] | None = None, start: str | None = None) -> DataFrame:
        """td, tk and a column for each stage, in one plan; only names of the universe have values."""
        one = graph.Graph([graph.Node("primitive", subfactors=(graph.Sub("__value", spec.formula, spec.params),))], self.formulas)
        made = one.exposures(panel, tables, weight=weight, member=member, universes=universes, start=start)
        extra = dict.fromkeys([weight, *spec.orthogonalize])
        df = made.join(panel.select(*KEYS, *extra), KEYS).withColumn("standardized", F.col("primitive"))
        for step in spec.standardize:
            if step not in graph.STEPS:
                raise graph.GraphError(f"{spec.name}: no step {step}")
            df = graph.STEPS[step](df, ["standardized"], weight)
        if spec.orthogonalize:
            df = xs.orthogonalize(df.withColumn("__one", F.lit(1.0)), "standardized", [*spec.orthogonalize, "__one"], weight, "orthogonalized")
        else:
            df = df.withColumn("orthogonalized", F.col("standardized"))
        return df.select(*KEYS, *STAGES)

    def run(self, panel: DataFrame, tables: Mapping[str, DataFrame], names: Sequence[str] | None = None, **options) -> dict[str, str]:
        """Returns the errors by name. names: the factors to do (all unless given). Options as in stages."""

        def one(spec: Spec) -> None:
            rows = self.stages(spec, panel, tables, **options)
            # computed once: the later stages come from what is written
            whole = DateStore(self.spark, f"{self.folder}/_all/{spec.name}")
            whole.replace(rows, options.get("start"))
            done = whole.between(options.get("start"))
            for stage in STAGES:
                self.store(spec.name, stage).replace(done.select(*KEYS, F.col(stage).alias("value")).filter("value is not null"), options.get("start"))

        return run_all({s.name: s for s in self.specs if names is None or s.name in names}, one)
