"""Risk exposures from a declared graph: formulas bound by the names of their arguments, compiled into one plan.

A formula is a function. Its positional arguments name what it reads; keyword-only ones are parameters. Names are looked up among
the panel's columns, the given tables, the subfactors (as processed) and the formulas, in this order. A formula over
columns gets their names and returns a Column, one over tables gets DataFrames and returns td, tk, v.

The panel is read once and laid out by name and by date in turn, as seldom as the graph allows: every formula and every
chain of steps has a phase, the last one in which it still can be computed, so that the panel is narrow while it goes back
and forth. What only makes columns of columns is computed early where that sets its arguments free. Within a phase,
formulas that become ready together share one projection, and steps go through one projection for all columns.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from graphlib import CycleError, TopologicalSorter
from inspect import Parameter, signature

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cross_section as xs

KEYS = ["td", "tk"]


class GraphError(ValueError):
    """A graph that cannot be computed."""


@dataclass(frozen=True)
class Sub:
    """A subfactor: a formula with parameters, kept where its universe holds, then processed step by step."""

    name: str
    formula: str
    params: Mapping = field(default_factory=dict)
    universe: str | None = None
    steps: tuple[str, ...] = ()


@dataclass(frozen=True)
class Node:
    """market: 1 everywhere; style: the NULL-skipping mean of its subfactors, processed; industry: a 0/1 column for each value."""

    name: str
    kind: str = "style"
    subfactors: tuple[Sub, ...] = ()
    steps: tuple[str, ...] = ()
    values: tuple[str, ...] = ()


def from_config(config: Iterable[Mapping]) -> list[Node]:
    """Nodes from plain data, such as a parsed file: names and lists, no code."""
    nodes = []
    for c in config:
        if c.get("type") not in ("market", "style", "industry"):
            raise GraphError(f"invalid type of factor {c.get('name')}: {c.get('type')}")
        subs = tuple(Sub(s["name"], s.get("formula", s["name"]), dict(s.get("params") or {}), s.get("universe"), tuple(s.get("steps") or ())) for s in c.get("subfactors") or ())
        if c["type"] == "style" and not subs:
            raise GraphError(f"style factor {c['name']} has no subfactors")
        nodes.append(Node(c["name"], c["type"], subs, tuple(c.get("steps") or ()), tuple(c.get("values") or ())))
    return nodes


def winsorize_box(df: DataFrame, cols: list[str], weight: str) -> DataFrame:
    return xs.winsorize_boxes(df, cols)


def standardize(df: DataFrame, cols: list[str], weight: str) -> DataFrame:
    held = lambda c: F.col(c).isNotNull() & F.col(weight).isNotNull()
    df = df.withColumns({c: F.when(held(c), F.col(c)) for c in cols})
    return df.withColumns({c: xs.weighted_zscore(c, weight) for c in cols})


def compress(df: DataFrame, cols: list[str], weight: str) -> DataFrame:
    return df.withColumns({c: xs.compress_tails(c) for c in cols})


def winsorize_mad(df: DataFrame, cols: list[str], weight: str) -> DataFrame:
    for c in cols:
        df = xs.winsorize_mad(df, c)
    return df


#: Steps that a node may name; each works on several columns at once.
STEPS: dict[str, Callable[[DataFrame, list[str], str], DataFrame]] = {"winsorize_box": winsorize_box, "standardize": standardize, "compress": compress, "winsorize_mad": winsorize_mad}


#: Industries that one column of bits holds.
_BITS = 60
#: Layouts in turn, by the first.
_TURNS = {"tk": ("tk", "td"), "td": ("td", "tk")}


def _layout(value: Column) -> str | None:
    """tk or td where all windows of a column are over names, or over dates; of the layout only the cost depends."""
    text = str(value)
    firsts = set(re.findall(r"OVER \(PARTITION BY (\w+)", text))
    return firsts.pop() if len(firsts) == 1 and firsts <= set(KEYS) and text.count("OVER (") == text.count("OVER (PARTITION BY ") else None


def phases(layouts: Mapping[str, str | None], reads: Mapping[str, Iterable[str]], kept: Iterable[str] = ()) -> tuple[dict[str, int], list[str]]:
    """The phase of every unit, and the layouts of the phases (tk and td in turn).

    layouts: units in an order in which they can be computed; reads: what each reads; kept: units whose columns the result has.
    There are as few phases as possible. A unit comes as late as it can; one without a layout comes as soon as it can if
    nothing else reads its arguments later.
    """
    readers: dict[str, list[str]] = {u: [] for u in layouts}
    for u in layouts:
        for r in reads[u]:
            readers[r].append(u)

    def counted(first: str) -> tuple[dict[str, int], list[str]]:
        early: dict[str, int] = {}
        for u, layout in layouts.items():
            early[u] = max((early[r] for r in reads[u]), default=0)
            early[u] += layout is not None and _TURNS[first][early[u] % 2] != layout
        return early, [_TURNS[first][i % 2] for i in range(max(early.values(), default=0) + 1)]

    _, of = min((counted(first) for first in _TURNS), key=lambda x: len(x[1]))
    late: dict[str, int] = {}
    for u in reversed(layouts):
        late[u] = min((late[x] for x in readers[u]), default=len(of) - 1)
        late[u] -= layouts[u] is not None and of[late[u]] != layouts[u]
    out: dict[str, int] = {}
    for u, layout in layouts.items():
        out[u] = late[u]
        soonest = max((out[r] for r in reads[u]), default=late[u])
        if layout is None and all(r not in kept and all(late[x] <= soonest for x in readers[r] if x != u) for r in reads[u]):
            out[u] = soonest
    return out, of


class Graph:
    def __init__(self, nodes: Iterable[Node], formulas: Mapping[str, Callable], *, inputs: Iterable[Sub] = (), steps: Mapping[str, Callable] = STEPS) -> None:
        """inputs: named formulas with parameters that others read and that are no factors themselves."""
        self.nodes, self.formulas, self.step_functions = list(nodes), dict(formulas), dict(steps)
        self.subs = {s.name: s for n in self.nodes for s in n.subfactors}
        if len(self.subs) != sum(len(n.subfactors) for n in self.nodes):
            raise GraphError("two subfactors have one name")
        outputs = [x for n in self.nodes for x in (n.values if n.kind == "industry" else (n.name,))]
        if len(set(outputs)) != len(outputs):
            raise GraphError("two factors have one name")
        self.inputs = {s.name: s for s in inputs}
        for s in [*self.subs.values(), *self.inputs.values()]:
            if s.formula not in self.formulas:
                raise GraphError(f"{s.name}: no formula {s.formula}")
            for step in s.steps:
                if step not in self.step_functions:
                    raise GraphError(f"{s.name}: no step {step}")

    def _arguments(self, sub: Sub) -> tuple[list[str], dict]:
        names, params = [], dict(sub.params)
        known = signature(self.formulas[sub.formula]).parameters.values()
        allowed = {p.name for p in known if p.kind is Parameter.KEYWORD_ONLY}
        if unknown := set(params) - allowed:
            raise GraphError(f"{sub.name}: {sub.formula} has no parameter {', '.join(sorted(unknown))}")
        for p in known:
            if p.kind is not Parameter.KEYWORD_ONLY:
                names.append(p.name)
            elif p.default is Parameter.empty and p.name not in params:
                raise GraphError(f"{sub.name}: {sub.formula} needs {p.name}")
        return names, params

    def order(self, columns: Iterable[str], tables: Iterable[str]) -> list[list[Sub]]:
        """What is computed together, in order; only what the factors need, directly or not."""
        columns, tables = set(columns), set(tables)
        wanted: dict[str, Sub] = {}
        edges: dict[str, set[str]] = {}

        def visit(sub: Sub) -> None:
            if sub.name in wanted:
                return
            wanted[sub.name] = sub
            edges[sub.name] = set()
            for a in self._arguments(sub)[0]:
                if a in columns or a in tables:
                    continue
                found = self.subs.get(a) or self.inputs.get(a) or (Sub(a, a) if a in self.formulas else None)
                if found is None:
                    raise GraphError(f"{sub.name}: nothing is named {a}")
                edges[sub.name].add(a)
                visit(found)

        for s in self.subs.values():
            visit(s)
        if taken := columns & set(wanted):
            raise GraphError(f"the panel has columns named like what is computed: {', '.join(sorted(taken))}")
        sorter = TopologicalSorter(edges)
        try:
            sorter.prepare()
        except CycleError as error:
            raise GraphError(f"a cycle: {' <- '.join(error.args[1])}") from error
        out = []
        while sorter.is_active():
            ready = sorted(sorter.get_ready())
            out.append([wanted[x] for x in ready])
            sorter.done(*ready)
        return out

    def _processed(self, df: DataFrame, of: list[tuple[str, tuple[str, ...]]], weight: str) -> DataFrame:
        """All columns go through their own steps; columns whose turn has the same step go together."""
        for turn in range(max((len(steps) for _, steps in of), default=0)):
            by_step: dict[str, list[str]] = {}
            for column, steps in of:
                if turn < len(steps):
                    by_step.setdefault(steps[turn], []).append(column)
            for step, cols in sorted(by_step.items()):
                df = self.step_functions[step](df, cols, weight)
        return df

    def _computed(self, df: DataFrame, subs: list[Sub], of_tables: list[str], weight: str, member: str | None) -> DataFrame:
        """df with the columns of all subs (in an order in which they can be computed), masked and processed."""
        by_name = {s.name: s for s in subs}
        value, reads = {}, {}
        for sub in subs:
            names, params = self._arguments(sub)
            value[sub.name] = F.col(sub.name) if sub.name in of_tables else self.formulas[sub.formula](*names, **params)
            reads[sub.name] = [f"{a}.steps" if by_name[a].steps else a for a in names if a in by_name]
        before: dict[str, set[str]] = {}
        layouts: dict[str, str | None] = {}
        for sub in subs:
            before[sub.name] = {sub.name}.union(*(before[r.removesuffix(".steps")] for r in reads[sub.name]))
        for sub in subs:
            if sub.steps:
                reads[f"{sub.name}.steps"] = [sub.name, *([weight] if weight in by_name and sub.name not in before[weight] else [])]
        for unit in TopologicalSorter(reads).static_order():
            layouts[unit] = "td" if unit not in by_name else _layout(value[unit])
        weights = [weight] if weight in by_name and any(s.steps for s in (*subs, *(n for n in self.nodes if n.kind == "style"))) else []
        phase, of = phases(layouts, reads, [*self.subs, *(f"{s}.steps" for s in self.subs), *weights])
        done: set[str] = set()
        for number, layout in enumerate(of):
            left = [u for u in layouts if phase[u] == number]
            if any(layouts[u] for u in left):
                # before the windows, or what they sum would be computed below their shuffle and sent with the panel
                df = df.repartition(layout)
            while left:
                ready = [u for u in left if done.issuperset(reads[u])]
                now = [u for u in ready if u in by_name] or ready
                if now[0] in by_name:
                    df = df.withColumns({u: value[u] for u in now})
                    masked = {}
                    for sub in (by_name[u] for u in now if u in self.subs):
                        masked[sub.name] = F.col(sub.name)
                        for universe in {member, sub.universe}:
                            if universe:
                                masked[sub.name] = F.when(F.col(f"__in_{universe}"), masked[sub.name])
                    df = df.withColumns(masked) if masked else df
                else:
                    df = self._processed(df, [(u.removesuffix(".steps"), by_name[u.removesuffix(".steps")].steps) for u in now], weight)
                done.update(now)
                left = [u for u in left if u not in done]
        return df

    def exposures(
        self, panel: DataFrame, tables: Mapping[str, DataFrame], *, weight: str, member: str | None = None, universes: Mapping[str, DataFrame] | None = None,
        industries: str | None = None, start: str | None = None, with_subfactors: bool = False,
    ) -> DataFrame:
        """td, tk and a column for each factor (and subfactor).

        panel: a row for each date and name, with calendar position ix. universes: masks (td, tk) by name; member is the one outside
        which every subfactor is NULL. industries: the table (td, tk, industry) of the industry nodes. weight: the panel's column or
        formula that steps weigh by. start: the first date of the result; earlier ones only feed windows.
        """
        universes = dict(universes or {})
        needed = {s.universe for s in self.subs.values() if s.universe} | ({member} if member else set())
        if missing := needed - set(universes):
            raise GraphError(f"no universe {', '.join(sorted(missing))}")
        generations = self.order(panel.columns, tables)
        of_tables, df = [], panel
        # whatever comes from tables alone joins first, while the panel still lies by date and name
        for sub in (s for g in generations for s in g):
            names, params = self._arguments(sub)
            if names and all(a in tables for a in names):
                made = self.formulas[sub.formula](*(tables[a] for a in names), **params)
                df = df.join(made.select(*KEYS, F.col("v").cast("double").alias(sub.name)), KEYS, "left")
                of_tables.append(sub.name)
            elif any(a in tables for a in names):
                raise GraphError(f"{sub.name}: {sub.formula} mixes tables and columns")
        for name in sorted(needed):
            df = df.join(universes[name].select(*KEYS, F.lit(True).alias(f"__in_{name}")), KEYS, "left")
        values = [v for n in self.nodes if n.kind == "industry" for v in n.values]
        if values:
            if industries not in tables:
                raise GraphError("industry factors need a table of industries")
            places = {v: (f"__industries{i // _BITS}", 1 << i % _BITS) for i, v in enumerate(dict.fromkeys(values))}
            bits: dict[str, Column] = {}
            for v, (column, bit) in places.items():
                bits[column] = F.when(F.col("industry") == v, F.lit(bit).cast("long")).otherwise(bits.get(column, F.lit(0).cast("long")))
            df = df.join(tables[industries].groupBy(*KEYS).agg(*(F.bit_or(b).alias(column) for column, b in bits.items())), KEYS, "left")
        df = self._computed(df, [s for g in generations for s in g], of_tables, weight, member)
        out = {}
        for n in self.nodes:
            if n.kind == "market":
                out[n.name] = F.lit(1.0)
            elif n.kind == "industry":
                out |= {v: F.coalesce(F.col(places[v][0]).bitwiseAND(places[v][1]) != 0, F.lit(False)).cast("double") for v in n.values}
            else:
                parts = [F.col(s.name) for s in n.subfactors]
                there = sum(p.isNotNull().cast("int") for p in parts)
                out[f"__f_{n.name}"] = F.try_divide(sum(F.coalesce(p, F.lit(0.0)) for p in parts), there)
        styles = [n for n in self.nodes if n.kind == "style"]
        df = self._processed(df.withColumns(out), [(f"__f_{n.name}", n.steps) for n in styles], weight)
        columns = [F.col(f"__f_{n.name}").alias(n.name) for n in styles] + [F.col(c) for c in out if not c.startswith("__f_")]
        extra = [F.col(s).alias(f"sub_{s}") for s in self.subs] if with_subfactors else []
        df = df.filter(F.col("td") >= F.lit(start).cast("date")) if start else df
        return df.select(*KEYS, *columns, *extra)
