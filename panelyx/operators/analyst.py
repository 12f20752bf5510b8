"""Analysts' consensus on a calendar: targets follow from the last annual report that a date knows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import snap_back

VALUES = ("fy0", "fy1", "fy2")


def placed(events: DataFrame, days: DataFrame, date: str, *, forward: bool = False) -> DataFrame:
    """events with ix: the position of the last calendar date up to the date (forward: of the first one from it on); rows off the calendar go."""
    at = F.broadcast(days.select(F.col("td").alias("__td"), F.col("ix").alias("__ix")))
    found = snap_back(events, days, date, strictly=forward, out="__at").join(at, F.col("__at") == F.col("__td"), "left")
    ix = F.coalesce("__ix", F.lit(-1)) + 1 if forward else F.col("__ix")
    return found.withColumn("ix", ix).drop("__at", "__td", "__ix").filter("ix is not null")


def annual_reports(statements: DataFrame, *, statement_type: str | None = None, kind: str = "statement_type") -> DataFrame:
    """Statements of whole years (periods that end on 31 December), of one type if given, with a profit."""
    rows = statements.filter((F.month("period") == 12) & (F.dayofmonth("period") == 31) & F.col("ann_dt").isNotNull())
    return rows.filter(F.col(kind) == statement_type) if statement_type else rows


def _day_of_year(days: DataFrame) -> DataFrame:
    """ix, td and day: how many positions a date is beyond the last one of the year before."""
    return days.select("ix", "td", (F.col("ix") - F.min("ix").over(Window.partitionBy(F.year("td"))) + 1).alias("day"))


def consensus(estimates: DataFrame, reports: DataFrame, days: DataFrame, *, window: int = 122, half_life: float = 21.0, unit: float = 10_000.0, year_positions: int = 252) -> DataFrame:
    """td, tk, last_period, lr, fy0, fy1, fy2, fttm on every date with an estimate in the trailing window and a report before it.

    estimates: tk, inst, est_dt, period (its last day), est, seq (order of rows of one date). reports: tk, ann_dt, period, profit, seq: whole
    years (see annual_reports). days: td, ix.

    Estimates lie at the last calendar date up to theirs, those of 0 do not count. A date t sees the report announced last up to it; its
    period plus one, two and three years are the targets fy0, fy1, fy2. Of each institution the newest estimate of a target counts if it is
    at most ``window`` positions old, weighted by 0.5 ** (age in positions / half_life). fttm blends the two targets that the
    coming twelve months lie in: those ``gap`` and ``gap + 1`` years after the last period, gap being the years from it to the date,
    by the positions of the year that are over (out of ``year_positions``); the period itself counts for gap 0. Both have to be known.

    An estimate holds until the institution's next one, a report until the next; the target is a key of an equi-join, and what holds is
    laid out by position and summed up with one shuffle. Nothing is joined by a range.
    """
    newest = days.agg(F.max("ix").alias("__last"))
    e = placed(estimates.filter(F.col("est").isNotNull() & (F.col("est") != 0) & F.col("tk").isNotNull()), days, "est_dt")
    e = e.select("tk", "inst", F.to_date("period").alias("period"), (F.col("est") * unit).alias("est"), "seq", F.col("ix").cast("int").alias("ix"))
    until = lambda w: F.least(F.col("ix") + window, F.coalesce(F.lead("ix").over(w) - 1, F.col("ix") + window))
    last = F.broadcast(newest)

    # dates with any estimate in the window: each holds until the name's next one, whoever gave it
    some = e.select("tk", "ix").distinct().withColumn("to", until(Window.partitionBy("tk").orderBy("ix"))).join(last)
    seen = some.select("tk", F.explode(F.sequence(F.col("ix"), F.least("to", "__last"))).alias("ix"))

    r = placed(reports.filter(F.col("tk").isNotNull()), days, "ann_dt", forward=True)
    r = r.select("tk", F.to_date("ann_dt").alias("ann"), F.to_date("period").alias("period"), F.col("profit").alias("lr"), "seq", F.col("ix").cast("int").alias("ix"))
    r = r.withColumn("to", F.lead("ix").over(Window.partitionBy("tk").orderBy("ann", "seq")) - 1).join(last)
    r = r.withColumn("to", F.coalesce("to", "__last")).filter("ix <= to")
    known = r.select("tk", "period", "lr", F.explode(F.sequence("ix", "to")).alias("ix"))

    targets = r.select("tk", "ix", "to", F.col("period").alias("base"), F.explode(F.sequence(F.lit(1), F.lit(3))).alias("k")).withColumn("period", F.add_months("base", 12 * F.col("k")))
    held = e.withColumn("to", until(Window.partitionBy("tk", "period", "inst").orderBy("ix", "seq"))).filter("ix <= to").withColumnsRenamed({"ix": "e_ix", "to": "e_to"})
    both = held.join(targets, ["tk", "period"]).select("tk", "k", "est", "e_ix", F.greatest("e_ix", "ix").alias("from"), F.least("e_to", "to").alias("to")).filter("from <= to")
    each = both.select("tk", "k", "est", "e_ix", F.explode(F.sequence("from", "to")).alias("ix")).withColumn("weight", F.pow(F.lit(0.5), (F.col("ix") - F.col("e_ix")) / F.lit(float(half_life))))

    none = lambda kind: F.lit(None).cast(kind)
    kinds = {"seen": "boolean", "period": "date", "lr": "double", "k": "int", "est": "double", "weight": "double"}
    shaped = lambda df, **own: df.select("tk", F.col("ix").cast("int").alias("ix"), *(own.get(c, none(t)).cast(t).alias(c) for c, t in kinds.items()))
    rows = shaped(seen, seen=F.lit(True)).unionByName(shaped(known, period=F.col("period"), lr=F.col("lr"))).unionByName(shaped(each, k=F.col("k"), est=F.col("est"), weight=F.col("weight")))
    of = lambda k, x: F.sum(F.when(F.col("k") == k, x))
    out = rows.groupBy("tk", "ix").agg(
        F.max("seen").alias("seen"), F.max("period").alias("last_period"), F.max("lr").alias("lr"),
        *(F.try_divide(of(k + 1, F.col("est") * F.col("weight")), of(k + 1, F.col("weight"))).alias(v) for k, v in enumerate(VALUES)),
    ).filter("seen and last_period is not null")
    out = out.join(F.broadcast(_day_of_year(days)), "ix")
    return out.select("td", "tk", "last_period", "lr", *VALUES, _next_year(year_positions).alias("fttm"))


def _next_year(year_positions: int) -> Column:
    gap = F.year("td") - F.year("last_period")
    ladder = F.array(F.col("lr"), *(F.col(v) for v in VALUES))
    at = lambda g: F.when((g >= 0) & (g < 4), F.get(ladder, g))
    done = F.greatest(F.col("day"), F.lit(0))
    left = F.greatest(F.lit(year_positions) - F.col("day"), F.lit(0))
    return (at(gap) * left + at(gap + 1) * done) / (left + done)
