"""Calendar, interval and point-in-time joins, and keyed upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def calendar(dates: DataFrame, date: str = "td") -> DataFrame:
    """One row per distinct date: position ix (from 0) and flags of week, month and year ends (the last date ends nothing).

    A calendar has at most some ten thousand rows, whatever the panel holds, so one ordered window is fine.
    """
    days = dates.select(F.to_date(date).alias("td")).dropna().distinct()
    w = Window.orderBy("td")
    part = lambda c: F.coalesce((F.lead(c).over(w) != c).cast("int"), F.lit(0))
    week = F.year("td") * 0 + F.weekofyear("td")
    return days.select(
        "td", (F.row_number().over(w) - 1).alias("ix"), part(week).alias("is_week_end"), part(F.month("td")).alias("is_month_end"), part(F.year("td")).alias("is_year_end")
    )


def local(days: DataFrame, most: int = 200_000) -> DataFrame:
    """A calendar as rows in the plan itself, read once however often it is used; refuses what is too long for a calendar."""
    rows = days.limit(most + 1).toArrow()
    if rows.num_rows > most:
        raise ValueError(f"a calendar of more than {most} dates")
    return days.sparkSession.createDataFrame(rows, days.schema)


def with_index(panel: DataFrame, date: str = "td") -> DataFrame:
    """panel with the position ix of its date among its own dates."""
    return panel.join(F.broadcast(calendar(panel, date).select("td", "ix")), "td")


def snap_back(events: DataFrame, days: DataFrame, date: str, *, strictly: bool = False, out: str = "td") -> DataFrame:
    """Replace a date by the latest calendar date up to it (strictly: before it); NULL before the calendar's beginning.

    The calendar is stretched to every day of its span (some ten thousand rows) and broadcast, so that events are read once and not
    shuffled; later days count as its last.
    """
    w = Window.orderBy("td")
    each = days.select(F.to_date("td").alias("__to")).withColumn("td", F.col("__to")).withColumn("__next", F.coalesce(F.date_sub(F.lead("td").over(w), 1), F.col("td")))
    each = each.select("__to", F.explode(F.sequence("__to", "__next")).alias("__d"))
    newest = days.agg(F.max(F.to_date("td")).alias("__hi"))
    day = F.date_sub(F.to_date(events[date]), 1) if strictly else F.to_date(events[date])
    marked = events.withColumn("__day", day).join(F.broadcast(newest)).withColumn("__day", F.least("__day", "__hi"))
    marked = marked.withColumn("__day", F.when(F.to_date(F.col(date)).isNotNull(), F.col("__day"))).drop("__hi")
    return marked.join(F.broadcast(each), F.col("__day") == F.col("__d"), "left").withColumn(out, F.col("__to")).drop("__d", "__to", "__day")


def shift_dates(events: DataFrame, days: DataFrame, date: str, n: int = 1, *, out: str = "td") -> DataFrame:
    """Replace a date by the n-th calendar date after it (negative: before it); beyond the calendar's ends it is NULL.

    A date outside the calendar counts from the next date before it, so that 1 is the first calendar date after it; for n < 0
    from the next one after it.
    """
    numbered = days.select(F.col("td").alias("__td"), F.col("ix").alias("__ix"))
    side = F.date_add(F.to_date(date), 1) if n < 0 else F.to_date(date)
    marked = snap_back(events.withColumn("__own", side), days, "__own", strictly=n < 0, out="__at").drop("__own")
    # n < 0: the last calendar date up to the date itself; if that is the date, one less is before it
    base = marked.join(F.broadcast(numbered), F.col("__at") == F.col("__td"), "left").drop("__td")
    at = F.coalesce("__ix", F.lit(-1))
    target = at + n if n > 0 else F.when(F.col("__at") == F.to_date(date), at + n).otherwise(at + n + 1)
    aim = numbered.select(F.col("__td").alias(out), F.col("__ix").alias("__to"))
    return base.withColumn("__t", target).join(F.broadcast(aim), F.col("__t") == F.col("__to"), "left").drop("__t", "__to", "__ix", "__at")


def dates_between(days: DataFrame, start: str, end: str, bounds: str = "[]") -> DataFrame:
    """Calendar dates between two dates; a square bracket takes its end in, a round one leaves it out."""
    d, a, z = F.col("td"), F.lit(start).cast("date"), F.lit(end).cast("date")
    return days.filter((d >= a if bounds[0] == "[" else d > a) & (d <= z if bounds[1] == "]" else d < z))


def align(values: DataFrame, grid: DataFrame, keys: list[str] = ("td", "tk")) -> DataFrame:
    """values on every row of a grid of keys, NULL where there are none; rows off the grid go."""
    return grid.select(*keys).join(values, list(keys), "left")


def interval_join(days: DataFrame, intervals: DataFrame, start: str, end: str, *, bucket_days: int = 64, forever: str = "2100-01-01") -> DataFrame:
    """Every calendar date in [start, end] of every interval (a NULL end is open).

    Intervals are cut into buckets of bucket_days, so that the join is an equi-join on the bucket with a cheap filter;
    no nested loop. The calendar (some ten thousand rows at most) is broadcast, so that intervals are not shuffled.
    """
    number = lambda d: F.floor(F.datediff(d, F.lit("1970-01-01").cast("date")) / bucket_days)
    bounds = days.agg(F.min("td").alias("__lo"), F.max("td").alias("__hi"))
    until = F.coalesce(F.to_date(end), F.lit(forever).cast("date"))
    cut = intervals.join(F.broadcast(bounds)).withColumn("__from", F.greatest(F.to_date(start), F.col("__lo"))).withColumn("__to", F.least(until, F.col("__hi")))
    cut = cut.filter("__from <= __to").withColumn("__b", F.explode(F.sequence(number(F.col("__from")), number(F.col("__to")))))
    return cut.join(F.broadcast(days.select("td", number(F.col("td")).alias("__b"))), "__b").filter("td between __from and __to").drop("__b", "__from", "__to", "__lo", "__hi")


def as_of(left: DataFrame, right: DataFrame, by: str, left_time: str, right_time: str, values: list[str], *, order: list[str] = (), strictly: bool = False) -> DataFrame:
    """left with the latest row of right at or before (strictly: before) its time, per key: a union and one window."""
    columns = left.columns
    # kind 0 sorts before kind 1 at equal times
    kinds = (1, 0) if strictly else (0, 1)
    a = left.select(F.col(by).alias("__by"), F.col(left_time).cast("timestamp").alias("__t"), F.lit(1 - kinds[0] if strictly else 1).alias("__side"), F.lit(kinds[1]).alias("__k"), F.struct(*columns).alias("__row"), F.lit(None).cast(right.select(F.struct(*values)).schema[0].dataType).alias("__v"), *(F.lit(None).cast(right.schema[o].dataType).alias(f"__o{i}") for i, o in enumerate(order)))
    b = right.select(F.col(by).alias("__by"), F.col(right_time).cast("timestamp").alias("__t"), F.lit(9).alias("__side"), F.lit(kinds[0]).alias("__k"), F.lit(None).cast(left.select(F.struct(*columns)).schema[0].dataType).alias("__row"), F.struct(*values).alias("__v"), *(F.col(o).alias(f"__o{i}") for i, o in enumerate(order)))
    w = Window.partitionBy("__by").orderBy("__t", "__k", *(f"__o{i}" for i in range(len(order)))).rowsBetween(Window.unboundedPreceding, 0)
    merged = a.unionByName(b).withColumn("__v", F.last("__v", ignorenulls=True).over(w)).filter("__side <> 9")
    return merged.select("__row.*", *(F.col(f"__v.{v}").alias(v) for v in values))


def keep_last(df: DataFrame, keys: list[str], *order: Column | str) -> DataFrame:
    """One row per key: the last by order (descending columns first)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def upsert_by_date(old: DataFrame, new: DataFrame, date: str = "td") -> DataFrame:
    """Rows of old before the first date of new, then new."""
    first = new.agg(F.min(date).alias("__first"))
    return old.join(F.broadcast(first), F.col("__first").isNull() | (F.col(date) < F.col("__first"))).drop("__first").unionByName(new)


def roll_back_sync(old: DataFrame, source: DataFrame, date: str, keys: list[str], *, days: int = 30, start: str = "2004-12-31") -> DataFrame:
    """Incremental sync: re-read the source from some days before the newest stored date, newer rows win per key."""
    cut = old.agg(F.coalesce(F.date_sub(F.max(F.to_date(date)), days), F.lit(start).cast("date")).alias("__cut"))
    kept = old.join(F.broadcast(cut), F.to_date(date) <= F.col("__cut")).drop("__cut").withColumn("__src", F.lit(0))
    fresh = source.join(F.broadcast(cut), F.to_date(date) > F.col("__cut")).drop("__cut").withColumn("__src", F.lit(1))
    return keep_last(kept.unionByName(fresh), keys, F.desc("__src")).drop("__src")
