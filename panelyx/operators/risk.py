"""Style factors of a risk model, and how sub-factors make factors."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import cross_section as xs
from ..functions import windows as win


def half_life_weights(length: int, half_life: float | None) -> list[float]:
    """Newest heaviest, summing to the length; equal weights without a half-life."""
    w = [1.0 if half_life is None else 0.5 ** ((length - 1 - i) / half_life) for i in range(length)]
    return [x * length / sum(w) for x in w]


def size(cap: str) -> Column:
    return F.log1p(cap)


def liquidity(amount: str, cap: str) -> Column:
    """Log of amount over the capital one position before."""
    x = F.try_divide(F.col(amount), win.lagged(cap, 1))
    return F.when(x > 0, F.log(x))


def non_linear_size(df: DataFrame, size_col: str, weight: str, out: str = "nls") -> DataFrame:
    """Residual of the cubed standardised size on the standardised size."""
    df = df.withColumn("__z", xs.weighted_zscore(size_col, weight)).withColumn("__c", F.pow("__z", F.lit(3.0))).withColumn("__w", F.sqrt(weight))
    return df.withColumn(out, xs.weighted_residual("__c", "__z", "__w")).drop("__z", "__c", "__w")


def shrunk_beta(df: DataFrame, beta: str, se2: str, weight: str, group: str, out: str = "beta") -> DataFrame:
    """Towards the group's weighted mean, by the share of the betas' own variance."""
    g = Window.partitionBy("td", group)
    df = df.withColumn("__v", F.var_pop(beta).over(g)).withColumn("__p", F.sum(F.col(beta) * F.col(weight)).over(g) / F.sum(weight).over(g))
    c = F.try_divide(F.col("__v"), F.col("__v") + F.col(se2))
    return df.withColumn(out, c * F.col(beta) + (1 - c) * F.col("__p")).drop("__v", "__p")


def residual_volatility(df: DataFrame, y: str, xs_: list[str], n: int, min_periods: int, out: str = "ivol") -> DataFrame:
    """Rolling regression of y on several factors and a constant: population deviation of the residuals."""
    return win.rolling_residual_std(df, y, xs_, n, min_periods, out)


def listed_days(days: DataFrame, listings: DataFrame, entity: str, listed: str, delisted: str) -> DataFrame:
    """Days since listing on every calendar date inside the listing."""
    from .joins import interval_join

    rows = interval_join(days, listings.select(F.col(entity).alias("tk"), F.to_date(listed).alias("__a"), F.to_date(delisted).alias("__z")), "__a", "__z")
    return rows.select("td", "tk", F.datediff("td", "__a").alias("listed_days"))


def institution_share(holdings: DataFrame, float_shares: DataFrame, days: DataFrame, *, unit: float = 10_000.0) -> DataFrame:
    """td, tk, v: what institutions hold of each name's float, from half-yearly reports.

    holdings: tk, end_dt (end of the period), ann_dt, quantity. Reports of 30 June count from 31 August on, those of
    31 December from 30 April on; later announcements do not count, other periods neither. Each of these days is moved back to the last
    calendar date. A date on which no name has a value takes all values of the date before it; so a date's values come from the last
    date with any, and a name without one there has none.
    float_shares: td, tk, shares.
    """
    from .joins import interval_join, snap_back

    end, year = F.to_date("end_dt"), F.year("end_dt")
    known = F.when((F.month(end) == 12) & (F.dayofmonth(end) == 31), F.make_date(year + 1, F.lit(4), F.lit(30))).when((F.month(end) == 6) & (F.dayofmonth(end) == 30), F.make_date(year, F.lit(8), F.lit(31)))
    rows = holdings.select("tk", "quantity", F.to_date("ann_dt").alias("ann"), known.alias("known")).filter("known >= ann and tk is not null and quantity is not null")
    sums = rows.groupBy("known", "tk").agg(F.sum("quantity").alias("quantity"))
    # what lies beyond the calendar's last date is not known yet
    newest = days.agg(F.max("td").alias("__to"))
    sums = sums.join(F.broadcast(newest), F.col("known") <= F.col("__to")).drop("__to")
    placed = snap_back(sums, days, "known", out="td").filter("td is not null").groupBy("td", "tk").agg(F.sum("quantity").alias("quantity"))
    own = placed.join(float_shares.filter("shares > 0").select("td", "tk", "shares"), ["td", "tk"]).select(F.col("td").alias("__held"), "tk", (F.col("quantity") / F.col("shares") / unit).alias("v"))
    # two dates a year at most: a small table
    spans = own.select("__held").distinct().withColumn("__gone", F.date_sub(F.lead("__held").over(Window.orderBy("__held")), 1))
    each = interval_join(days.select("td"), spans, "__held", "__gone")
    return own.join(F.broadcast(each), "__held").select("td", "tk", "v")


def state_share(capital: DataFrame, days: DataFrame) -> DataFrame:
    """td, tk, v: the state's part of a name's shares, on the last calendar date up to each announcement.

    capital: tk, ann_dt, change_dt, state (shares of the state, all kinds), total. Of one announcement date the row with the latest change
    counts, of several announcements on one calendar date the latest.
    """
    from .joins import snap_back

    rows = capital.select("tk", F.to_date("ann_dt").alias("ann"), F.to_date("change_dt").alias("change"), F.try_divide("state", "total").alias("ratio"), "state", "total")
    newest = rows.groupBy("tk", "ann").agg(F.max_by("ratio", F.struct("change", "total", "state")).alias("ratio"))
    placed = snap_back(newest, days, "ann", out="td").filter("td is not null")
    return placed.groupBy("td", "tk").agg(F.max_by("ratio", "ann").alias("v"))


def carried(value: str, limit: int) -> Column:
    """The last value of the trailing limit + 1 positions."""
    return F.last(value, ignorenulls=True).over(win.trailing(limit + 1))


@dataclass
class Factor:
    """A factor: the NULL-skipping mean of its standardised sub-factors (columns), weighted by weight when standardised."""

    name: str
    subfactors: list[str]
    weight: str
    steps: tuple[str, ...] = field(default=("winsorize", "standardize"))


def exposures(df: DataFrame, factors: list[Factor]) -> DataFrame:
    """td, tk and one column per factor."""
    for f in factors:
        for s in f.subfactors:
            if "winsorize" in f.steps:
                df = xs.winsorize_mad(df, s, f"__{s}")
            else:
                df = df.withColumn(f"__{s}", F.col(s))
            if "standardize" in f.steps:
                df = df.withColumn(f"__{s}", xs.weighted_zscore(f"__{s}", f.weight))
        parts = [F.col(f"__{s}") for s in f.subfactors]
        n = sum(p.isNotNull().cast("int") for p in parts)
        df = df.withColumn(f.name, F.try_divide(sum(F.coalesce(p, F.lit(0.0)) for p in parts), n))
        df = df.drop(*(f"__{s}" for s in f.subfactors))
    return df.select("td", "tk", *(f.name for f in factors))
