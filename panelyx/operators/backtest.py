"""Ranked-bucket evaluation, portfolio returns, exposures and performance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cross_section import correlation


def quantile_groups(df: DataFrame, col: str, groups: int, out: str = "grp", *, date: str = "td", entity: str = "tk") -> DataFrame:
    """Ascending groups of N div groups names each; the top N mod groups names have no group; ties go by entity."""
    w = Window.partitionBy(date)
    df = df.filter(F.col(col).isNotNull()).withColumn("__rn", F.row_number().over(w.orderBy(col, entity))).withColumn("__size", F.floor(F.count("*").over(w) / groups))
    return df.withColumn(out, F.floor((F.col("__rn") - 1) / F.col("__size")) + 1).filter((F.col("__size") > 0) & (F.col(out) <= groups)).withColumn(out, F.col(out).cast("int")).drop("__rn", "__size")


def average_rank(col: str, *by: str) -> Column:
    """Rank from 1, ties share their mean."""
    w = Window.partitionBy(*by)
    return F.when(F.col(col).isNotNull(), F.rank().over(w.orderBy(F.col(col).asc_nulls_last())) + (F.count(col).over(Window.partitionBy(*by, col)) - 1) / 2.0)


def information_coefficient(df: DataFrame, factor: str, forward: str, *by: str) -> DataFrame:
    """ic (Pearson), rank_ic (Spearman) and the slope's t statistic by date (and more keys); a missing forward return is 0."""
    rows = df.filter(F.col(factor).isNotNull()).withColumn("__y", F.coalesce(forward, F.lit(0.0)))
    rows = rows.withColumn("__rx", average_rank(factor, *by)).withColumn("__ry", average_rank("__y", *by))
    out = rows.groupBy(*by).agg(F.count("*").alias("n"), correlation(factor, "__y").alias("ic"), correlation("__rx", "__ry").alias("rank_ic"))
    return out.withColumn("t", F.when((F.col("n") > 2) & (F.abs("ic") < 1), F.col("ic") * F.sqrt((F.col("n") - 2) / (1 - F.col("ic") * F.col("ic")))))


def drifted_weights(segments: DataFrame, returns: DataFrame) -> DataFrame:
    """segments: seg, tk, w0, from_ix, to_ix (positions held, first and last). returns: tk, ix, r. Columns seg, tk, ix, grown.

    Inside a segment a basket is bought and held: its grown value is w0 times the product of (1 + r) from the segment's
    first day. Positions without a return count as return 0.
    """
    days = segments.withColumn("ix", F.explode(F.sequence("from_ix", "to_ix")))
    joined = days.join(returns.select("tk", "ix", "r"), ["tk", "ix"], "left").withColumn("r", F.coalesce("r", F.lit(0.0)))
    w = Window.partitionBy("seg", "tk").orderBy("ix").rowsBetween(Window.unboundedPreceding, 0)
    return joined.withColumn("grown", F.col("w0") * F.product(1 + F.col("r")).over(w))


def basket_returns(grown: DataFrame) -> DataFrame:
    """Daily return of each segment's basket: ratio of the summed values, against the initial sum on the first day."""
    value = grown.groupBy("seg", "ix").agg(F.sum("grown").alias("v"), F.sum("w0").alias("w"))
    w = Window.partitionBy("seg").orderBy("ix")
    return value.withColumn("ret", F.col("v") / F.coalesce(F.lag("v").over(w), F.col("w")) - 1).select("seg", "ix", "ret")


def turnover(grown: DataFrame, segments: DataFrame) -> DataFrame:
    """Sum of |old drifted weight - new weight| at each switch, over the full outer join of the two baskets."""
    last = grown.filter("ix = to_ix").withColumn("w", F.col("grown") / F.sum("grown").over(Window.partitionBy("seg"))).select((F.col("seg") + 1).alias("seg"), "tk", F.col("w").alias("w_old"))
    new = segments.select("seg", "tk", F.col("w0").alias("w_new"))
    first = segments.agg(F.min("seg").alias("lo"), F.max("seg").alias("hi"))
    both = new.join(last, ["seg", "tk"], "full").join(F.broadcast(first)).filter("seg > lo and seg <= hi")
    return both.groupBy("seg").agg(F.sum(F.abs(F.coalesce("w_old", F.lit(0.0)) - F.coalesce("w_new", F.lit(0.0)))).alias("turnover"))


def drawdowns(nav: DataFrame, by: str, order: str = "ix", value: str = "nav") -> DataFrame:
    """nav with dd (value over its running maximum, less 1)."""
    w = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return nav.withColumn("dd", F.col(value) / F.max(value).over(w) - 1)


def drawdown_episodes(dd: DataFrame, by: str, order: str = "ix") -> DataFrame:
    """Runs of dd < 0: first and last position, length and depth."""
    w = Window.partitionBy(by).orderBy(order)
    runs = dd.withColumn("__run", F.sum((F.col("dd") >= 0).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))).filter("dd < 0")
    return runs.groupBy(by, "__run").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("days"), F.min("dd").alias("depth")).drop("__run")


def performance(returns: DataFrame, by: list[str], ret: str = "ret", *, per_year: int = 52) -> DataFrame:
    """Total and annual return, volatility, Sharpe ratio and share of winning periods, by any keys."""
    out = returns.groupBy(*by).agg(F.count(ret).alias("n"), (F.product(1 + F.col(ret)) - 1).alias("total"), F.stddev_samp(ret).alias("sd"), F.avg((F.col(ret) > 0).cast("double")).alias("win"))
    out = out.withColumn("annual", F.pow(1 + F.col("total"), F.lit(float(per_year)) / F.col("n")) - 1).withColumn("vol", F.col("sd") * F.lit(float(per_year) ** 0.5))
    return out.withColumn("sharpe", F.try_divide(F.col("annual"), F.col("vol"))).drop("sd")


def screen(df: DataFrame, rules: list[tuple[str, float]], *, date: str = "td", entity: str = "tk", least: int = 10) -> DataFrame:
    """Names that pass all screens of a date. A rule is (column, size): |size| >= 1 counts names, under 1 is a share (at
    least one name); positive takes the smallest values, negative the largest. A rule that would leave fewer than
    ``least`` names of the date is skipped."""
    w = Window.partitionBy(date)
    df = df.withColumn("__in", F.lit(True))
    for col, size in rules:
        order = F.col(col).asc_nulls_last() if size > 0 else F.col(col).desc_nulls_last()
        n = F.lit(abs(size)) if abs(size) >= 1 else F.greatest(F.lit(1), F.floor(F.count(col).over(w) * abs(size)))
        df = df.withColumn("__next", F.col("__in") & F.col(col).isNotNull() & (F.row_number().over(w.orderBy(order, entity)) <= n))
        df = df.withColumn("__left", F.count_if("__next").over(w)).withColumn("__in", F.when(F.col("__left") >= least, F.col("__next")).otherwise(F.col("__in")))
    return df.filter("__in").drop("__in", "__next", "__left")


def capacity(holdings: DataFrame, amount: str = "amount", weight: str = "w", *, date: str = "td", share: float = 0.1) -> DataFrame:
    return holdings.groupBy(date).agg(
        F.sum(amount).alias("total"), F.try_divide(F.sum(F.col(weight) * F.col(amount)), F.sum(weight)).alias("mean_amount"),
        F.min(amount).alias("min_amount"), F.max(amount).alias("max_amount"), F.min(weight).alias("min_weight"), F.max(weight).alias("max_weight"), (share * F.sum(amount)).alias("capacity"),
    )


def rolling_max_drawdown(nav: DataFrame, by: str, window: int, order: str = "ix", value: str = "nav") -> DataFrame:
    """nav with mdd: the deepest fall inside the last ``window`` rows, NULL before there are so many."""
    w = Window.partitionBy(by).orderBy(order).rowsBetween(-(window - 1), 0)
    fall = F.aggregate(
        F.collect_list(value).over(w), F.struct(F.lit(0.0).alias("top"), F.lit(0.0).alias("low")),
        lambda s, x: F.struct(F.greatest(s["top"], x).alias("top"), F.least(s["low"], x / F.greatest(s["top"], x) - 1).alias("low")),
    )
    return nav.withColumn("mdd", F.when(F.count(value).over(w) == window, fall["low"]))


def excess(portfolio: DataFrame, benchmark: DataFrame, by: str = "one", order: str = "ix") -> DataFrame:
    """Both with order and ret: excess return (1 + p) / (1 + b) - 1 and its cumulated value."""
    rows = portfolio.join(benchmark.select(order, F.col("ret").alias("base")), order, "left").withColumn("excess", (1 + F.col("ret")) / (1 + F.coalesce("base", F.lit(0.0))) - 1)
    return rows.withColumn("nav", F.product(1 + F.col("excess")).over(Window.partitionBy(by).orderBy(order)))


def rebalance_dates(days: DataFrame, every: int | str) -> DataFrame:
    """Dates of a calendar: each n-th, or the ends of weeks ('W'), months ('M') and quarters ('Q')."""
    if isinstance(every, int):
        return days.filter(F.col("ix") % every == 0)
    flag = {"W": F.col("is_week_end") == 1, "M": F.col("is_month_end") == 1, "Q": (F.col("is_month_end") == 1) & (F.month("td") % 3 == 0)}[every]
    return days.filter(flag)


def deal_returns(panel: DataFrame, deal: str) -> DataFrame:
    """panel (tk, ix, close and the price dealt at) with r (close to close), sell (dealt at over the close before, less 1) and buy (close over dealt at, less 1)."""
    before = F.max("close").over(Window.partitionBy("tk").orderBy("ix").rangeBetween(-1, -1))
    return panel.withColumn("__b", before).withColumns({"r": F.try_divide("close", "__b") - 1, "sell": F.try_divide(deal, "__b") - 1, "buy": F.try_divide("close", deal) - 1}).drop("__b")


def returns_at_deal(segments: DataFrame, returns: DataFrame) -> DataFrame:
    """seg, ix, ret of baskets that change hands at a price of the day. returns: tk, ix, r, sell, buy; missing ones are 0.

    The first basket is bought at the close before its first day. On every later switch day the old basket is sold, what
    it brings buys the new one: (1 + sum of w_old * sell) * (1 + sum of w_new * buy) - 1. A basket that was bought in the
    day starts with its buy return.
    """
    values = {c: F.coalesce(c, F.lit(0.0)) for c in ("r", "sell", "buy")}
    start = segments.agg(F.min("seg").alias("__first"))
    days = segments.join(F.broadcast(start)).withColumn("ix", F.explode(F.sequence("from_ix", "to_ix")))
    held = days.join(returns.select("tk", "ix", *values), ["tk", "ix"], "left").withColumns(values)
    bought = (F.col("ix") == F.col("from_ix")) & (F.col("seg") > F.col("__first"))
    w = Window.partitionBy("seg", "tk").orderBy("ix").rowsBetween(Window.unboundedPreceding, 0)
    grown = held.withColumn("grown", F.col("w0") * F.product(1 + F.when(bought, F.col("buy")).otherwise(F.col("r"))).over(w))
    value = grown.groupBy("seg", "ix").agg(F.sum("grown").alias("v"), F.sum("w0").alias("w"))
    order = Window.partitionBy("seg").orderBy("ix")
    base = value.withColumn("ret", F.col("v") / F.coalesce(F.lag("v").over(order), F.col("w")) - 1).select("seg", "ix", "ret")
    # what the old basket earns on the first day of the next one
    ends = grown.filter("ix = to_ix").select((F.col("seg") + 1).alias("seg"), "tk", (F.col("ix") + 1).alias("ix"), "grown")
    sold = ends.join(returns.select("tk", "ix", F.coalesce("sell", F.lit(0.0)).alias("sell")), ["tk", "ix"], "left").groupBy("seg", "ix").agg(F.try_divide(F.sum(F.col("grown") * F.coalesce("sell", F.lit(0.0))), F.sum("grown")).alias("sold"))
    return base.join(sold, ["seg", "ix"], "left").withColumn("ret", (1 + F.coalesce("sold", F.lit(0.0))) * (1 + F.col("ret")) - 1).drop("sold")


def latest_scores(df: DataFrame, factor: str, names: DataFrame | None = None, *, date: str = "td", entity: str = "tk") -> DataFrame:
    """Scores of the last date with their place, largest first (ties by entity), and further columns of names."""
    last = df.filter(F.col(factor).isNotNull()).agg(F.max(date).alias("__last"))
    rows = df.join(F.broadcast(last), F.col(date) == F.col("__last")).drop("__last").filter(F.col(factor).isNotNull()).select(date, entity, factor)
    rows = rows.withColumn("place", F.row_number().over(Window.partitionBy(date).orderBy(F.desc(factor), entity)))
    return rows.join(names, entity, "left") if names is not None else rows


def group_spreads(groups: DataFrame, forward: str, n: int, *, date: str = "td", group: str = "grp") -> DataFrame:
    """Per date: mean return of the top and the bottom group, top less bottom (lms) and top less the mean of all groups (lmm)."""
    by = groups.groupBy(date, group).agg(F.avg(forward).alias("__r"))
    pick = lambda k: F.max(F.when(F.col(group) == k, F.col("__r")))
    out = by.groupBy(date).agg(pick(n).alias("top"), pick(1).alias("bottom"), F.avg("__r").alias("__m"))
    return out.withColumns({"lms": F.col("top") - F.col("bottom"), "lmm": F.col("top") - F.col("__m")}).drop("__m")


def demeaned_group_returns(groups: DataFrame, forward: str, *, per_year: int = 52, date: str = "td", group: str = "grp") -> DataFrame:
    """Per group: mean return a year, less the mean of all groups on each date."""
    by = groups.groupBy(date, group).agg(F.avg(forward).alias("__r"))
    by = by.withColumn("__d", F.col("__r") - F.avg("__r").over(Window.partitionBy(date)))
    return by.groupBy(group).agg(F.count("__d").alias("n"), (F.avg("__d") * per_year).alias("annual"))


def index_returns(quotes: DataFrame, percent: str = "pct", *, by: str = "code", order: str = "td") -> DataFrame:
    """Returns of an index from percent changes; its first row has 0."""
    first = F.row_number().over(Window.partitionBy(by).orderBy(order)) == 1
    return quotes.withColumn("ret", F.when(first, F.lit(0.0)).otherwise(F.col(percent) / 100))


def turnover_statistics(turnovers: DataFrame, value: str = "turnover", *, date: str = "td") -> DataFrame:
    """Mean turnover of the dates that have one, times the median number of such dates in a year."""
    real = turnovers.filter(F.col(value) != 0)
    yearly = real.groupBy(F.year(date).alias("y")).agg(F.count("*").alias("k"), F.sum(value).alias("s"))
    return yearly.agg(F.try_divide(F.sum("s"), F.sum("k")).alias("mean"), F.median("k").alias("times")).withColumn("annual", F.col("mean") * F.col("times"))


def active_exposure(portfolio: DataFrame, index: DataFrame, exposures: DataFrame, styles: list[str], *, date: str = "td", entity: str = "tk", weight: str = "w") -> DataFrame:
    """Per date: weighted styles of the portfolio less those of the index, both with weights made to sum to 1."""

    def of(holdings: DataFrame, sign: int) -> DataFrame:
        share = F.col(weight) / F.sum(weight).over(Window.partitionBy(date))
        return holdings.select(date, entity, (sign * share).alias("__w"))

    both = of(portfolio, 1).unionByName(of(index, -1)).join(exposures.select(date, entity, *styles), [date, entity])
    return both.groupBy(date).agg(*(F.sum(F.col("__w") * F.col(s)).alias(s) for s in styles))
