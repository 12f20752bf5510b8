"""Whole reports of factors and portfolios: all baskets in one pass, all periods in one table.

A basket's group is a column, so that every group of a factor goes through the same plan. Names are not laid out over the days that they
are held: a basket's value is the sum of its weights and of what each name's bars add to it, so a name without a bar adds nothing
that day. What is wanted "by year and of the whole" comes from rows that belong to two periods, not from two plans.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .backtest import average_rank

PRECLOSE = "preclose"  # the price that baskets change hands at: the close before, or a column of the day


def schedule(days: DataFrame, rebalanced: DataFrame) -> DataFrame:
    """td, ix and, for each date of the calendar: opens (number of the segment decided on it), next_ix (the position of the next decision),
    seg (the segment held on it), first (its first day). A segment is held from the position after its decision up to the next decision.

    A decision on the calendar's last date has no day and does not count. Calendars are small; one ordered window is fine.
    """
    w = Window.orderBy("ix")
    marked = days.select("td", "ix").join(F.broadcast(rebalanced.select("td").distinct().withColumn("__on", F.lit(True))), "td", "left")
    marked = marked.withColumn("__on", F.coalesce("__on", F.lit(False)) & F.lead("ix").over(w).isNotNull())
    number = F.sum(F.col("__on").cast("int"))
    before = F.coalesce(number.over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    out = marked.select(
        "td", "ix", F.when(F.col("__on"), before.cast("int")).alias("opens"), F.when(before > 0, (before - 1).cast("int")).alias("seg"), F.coalesce(F.lag("__on").over(w), F.lit(False)).alias("first"),
        F.min(F.when(F.col("__on"), F.col("ix"))).over(w.rowsBetween(1, Window.unboundedFollowing)).alias("next_ix"),
    )
    return out


def prices(panel: DataFrame, deal: str = PRECLOSE) -> DataFrame:
    """panel with r (close to close) and, for a price of the day, sell (from the close before to it) and buy (from it to the close)."""
    before = F.max("close").over(Window.partitionBy("tk").orderBy("ix").rangeBetween(-1, -1))
    out = panel.withColumn("__b", before).withColumn("r", F.try_divide("close", "__b") - 1)
    if deal == PRECLOSE:
        return out.withColumns({"sell": F.lit(None).cast("double"), "buy": F.lit(None).cast("double")}).drop("__b")
    return out.withColumns({"sell": F.try_divide(deal, "__b") - 1, "buy": F.try_divide("close", deal) - 1}).drop("__b")


def grouped(panel: DataFrame, factor: str, groups: int) -> DataFrame:
    """panel with grp (NULL: in none) and w0: on every date, groups of N div groups names each by ascending factor, equal weights."""
    date = Window.partitionBy("td")
    place = F.row_number().over(date.orderBy(F.col(factor).asc_nulls_last(), "tk"))
    out = panel.withColumn("__n", F.count(factor).over(date)).withColumn("__p", F.when(F.col(factor).isNotNull(), place)).withColumn("__size", F.floor(F.col("__n") / groups))
    grp = F.floor((F.col("__p") - 1) / F.when(F.col("__size") > 0, F.col("__size"))) + 1
    out = out.withColumn("grp", F.when(grp <= groups, grp).cast("int"))
    return out.withColumn("w0", F.when(F.col("grp").isNotNull(), F.lit(1.0) / F.col("__size"))).drop("__n", "__p", "__size")


def held(rows: DataFrame, plan: DataFrame, deal: str = PRECLOSE) -> DataFrame:
    """grp, seg, tk, ix, grown (value at the end of that position), delta (what it adds to the basket), w0, end (the name's last row there).

    rows: tk, ix, r, sell, buy, grp, w0 (the last two read on dates of decision only). plan: from schedule.
    """
    one = lambda seg, factor, grp=None, w0=None: F.struct(seg.cast("int").alias("seg"), factor.cast("double").alias("factor"), (F.lit(None) if grp is None else grp).cast("int").alias("grp"), (F.lit(None) if w0 is None else w0).cast("double").alias("w0"))
    r, later = F.coalesce("r", F.lit(0.0)), F.col("first") & (F.col("seg") > 0)
    day = r if deal == PRECLOSE else F.when(later, F.coalesce("buy", F.lit(0.0))).otherwise(r)
    parts = [F.when(F.col("opens").isNotNull() & F.col("grp").isNotNull(), one(F.col("opens"), F.lit(1.0), F.col("grp"), F.col("w0"))), F.when(F.col("seg").isNotNull(), one(F.col("seg"), 1 + day))]
    if deal != PRECLOSE:
        parts.append(F.when(later, one(F.col("seg") - 1, 1 + F.coalesce("sell", F.lit(0.0)))))
    # a calendar is small and sent to all tasks
    each = rows.join(F.broadcast(plan.select("ix", "opens", "seg", "first")), "ix").select("tk", "ix", F.explode(F.filter(F.array(*parts), lambda p: p.isNotNull())).alias("p")).select("tk", "ix", "p.*")
    by = Window.partitionBy("seg", "tk")
    along = by.orderBy("ix").rowsBetween(Window.unboundedPreceding, 0)
    own = each.withColumns({"grp": F.max("grp").over(by), "w0": F.max("w0").over(by), "grown": F.product("factor").over(along), "end": F.col("ix") == F.max("ix").over(by)}).filter("grp is not null")
    own = own.withColumn("grown", F.col("w0") * F.col("grown"))
    return own.select("grp", "seg", "tk", "ix", "grown", (F.col("grown") - F.coalesce(F.lag("grown").over(by.orderBy("ix")), F.lit(0.0))).alias("delta"), "w0", "end")


def _until(rows: DataFrame, plan: DataFrame, *by: str) -> DataFrame:
    """rows (by, seg, ix) repeated on the positions up to the next row, or to the end of the segment, with new: true on the row's own."""
    ends = plan.groupBy().agg(F.max("ix").alias("__last"))
    spans = plan.filter("opens is not null").select(F.col("opens").alias("seg"), "next_ix").join(F.broadcast(ends)).select("seg", F.coalesce("next_ix", "__last").alias("__to"))
    after = F.lead("ix").over(Window.partitionBy(*by, "seg").orderBy("ix"))
    wide = rows.join(F.broadcast(spans), "seg").withColumn("__to", F.greatest("ix", F.coalesce(after - 1, F.col("__to"))))
    return wide.withColumn("__ix", F.explode(F.sequence("ix", "__to"))).withColumn("new", F.col("ix") == F.col("__ix")).drop("ix", "__to").withColumnRenamed("__ix", "ix")


def laid_out(own: DataFrame, plan: DataFrame) -> DataFrame:
    """grp, seg, tk, ix, w0, grown of every name on every day of its segment; where a name has no bar its value stays."""
    days = _until(own, plan, "grp", "tk").join(F.broadcast(plan.filter("opens is not null").select(F.col("opens").alias("seg"), F.col("ix").alias("__open"))), "seg")
    return days.filter(F.col("ix") > F.col("__open")).select("grp", "seg", "tk", "ix", "w0", "grown")


def basket_days(own: DataFrame, plan: DataFrame) -> DataFrame:
    """grp, td, ix, seg (held on it), ret of every group on every day from its first decision (return 0) on; 0 on days on which it holds nothing."""
    added = own.groupBy("grp", "seg", "ix").agg(F.sum("delta").alias("delta"))
    # a day on which no name of the basket has a bar adds nothing
    full = _until(added, plan, "grp").withColumn("delta", F.when(F.col("new"), F.col("delta")).otherwise(F.lit(0.0)))
    w = Window.partitionBy("grp", "seg").orderBy("ix")
    value = full.withColumn("v", F.sum("delta").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    moved = value.withColumn("g", F.col("v") / F.lag("v").over(w)).filter(F.col("g").isNotNull() | (F.col("seg") == 0)).withColumn("g", F.coalesce("g", F.lit(1.0)))
    out = moved.groupBy("grp", "ix").agg((F.product("g") - 1).alias("ret"))
    # a decision that finds too few names leaves a group empty until the next one
    newest = plan.agg(F.max("ix").alias("__last"))
    after = F.lead("ix").over(Window.partitionBy("grp").orderBy("ix"))
    each = out.join(F.broadcast(newest)).withColumn("__to", F.coalesce(after - 1, F.greatest("ix", "__last")))
    each = each.withColumn("__ix", F.explode(F.sequence("ix", "__to")))
    out = each.select("grp", F.col("__ix").alias("ix"), F.when(F.col("ix") == F.col("__ix"), F.col("ret")).otherwise(F.lit(0.0)).alias("ret"))
    return out.join(F.broadcast(plan.select("ix", "td", "seg")), "ix").select("grp", "td", "ix", "seg", "ret")


def basket_turnover(own: DataFrame, plan: DataFrame) -> DataFrame:
    """grp, seg, td, ix, turnover of every change from one basket to the next (either may be empty): summed differences of weights, on the first day of the new one."""
    ends = own.filter("end").withColumn("__w", F.col("grown") / F.sum("grown").over(Window.partitionBy("grp", "seg")))
    sides = ends.select("grp", "tk", F.explode(F.array(F.struct(F.col("seg").alias("seg"), F.col("w0").alias("w")), F.struct((F.col("seg") + 1).alias("seg"), (-F.col("__w")).alias("w")))).alias("s"))
    apart = sides.groupBy("grp", "s.seg", "tk").agg(F.sum("s.w").alias("w"))
    out = apart.groupBy("grp", "seg").agg(F.sum(F.abs("w")).alias("turnover")).filter("seg > 0")
    days = plan.filter("first").select("seg", "td", "ix")
    return out.join(F.broadcast(days), "seg").select("grp", "seg", "td", "ix", "turnover")


def coefficients(rows: DataFrame, plan: DataFrame, factor: str, *by: str) -> DataFrame:
    """td (dates of decision that have a next one), ic, rank_ic, t of the factor and the return up to the next decision (missing: 0)."""
    ahead = Window.partitionBy("tk").orderBy("ix").rangeBetween(1, Window.unboundedFollowing)
    marked = rows.join(F.broadcast(plan.select("ix", "opens", "next_ix")), "ix")
    # the name's bar on its next date of decision, which has to be the calendar's next one
    later = F.first(F.when(F.col("opens").isNotNull(), F.struct("ix", "close")), ignorenulls=True).over(ahead)
    marked = marked.withColumn("__n", later).filter("opens is not null and next_ix is not null").filter(F.col(factor).isNotNull())
    fwd = F.when(F.col("__n.ix") == F.col("next_ix"), F.col("__n.close") / F.col("close") - 1)
    keys = ["td", *by]
    pairs = marked.withColumn("__y", F.coalesce(fwd, F.lit(0.0))).select(*keys, F.col(factor).cast("double").alias("__x"), "__y")
    pairs = pairs.withColumns({"__rx": average_rank("__x", *keys), "__ry": average_rank("__y", *keys)})
    correlation = lambda x, y: F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
    out = pairs.groupBy(*keys).agg(F.count("*").alias("n"), correlation("__x", "__y").alias("ic"), correlation("__rx", "__ry").alias("rank_ic"))
    return out.withColumn("t", F.when((F.col("n") > 2) & (F.abs("ic") < 1), F.col("ic") * F.sqrt((F.col("n") - 2) / (1 - F.col("ic") * F.col("ic")))))


def spreads(daily: DataFrame, groups: int) -> DataFrame:
    """td, ix, lms (last group less the first), lmm (last group less the mean of all) of the dates on which every group has a return."""
    of = lambda g: F.max(F.when(F.col("grp") == g, F.col("ret")))
    out = daily.groupBy("td", "ix").agg(of(groups).alias("top"), of(1).alias("low"), F.avg("ret").alias("mean"), F.count("ret").alias("n")).filter(F.col("n") == groups)
    return out.select("td", "ix", (F.col("top") - F.col("low")).alias("lms"), (F.col("top") - F.col("mean")).alias("lmm"))


def periods(td: str = "td") -> Column:
    """Every row belongs to its year and to the whole."""
    return F.explode(F.array(F.year(td).cast("string"), F.lit("all"))).alias("period")


def _range(value: str, *by: str, order: str) -> tuple[Column, Window]:
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return F.product(1 + F.col(value)).over(w), w


def factor_performance(daily: DataFrame, turnover: DataFrame, coefficients: DataFrame, groups: int, *, per_year: int = 252, rebalances: float = 12.0) -> DataFrame:
    """period (a year, or all) and: ic, ric, t, their information ratios and shares of positive ones; annual, sharpe, max_drawdown and win of
    long less short (lms) and long less mean (lmm); long_turnover.

    A year's return is its own, that of the whole is per year; turnover of the whole per year too, that of a year summed. rebalances: how many
    dates of decision a year has. Navs begin anew with each period.
    """
    spread = spreads(daily, groups).select("ix", "lms", "lmm", periods())
    for c in ("lms", "lmm"):
        nav, w = _range(c, "period", order="ix")
        spread = spread.withColumn(f"{c}_nav", nav).withColumn(f"{c}_dd", F.col(f"{c}_nav") / F.max(f"{c}_nav").over(w) - 1)
    root = F.lit(float(per_year) ** 0.5)
    whole = F.col("period") == "all"
    n = F.count("*")
    of = []
    for c in ("lms", "lmm"):
        total = F.product(1 + F.col(c))
        of += [F.when(F.first(whole), F.pow(total, F.lit(float(per_year)) / F.when(n > 1, n - 1)) - 1).otherwise(total - 1).alias(f"{c}_annual"), (F.try_divide(F.avg(c), F.stddev_samp(c)) * root).alias(f"{c}_sharpe"), F.min(f"{c}_dd").alias(f"{c}_max_drawdown"), F.avg((F.col(c) > 0).cast("double")).alias(f"{c}_win")]
    a = spread.groupBy("period").agg(*of)
    often = F.lit(float(rebalances) ** 0.5)
    b = coefficients.select("ic", F.col("rank_ic").alias("ric"), "t", periods())
    b = b.groupBy("period").agg(
        F.avg("ic").alias("ic"), F.avg("ric").alias("ric"), (F.try_divide(F.avg("ic"), F.stddev_samp("ic")) * often).alias("ic_ir"), (F.try_divide(F.avg("ric"), F.stddev_samp("ric")) * often).alias("ric_ir"),
        F.avg("t").alias("t"), F.avg((F.col("ic") > 0).cast("double")).alias("ic_win"), F.avg((F.col("ric") > 0).cast("double")).alias("ric_win"),
    )
    turns = turnover.filter(F.col("grp") == groups).select("turnover", periods())
    c = turns.groupBy("period").agg(F.sum("turnover").alias("s"), F.count("*").alias("k"))
    c = c.select("period", F.when(whole, F.try_divide(F.col("s"), F.col("k")) * F.lit(float(rebalances))).otherwise(F.col("s")).alias("long_turnover"))
    return a.join(b, "period", "left").join(c, "period", "left")


def group_performance(daily: DataFrame, *, per_year: int = 252) -> DataFrame:
    """grp, annual: the group's return per year after the mean of all groups is taken off each day."""
    less = daily.withColumn("__d", F.col("ret") - F.avg("ret").over(Window.partitionBy("td")))
    n = F.count("*")
    return less.groupBy("grp").agg((F.pow(F.product(1 + F.col("__d")), F.lit(float(per_year)) / F.when(n > 1, n - 1)) - 1).alias("annual"))


def test_factor(panel: DataFrame, factor: str, groups: int, days: DataFrame, rebalanced: DataFrame, *, deal: str = PRECLOSE, mask: DataFrame | None = None, per_year: int = 252, rebalances: float = 12.0) -> dict[str, DataFrame]:
    """The whole test of a factor: daily (returns and navs by group), turnover, coefficients, performance, group_performance.

    panel: td, tk, ix, close, the factor, and the price dealt at. mask: (td, tk) that count for the factor; others are only held and priced.
    """
    plan = schedule(days, rebalanced)
    if mask is not None:
        panel = panel.join(mask.select("td", "tk", F.lit(True).alias("__in")), ["td", "tk"], "left").withColumn(factor, F.when(F.col("__in"), F.col(factor))).drop("__in")
    rows = grouped(prices(panel, deal), factor, groups)
    own = held(rows, plan, deal)
    daily, turnover = basket_days(own, plan), basket_turnover(own, plan)
    nav, _ = _range("ret", "grp", order="ix")
    found = coefficients(panel, plan, factor)
    return {
        "daily": daily.withColumn("nav", nav), "turnover": turnover, "coefficients": found,
        "performance": factor_performance(daily, turnover, found, groups, per_year=per_year, rebalances=rebalances), "group_performance": group_performance(daily, per_year=per_year),
    }


test_factor.__test__ = False  # not a test


# --- portfolios -----------------------------------------------------------------------------------------------------------


def equal_weights(portfolio: DataFrame, weight: str = "weight") -> DataFrame:
    """td, tk and w0: the given weight, or equal weights where there is none."""
    own = F.col(weight) if weight in portfolio.columns else F.lit(1.0) / F.count("*").over(Window.partitionBy("td"))
    return portfolio.select("td", "tk", own.cast("double").alias("w0"))


SERIES = ("own", "base", "excess")


def _by_period(daily: DataFrame, keys: Sequence[str]) -> DataFrame:
    """daily once for the whole and once for its year; a year begins with the last day of the year before, of return 0."""
    w = Window.partitionBy(*keys).orderBy("td")
    year, after = F.year("td"), F.year(F.lead("td").over(w))
    first = F.row_number().over(w) == 1
    single = first & (after > year)  # a year that has only the first day is no period
    tags = F.array(
        F.struct(F.lit("all").alias("period"), first.alias("base")), F.when(~single, F.struct(year.cast("string").alias("period"), first.alias("base"))), F.when(after > year, F.struct(after.cast("string").alias("period"), F.lit(True).alias("base"))),
    )
    each = daily.withColumn("__tags", F.filter(tags, lambda t: t.isNotNull())).select(*keys, "td", "is_month_end", *SERIES, F.explode("__tags").alias("__t"))
    each = each.select(*keys, "td", "is_month_end", *SERIES, F.col("__t.period").alias("period"), F.col("__t.base").alias("__start"))
    series = F.array(*(F.struct(F.lit(s).alias("series"), F.when(F.col("__start"), F.lit(0.0)).otherwise(F.col(s)).alias("ret")) for s in SERIES))
    rows = each.select(*keys, "td", "period", "__start", "is_month_end", F.explode(series).alias("__s"))
    return rows.select(*keys, "td", "period", F.col("__start").alias("base"), "is_month_end", F.col("__s.series").alias("series"), F.col("__s.ret").alias("ret"))


def statistics(rows: DataFrame, keys: Sequence[str], *, per_year: int = 252, drop: float = 0.005, deep: float = 0.01, rolling: int = 60) -> DataFrame:
    """Per keys: total, annual, max_drawdown, daily_win, monthly_win, volatility, sharpe, the first and last day of the deepest drawdown, share of days
    under -drop, median of the deepest drawdown of ``rolling`` days, and number, mean depth and mean length of drawdowns deeper than ``deep``.

    rows: keys, td, ret, base (the day before the first return, of return 0), is_month_end.
    """
    w = Window.partitionBy(*keys).orderBy("td")
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    p = rows.withColumn("nav", F.product(1 + F.col("ret")).over(so_far)).withColumn("dd", F.col("nav") / F.max("nav").over(so_far) - 1)
    fall = F.aggregate(
        F.collect_list("nav").over(w.rowsBetween(-(rolling - 1), 0)), F.struct(F.lit(0.0).alias("top"), F.lit(0.0).alias("low")),
        lambda s, x: F.struct(F.greatest(s["top"], x).alias("top"), F.least(s["low"], x / F.greatest(s["top"], x) - 1).alias("low")),
    )
    p = p.withColumn("fall", fall["low"]).withColumn("run", F.sum((F.col("dd") >= 0).cast("int")).over(so_far))
    month = F.when(F.col("is_month_end") == 1, F.col("nav"))
    p = p.withColumn("month_before", F.last(month, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))).withColumn("month_ret", month / F.col("month_before") - 1)
    # a drawdown is a run of days below the highest value; its row carries what the last step needs of all its days
    later = ~F.col("base")
    runs = p.groupBy(*keys, "run").agg(
        F.min("dd").alias("depth"), F.count_if(F.col("dd") < 0).alias("length"), F.min(F.when(F.col("dd") < 0, F.col("td"))).alias("since"), F.max(F.when(F.col("dd") < 0, F.col("td"))).alias("until"),
        F.count("*").alias("n"), F.product(1 + F.col("ret")).alias("growth"), F.sum("ret").alias("s1"), F.sum(F.col("ret") * F.col("ret")).alias("s2"), F.count_if(later & (F.col("ret") > 0)).alias("wins"), F.count_if(later).alias("days"),
        F.count_if(later & (F.col("ret") < -drop)).alias("drops"), F.count("month_ret").alias("months"), F.count_if(F.col("month_ret") > 1e-12).alias("month_wins"), F.collect_list("fall").alias("falls"),
    )
    big = F.col("depth") < -deep
    n = F.sum("n")
    out = runs.groupBy(*keys).agg(
        n.alias("n"), (F.product("growth") - 1).alias("total"), F.min("depth").alias("max_drawdown"), F.min_by(F.struct("since", "until"), F.struct("depth", "since")).alias("worst"), F.try_divide(F.sum("wins"), F.sum("days")).alias("daily_win"),
        F.try_divide(F.sum("month_wins"), F.sum("months")).alias("monthly_win"), F.sqrt(F.greatest(F.lit(0.0), (F.sum("s2") - F.sum("s1") * F.sum("s1") / n) / F.when(n > 1, n - 1))).alias("sd"), F.try_divide(F.sum("drops"), F.sum("days")).alias("drop_share"),
        F.flatten(F.collect_list("falls")).alias("falls"), F.count_if(big).alias("deep_count"), F.coalesce(F.avg(F.when(big, F.col("depth"))), F.lit(0.0)).alias("deep_depth"), F.coalesce(F.avg(F.when(big, F.col("length"))), F.lit(0.0)).alias("deep_days"),
    )
    k, sorted_ = F.size("falls"), F.sort_array("falls")
    middle = (F.element_at(sorted_, F.floor((k + 1) / 2).cast("int")) + F.element_at(sorted_, F.floor(k / 2).cast("int") + 1)) / 2
    annual = F.pow(1 + F.col("total"), F.lit(float(per_year)) / F.when(F.col("n") > 1, F.col("n") - 1)) - 1
    out = out.withColumns({"annual": annual, "volatility": F.col("sd") * F.lit(float(per_year) ** 0.5), "rolling_drawdown": middle, "worst_since": F.when(F.col("max_drawdown") < 0, F.col("worst.since")), "worst_until": F.when(F.col("max_drawdown") < 0, F.col("worst.until"))})
    return out.withColumn("sharpe", F.try_divide("annual", "volatility")).drop("sd", "falls", "worst")


def portfolio_report(daily: DataFrame, turnover: DataFrame, days: DataFrame, *, benchmark: DataFrame | None = None, by: Sequence[str] = ("grp",), cost: float = 0.0015, **options) -> DataFrame:
    """by, period (a year, or all) and every figure of a portfolio: own, base and excess returns (of a year its own, of the whole per year), drawdowns, shares of
    winning days and months, tracking error, information and Sharpe ratio, turnover of a change and of a year, and the drawdown records of the excess.

    daily: by, td, ret. turnover: by, td, turnover; its cost comes off the return of its day. benchmark: td, ret, the first day counts 0; none: 0.
    days: the calendar with is_month_end.
    """
    keys = list(by)
    paid = daily.join(turnover.select(*keys, "td", "turnover"), [*keys, "td"], "left")
    base = F.lit(0.0) if benchmark is None else F.coalesce("__base", F.lit(0.0))
    if benchmark is not None:
        paid = paid.join(benchmark.select("td", F.col("ret").alias("__base")), "td", "left")
    own = paid.join(F.broadcast(days.select("td", "is_month_end")), "td").select(*keys, "td", "is_month_end", "turnover", (F.col("ret") - cost * F.coalesce("turnover", F.lit(0.0))).alias("own"), base.alias("base"))
    begins = F.row_number().over(Window.partitionBy(*keys).orderBy("td")) == 1
    own = own.withColumn("base", F.when(begins, F.lit(0.0)).otherwise(F.col("base"))).withColumn("excess", (1 + F.col("own")) / (1 + F.col("base")) - 1)
    stats = statistics(_by_period(own, keys), [*keys, "period", "series"], **options)
    of = lambda series, c: F.max(F.when(F.col("series") == series, F.col(c)))
    gain = F.when(F.col("period") == "all", F.col("annual")).otherwise(F.col("total"))
    wide = stats.withColumn("gain", gain).groupBy(*keys, "period").agg(
        *(of(s, "gain").alias(s) for s in SERIES), *(of("excess", c).alias(c) for c in ("max_drawdown", "daily_win", "monthly_win")), of("excess", "volatility").alias("tracking_error"), of("excess", "sharpe").alias("information_ratio"), of("own", "sharpe").alias("sharpe"),
        *(of("excess", c).alias(c) for c in ("worst_since", "worst_until", "drop_share", "rolling_drawdown", "deep_depth", "deep_count", "deep_days")),
    )
    changes = turnover.filter("turnover <> 0").select(*keys, F.year("td").alias("y"), "turnover")
    yearly = changes.groupBy(*keys, "y").agg(F.count("*").alias("k"), F.sum("turnover").alias("s"))
    each = yearly.select(*keys, "k", "s", F.explode(F.array(F.col("y").cast("string"), F.lit("all"))).alias("period"))
    turned = each.groupBy(*keys, "period").agg(F.try_divide(F.sum("s"), F.sum("k")).alias("turnover_each"), F.median("k").alias("times")).withColumn("turnover_year", F.col("turnover_each") * F.col("times")).drop("times")
    return wide.join(turned, [*keys, "period"], "left")
