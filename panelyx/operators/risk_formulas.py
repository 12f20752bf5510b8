"""Formulas of the risk graph. Arguments name columns of the panel, tables, subfactors or other formulas; keyword-only ones are parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import cross_section as xs
from ..functions import windows as win
from . import pit, risk

FORMULAS: dict[str, Callable] = {}


def formula(f: Callable) -> Callable:
    FORMULAS[f.__name__] = f
    return f


def _date() -> Window:
    return Window.partitionBy("td")


# --- inputs that others share ---


@formula
def ret(close: str) -> Column:
    return F.try_divide(F.col(close), win.lagged(close, 1)) - 1


@formula
def market_return(ret: str, cap: str) -> Column:
    """Return of all names of the date, weighted by capital."""
    held = F.when(F.col(ret).isNotNull(), F.col(cap))
    return F.try_divide(F.sum(F.col(ret) * held).over(_date()), F.sum(held).over(_date()))


@formula
def daily_turnover(amount: str, cap: str) -> Column:
    return risk.liquidity(amount, cap)


@formula
def market_turnover(amount: str, cap: str) -> Column:
    x = F.try_divide(F.sum(amount).over(_date()), F.sum(cap).over(_date()))
    return F.when(x > 0, F.log(x))


# --- three factors as columns of the date ---


@formula
def seasoned_return(ret: str, ix: str, *, positions: int = 244, limit: float = 0.2) -> Column:
    """The return of names that had one so many positions ago (all names in the first of them), unless it is beyond the limit."""
    old = (F.col(ix) < positions) | win.lagged(ret, positions).isNotNull()
    return F.when(old & (F.abs(ret) <= limit), F.col(ret))


@formula
def lagged_cap(cap: str) -> Column:
    return win.lagged(cap, 1)


@formula
def lagged_value(price_to_book: str) -> Column:
    """One over price to book, a position ago."""
    return F.try_divide(F.lit(1.0), win.lagged(price_to_book, 1))


def bucket_spread(ret: str, indicator: str, cuts: list[float]) -> Column:
    """Mean return of the first bucket of the indicator's percentiles less that of the last, on every row of the date.

    Bucket i holds values in (p[i-1], p[i]], the minimum is in the first.
    """
    p = F.percentile(indicator, F.array(*(F.lit(float(c)) for c in cuts))).over(_date())
    return F.struct(p.alias("p"), F.col(ret).alias("r"), F.col(indicator).alias("x"))


def spread_of(buckets: str, n: int) -> Column:
    b = F.col(buckets)
    first = F.when(b["x"] <= b["p"][1], b["r"])
    last = F.when(b["x"] > b["p"][n - 1], b["r"])
    return F.avg(first).over(_date()) - F.avg(last).over(_date())


@formula
def cap_buckets(seasoned_return: str, lagged_cap: str) -> Column:
    return bucket_spread(seasoned_return, lagged_cap, [0.0, 0.5, 1.0])


@formula
def value_buckets(seasoned_return: str, lagged_value: str) -> Column:
    return bucket_spread(seasoned_return, lagged_value, [0.0, 0.3, 0.7, 1.0])


@formula
def smb(cap_buckets: str) -> Column:
    return spread_of(cap_buckets, 2)


@formula
def hml(value_buckets: str, *, sign: int = 1) -> Column:
    """First less last bucket of one over price to book; sign -1 turns it to the usual high less low."""
    return sign * spread_of(value_buckets, 3)


# --- size, beta, trend ---


@formula
def size(cap: str) -> Column:
    return risk.size(cap)


@formula
def beta_sums(ret: str, market_return: str, *, window: int = 243) -> Column:
    return win.pair_sums(ret, market_return, window)


@formula
def beta_fit(beta_sums: str, *, min_periods: int = 122) -> Column:
    return win.slope_of(beta_sums, min_periods)


@formula
def beta(beta_fit: str, industry: str, cap: str) -> Column:
    """Slopes shrunk towards the industry's capital-weighted mean, by the share that the slopes' own variance has."""
    b, se2 = F.col(beta_fit)["slope"], F.col(beta_fit)["se2"]
    used = b.isNotNull() & se2.isNotNull() & F.col(industry).isNotNull() & F.col(cap).isNotNull()
    g = Window.partitionBy("td", industry)
    s = lambda v: F.sum(F.when(used, v)).over(g)
    n, w = s(F.lit(1.0)), s(F.col(cap))
    mean = F.try_divide(s(b * F.col(cap)), w)
    # mean square about the weighted mean, from sums
    var = s(b * b) / n - 2 * mean * s(b) / n + mean * mean
    c = F.try_divide(var, var + se2)
    return F.when(used, c * b + (1 - c) * mean)


@formula
def trend(close: str, *, short: float = 20, long: float = 120, short_periods: int = 10, min_periods: int = 60) -> Column:
    """Fast over slow exponential mean of prices."""
    return F.try_divide(win.ewm_mean(close, short, short_periods), win.ewm_mean(close, long, min_periods))


# --- liquidity and volatility ---


@formula
def turnover(daily_turnover: str, *, window: int = 243, min_periods: int = 122) -> Column:
    return win.rolling_mean(daily_turnover, window, min_periods)


@formula
def turnover_sums(daily_turnover: str, market_turnover: str, *, window: int = 243) -> Column:
    return win.pair_sums(daily_turnover, market_turnover, window)


@formula
def liquidity_beta(turnover_sums: str, *, min_periods: int = 122) -> Column:
    return win.slope_of(turnover_sums, min_periods)["slope"]


@formula
def stdvol(ret: str, *, window: int = 243, min_periods: int = 122) -> Column:
    return win.rolling_std(ret, window, min_periods)


@formula
def price_range(high: str, low: str, *, window: int = 243, min_periods: int = 122) -> Column:
    w = win.trailing(window)
    top = F.when(F.count(high).over(w) >= min_periods, F.max(high).over(w))
    return F.try_divide(top, F.when(F.count(low).over(w) >= min_periods, F.min(low).over(w))) - 1


@formula
def max_ret(ret: str, *, window: int = 243, num: int = 6, min_periods: int = 122) -> Column:
    return win.extreme_mean(ret, window, num, True, min_periods)


@formula
def min_ret(ret: str, *, window: int = 243, num: int = 6, min_periods: int = 122) -> Column:
    return win.extreme_mean(ret, window, num, False, min_periods)


@formula
def factor_products(ret: str, market_return: str, smb: str, hml: str, *, window: int = 243) -> Column:
    """Window sums of all products of (1, market, smb, hml, return); a missing factor counts as 0, a missing return leaves the row out."""
    w, there = win.trailing(window), F.col(ret).isNotNull()
    terms = [F.lit(1.0), *(F.coalesce(F.col(x), F.lit(0.0)) for x in (market_return, smb, hml)), F.col(ret)]
    return F.struct(*(F.sum(F.when(there, a * b)).over(w).alias(f"s{i}_{j}") for i, a in enumerate(terms) for j, b in enumerate(terms) if i <= j), F.count(F.when(there, 1)).over(w).alias("n"))


def _eliminated(products: str, p: int, k: int) -> Column:
    """The products with regressor p taken out of all later ones; the diagonal of the beginning stays in o1 ... for the test of dependence."""
    s = F.col(products)
    own = s[f"s{p}_{p}"]
    pivot = F.when(own > 1e-10 * (s[f"o{p}"] if p else own), 1 / own).otherwise(F.lit(0.0))
    left = [(s[f"s{i}_{j}"] - s[f"s{p}_{i}"] * s[f"s{p}_{j}"] * pivot).alias(f"s{i}_{j}") for i in range(p + 1, k + 1) for j in range(i, k + 1)]
    first = [(s[f"s{i}_{i}"] if not p else s[f"o{i}"]).alias(f"o{i}") for i in range(p + 1, k)]
    return F.struct(*left, *first, s["n"].alias("n"))


@formula
def less_constant(factor_products: str) -> Column:
    return _eliminated(factor_products, 0, 4)


@formula
def less_market(less_constant: str) -> Column:
    return _eliminated(less_constant, 1, 4)


@formula
def less_size(less_market: str) -> Column:
    return _eliminated(less_market, 2, 4)


@formula
def less_all(less_size: str) -> Column:
    return _eliminated(less_size, 3, 4)


@formula
def ivff(less_all: str, *, min_periods: int = 122) -> Column:
    """Deviation of the return's residuals around market, size and value returns."""
    s = F.col(less_all)
    return F.when(s["n"] >= max(min_periods, 5), F.sqrt(F.greatest(s["s4_4"], F.lit(0.0)) / s["n"]))


# --- value and growth, from tables of facts ---


def _daily(f: DataFrame, days: DataFrame) -> DataFrame:
    return pit.fill_to_dates(f, days)


@formula
def profit(earnings: DataFrame, days: DataFrame) -> DataFrame:
    return _daily(pit.trailing_year(earnings), days)


@formula
def book(equity: DataFrame, days: DataFrame) -> DataFrame:
    return _daily(equity, days)


@formula
def ep_ttm(profit: str, cap: str) -> Column:
    return F.try_divide(profit, cap)


@formula
def bp(book: str, cap: str) -> Column:
    return F.try_divide(book, cap)


@formula
def price_to_book(cap: str, book: str) -> Column:
    return F.try_divide(cap, book)


@formula
def delta_roe(earnings: DataFrame, equity: DataFrame, days: DataFrame) -> DataFrame:
    return _daily(pit.delta_of_ratio(earnings, equity), days)


@formula
def sales_growth(sales: DataFrame, days: DataFrame) -> DataFrame:
    return _daily(pit.window_stat(pit.trailing_year(sales), "cagr", 12), days)


@formula
def na_growth(equity: DataFrame, days: DataFrame) -> DataFrame:
    return _daily(pit.window_stat(equity, "cagr", 12), days)


# --- non-linear size, certainty, state share ---


@formula
def cubed_size(size_sub: str) -> Column:
    return F.pow(F.col(size_sub), F.lit(3.0))


@formula
def root_cap(cap: str) -> Column:
    return F.sqrt(cap)


@formula
def nls(cubed_size: str, size_sub: str, root_cap: str) -> Column:
    """What is left of the cube of the processed size after the size itself."""
    return xs.weighted_residual(cubed_size, size_sub, root_cap)


@formula
def institution_share(holdings: DataFrame, float_shares: DataFrame, days: DataFrame) -> DataFrame:
    return risk.institution_share(holdings, float_shares, days)


@formula
def instholder_pct(institution_share: str, close: str) -> Column:
    return F.when(F.col(close).isNotNull(), F.col(institution_share))


@formula
def institutions(estimates: DataFrame, days: DataFrame, *, window_days: int = 170) -> DataFrame:
    return pit.coverage(estimates, days, window_days=window_days).withColumnRenamed("n", "v")


@formula
def covered(institutions: str) -> Column:
    return F.coalesce(F.col(institutions), F.lit(0.0))


@formula
def one(ix: str) -> Column:
    return F.col(ix) * 0 + F.lit(1.0)


@formula
def coverage(covered: str, size_sub: str, one: str) -> Column:
    """Institutions that cover a name, less what its size explains; 0 where that is not known."""
    return F.coalesce(xs.weighted_residual(covered, size_sub, one), F.lit(0.0))


@formula
def listed_days(listings: DataFrame, days: DataFrame) -> DataFrame:
    return risk.listed_days(days, listings, "tk", "list_dt", "delist_dt").withColumnRenamed("listed_days", "v")


@formula
def state_share(capital: DataFrame, days: DataFrame) -> DataFrame:
    return risk.state_share(capital, days)


@formula
def soe(state_share: str, close: str, *, limit: int = 243) -> Column:
    """The state's share of a name's stock, carried so many positions, else 0; NULL without a close."""
    return F.when(F.col(close).isNotNull(), F.coalesce(risk.carried(state_share, limit), F.lit(0.0)))


@formula
def industry(industries: DataFrame) -> DataFrame:
    """The name's industry as a number; of several on one date the first by name."""
    code = F.dense_rank().over(Window.orderBy("industry"))
    names = industries.select("industry").distinct().withColumn("v", code)
    return industries.groupBy("td", "tk").agg(F.min("industry").alias("industry")).join(F.broadcast(names), "industry").select("td", "tk", "v")


#: The factors of the model, their subfactors and the steps that these go through. Windows are parameters, see config().
BOX_Z = ("winsorize_box", "standardize")
CERTAIN = ("winsorize_box", "standardize", "compress", "standardize")


def config(window: int = 243, min_periods: int = 122, long: int = 240, middle: int = 120, short: int = 20, industries: tuple[str, ...] = ()) -> list[dict]:
    """The model's twelve factors as plain data, for graph.from_config."""
    span = {"window": window, "min_periods": min_periods}
    sub = lambda name, params=None, universe=None, steps=BOX_Z, formula=None: {"name": name, "formula": formula or name, "params": params or {}, "universe": universe, "steps": list(steps)}
    style = lambda name, *subs, steps=BOX_Z: {"name": name, "type": "style", "subfactors": list(subs), "steps": list(steps)}
    return [
        {"name": "market", "type": "market"},
        style("size", sub("size_sub", formula="size"), steps=()),
        style("beta", sub("beta_sub", universe="seasoned", formula="beta"), steps=()),
        style("trend", *(sub(f"trend_{n}", {"short": short, "long": n, "short_periods": short // 2, "min_periods": n // 2}, formula="trend") for n in (middle, long))),
        style("liquidity", sub("turnover_sub", span, formula="turnover"), sub("liquidity_beta_sub", {"min_periods": min_periods}, "seasoned", formula="liquidity_beta")),
        style("volatility", sub("stdvol_sub", span, formula="stdvol"), sub("price_range_sub", span, formula="price_range"), sub("max_ret_6", span | {"num": 6}, formula="max_ret"), sub("min_ret_6", span | {"num": 6}, formula="min_ret"), sub("ivff_sub", {"min_periods": min_periods}, "seasoned", formula="ivff")),
        style("value", sub("ep_sub", formula="ep_ttm"), sub("bp_sub", formula="bp")),
        style("growth", sub("delta_roe_sub", formula="delta_roe"), sub("sales_growth_sub", formula="sales_growth"), sub("na_growth_sub", formula="na_growth")),
        style("nls", sub("nls_sub", formula="nls"), steps=()),
        style("certainty", sub("instholder_sub", steps=CERTAIN, formula="instholder_pct"), sub("coverage_sub", steps=CERTAIN, formula="coverage"), sub("listed_days_sub", formula="listed_days"), steps=()),
        style("soe", sub("soe_sub", steps=("standardize",), formula="soe"), steps=()),
        {"name": "industry", "type": "industry", "values": list(industries)},
    ]
