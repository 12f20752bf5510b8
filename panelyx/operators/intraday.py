"""Features of intraday bars: columns td, tk, bar (position in the day from 0), open, high, low, close, preclose, volume, amount, trades.

``ret`` is close over the previous close (first bar: over its own open) less 1. Every feature is an aggregate by date
and entity, so bars of one group never leave their task but as sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cross_section import correlation

KEY = ("td", "tk")
_day = Window.partitionBy


def prepared(bars: DataFrame) -> DataFrame:
    w = _day(*KEY).orderBy("bar")
    base = F.coalesce(F.lag("close").over(w), F.col("open"))
    whole = _day(*KEY)
    return (
        bars.withColumn("ret", F.try_divide("close", base) - 1)
        .withColumn("share", F.try_divide(F.col("volume"), F.sum("volume").over(whole)))
        .withColumn("t_max", F.max("bar").over(whole))
        .withColumn("by_volume", F.row_number().over(whole.orderBy(F.desc("volume"), "bar")))
        .withColumn("next_ret", F.lead("ret").over(w))
        .withColumn("next_volume", F.lead("volume").over(w))
        .withColumn("dclose", F.col("close") - F.lag("close").over(w))
    )


def skew3(x: str) -> Column:
    """Third central moment over the cube of the sample deviation."""
    n = F.count(x)
    return F.skewness(x) * F.pow((n - 1) / n, F.lit(1.5))


def kurt4(x: str) -> Column:
    """Fourth central moment over the fourth power of the sample deviation (no excess)."""
    n = F.count(x)
    return (F.kurtosis(x) + 3) * F.pow((n - 1) / n, F.lit(2.0))


def moments(p: DataFrame) -> DataFrame:
    p = p.withColumn("r100", 100 * F.col("ret"))
    return p.groupBy(*KEY).agg(
        F.stddev_samp("r100").alias("r_vol"), skew3("ret").alias("r_skew"), kurt4("ret").alias("r_kurt"),
        F.stddev_samp("share").alias("v_vol"), skew3("share").alias("v_skew"), kurt4("share").alias("v_kurt"),
        (100 * F.sum(F.col("share") * F.col("share"))).alias("v_hhi"), F.avg((F.col("open") + F.col("close") + F.col("high") + F.col("low")) / 4).alias("twap"),
    )


def jump(p: DataFrame) -> DataFrame:
    """r_jump: sum of 100 ln(1 + ret) further than 1.96 * 1.483 MAD from the median; r_mad, v_mad; mean and deviation of 2(r - ln(1+r)) - ln(1+r)^2."""
    w = _day(*KEY)
    p = p.withColumn("x", 100 * F.log1p("ret")).withColumn("med", F.median("x").over(w)).withColumn("dev", F.abs(F.col("x") - F.col("med"))).withColumn("mad", F.median("dev").over(w))
    p = p.withColumn("vmed", F.median("volume").over(w)).withColumn("rmed", F.median("ret").over(w))
    j = 2 * (F.col("ret") - F.log1p("ret")) - F.log1p("ret") * F.log1p("ret")
    return p.groupBy(*KEY).agg(
        F.coalesce(F.sum(F.when(F.col("dev") > 1.96 * 1.483 * F.col("mad"), F.col("x"))), F.lit(0.0)).alias("r_jump"),
        F.median(F.abs(F.col("ret") - F.col("rmed"))).alias("r_mad"), F.median(F.abs(F.col("volume") - F.col("vmed"))).alias("v_mad"),
        F.avg(j).alias("jumps"), F.stddev_pop(j).alias("jumps_stability"),
    )


def shares(p: DataFrame, edge: int = 30) -> DataFrame:
    late = F.col("bar") > F.col("t_max") - edge
    return p.groupBy(*KEY).agg(
        F.sum(F.when(late, F.col("ret"))).alias("r_close"), F.sum(F.when(F.col("bar") < edge, F.col("share"))).alias("v_pct_open"), F.sum(F.when(late, F.col("share"))).alias("v_pct_close"),
    )


def signed(p: DataFrame) -> DataFrame:
    up, down = F.col("ret") > 0, F.col("ret") < 0
    r2 = 10_000 * F.col("ret") * F.col("ret")
    s = lambda c, v: F.coalesce(F.sum(F.when(c, v)), F.lit(0.0))
    ratio = F.when(F.col("amount") > 0, F.abs("ret") / F.col("amount"))
    return p.groupBy(*KEY).agg(
        F.stddev_samp(F.when(up, F.col("ret"))).alias("r_vol_up"), F.stddev_samp(F.when(down, F.col("ret"))).alias("r_vol_down"),
        ((s(down, r2) - s(up, r2)) / (F.sum(r2) + 1e-8)).alias("r_rsj"), (s(down, F.col("share")) - s(up, F.col("share"))).alias("v_rsj"),
        (F.sum(ratio) / F.count("*")).alias("amihud"),
        (F.avg(F.abs("ret")) * F.avg(F.when(F.col("amount") > 0, 1 / F.col("amount"))) - F.covar_samp(F.abs("ret"), "amount") / F.pow(F.avg("amount"), F.lit(2.0))).alias("amihud_adj"),
        F.try_divide(F.sum(F.when(up, (F.col("bar") + 1) * F.col("ret"))), F.sum(F.when(up, F.col("ret")))).alias("center_up"),
        F.try_divide(F.sum(F.when(down, (F.col("bar") + 1) * F.col("ret"))), F.sum(F.when(down, F.col("ret")))).alias("center_down"),
    )


def path(p: DataFrame) -> DataFrame:
    w = _day(*KEY).orderBy("bar").rowsBetween(Window.unboundedPreceding, 0)
    p = p.withColumn("fall", F.col("low") / F.max("high").over(w) - 1)
    return p.groupBy(*KEY).agg(
        ((F.max_by("close", "bar") - F.min_by("close", "bar")) / (F.sum(F.abs("dclose")) + 1e-8)).alias("trend_ratio"), F.min("fall").alias("maxdrawdown"),
        (F.min_by(F.try_divide("open", "preclose"), "bar") - 1).alias("r_overnight"), (F.max_by("bar", "close") - F.min_by("bar", "close")).alias("max_min_distance"),
    )


def correlations(p: DataFrame, suffix: str = "") -> DataFrame:
    pairs = {"vp_corr": ("close", "volume"), "vr_corr": ("ret", "volume"), "vr_corr_lag": ("ret", "next_volume"), "vr_corr_lead": ("next_ret", "volume")}
    return p.groupBy(*KEY).agg(*(correlation(a, b).alias(n + suffix) for n, (a, b) in pairs.items()))


def closing(p: DataFrame, edge: int = 30) -> DataFrame:
    return p.filter(F.col("bar") > F.col("t_max") - edge)


def heavy(p: DataFrame, bars: int = 80) -> DataFrame:
    """The bars with the largest volume of each day."""
    return p.filter(F.col("by_volume") <= bars)


def squares(moments: DataFrame, names: tuple[str, ...] = ("r_vol", "r_skew", "r_kurt")) -> DataFrame:
    """The squares of some moments, named *_squared."""
    return moments.select(*KEY, *((F.col(n) * F.col(n)).alias(n + "_squared") for n in names))


def with_zeros(p: DataFrame, *columns: str) -> DataFrame:
    """NULL and NaN become 0."""
    return p.withColumns({c: F.when(F.col(c).isNull() | F.isnan(c), F.lit(0.0)).otherwise(F.col(c)) for c in columns})


def variation(x: str) -> Column:
    """Population deviation over the mean."""
    return F.try_divide(F.stddev_pop(x), F.avg(x))


def sample_scaled_correlation(x: str, y: str) -> Column:
    """Sample covariance over the population deviations, of the pairs that are whole."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    a, b = F.when(both, F.col(x)), F.when(both, F.col(y))
    return F.try_divide(F.covar_samp(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def entropy(p: DataFrame, x: str, out: str = "entropy") -> DataFrame:
    """-sum of s log2 s over the shares s of |x| in the day."""
    share = F.abs(x) / F.sum(F.abs(x)).over(_day(*KEY))
    return p.withColumn("__s", share).groupBy(*KEY).agg((-F.sum(F.when(F.col("__s") > 0, F.col("__s") * F.log2("__s")))).alias(out))


def percentile_ratio(p: DataFrame, x: str, part: float, ascending: bool = True, out: str = "ratio") -> DataFrame:
    """Share of the day's sum in the int(n * part) smallest values; descending: in those after the int(n * (1 - part)) smallest."""
    w = _day(*KEY)
    p = p.withColumn("__k", F.row_number().over(w.orderBy(x, "bar"))).withColumn("__n", F.count(x).over(w))
    chosen = F.col("__k") <= F.floor(F.col("__n") * part) if ascending else F.col("__k") > F.floor(F.col("__n") * (1 - part))
    return p.withColumn("__c", chosen).groupBy(*KEY).agg(F.try_divide(F.coalesce(F.sum(F.when(F.col("__c"), F.col(x))), F.lit(0.0)), F.sum(x)).alias(out))


def with_daily(p: DataFrame, daily: DataFrame, *values: str) -> DataFrame:
    """Bars with values of their entity's day."""
    return p.join(daily.select(*KEY, *values), list(KEY), "left")


def plain_moments(p: DataFrame, suffix: str) -> DataFrame:
    return p.groupBy(*KEY).agg(F.stddev_pop("ret").alias("r_vol" + suffix), F.skewness("ret").alias("r_skew" + suffix), F.kurtosis("ret").alias("r_kurt" + suffix))


def block_volatility(p: DataFrame, size: int = 5) -> DataFrame:
    blocks = p.groupBy(*KEY, F.floor(F.col("bar") / size).alias("block")).agg(F.stddev_pop("ret").alias("r"), F.stddev_pop("share").alias("v"))
    return blocks.groupBy(*KEY).agg(F.stddev_pop("r").alias("vol_of_rvol"), F.stddev_pop("v").alias("vol_of_vvol"))


def long_short_game(p: DataFrame, by: Column | None = None) -> DataFrame:
    """Sum of (T + 1 - 2 rank) * share with ranks by return, then its distance from the day's mean in deviations."""
    w = _day(*KEY)
    p = p.withColumn("__x", by if by is not None else F.col("ret"))
    p = p.withColumn("rank", F.row_number().over(w.orderBy(F.col("__x").asc_nulls_last(), "bar"))).withColumn("t", F.count("*").over(w))
    game = p.groupBy(*KEY).agg(F.sum((F.col("t") + 1 - 2 * F.col("rank")) * F.col("share")).alias("game"))
    d = Window.partitionBy("td")
    return game.withColumn("long_short_game", F.try_divide(F.abs(F.col("game") - F.avg("game").over(d)), F.stddev_pop("game").over(d)))


def active_trades(p: DataFrame, part: int = 5) -> DataFrame:
    """Volume per trade in the heaviest part of the bars, over that of all bars."""
    n = F.count("*").over(_day(*KEY))
    top = F.col("by_volume") <= F.floor(n / part)
    p = p.withColumn("__top", top)
    s = lambda c: F.sum(F.when(F.col("__top"), F.col(c)))
    return p.groupBy(*KEY).agg(F.try_divide(F.try_divide(s("volume"), s("trades")), F.try_divide(F.sum("volume"), F.sum("trades"))).alias("trade_high_act"))


def volume_peaks(p: DataFrame) -> DataFrame:
    """Runs of bars whose volume is over mean + deviation, by a billionth at least: of two bars the larger is equal to that sum."""
    w = _day(*KEY)
    p = p.withColumn("hi", F.col("volume") > (F.avg("volume").over(w) + F.stddev_pop("volume").over(w)) * (1 + 1e-9))
    start = F.col("hi") & ~F.coalesce(F.lag("hi").over(w.orderBy("bar")), F.lit(False))
    return p.withColumn("start", start).groupBy(*KEY).agg(F.count_if("start").alias("v_peak_num"))


def cloud(p: DataFrame) -> DataFrame:
    """Ambiguity: deviation over five bars of the deviation over five bars of returns; its link with amounts."""
    five = _day(*KEY).orderBy("bar").rowsBetween(-4, 0)
    p = p.withColumn("s5", F.when(F.count("ret").over(five) == 5, F.stddev_pop("ret").over(five))).withColumn("amb", F.when(F.count("s5").over(five) == 5, F.stddev_pop("s5").over(five)))
    foggy = F.col("amb") > F.avg("amb").over(_day(*KEY))
    p = p.withColumn("foggy", foggy)
    s = lambda c: F.try_divide(F.avg(F.when(F.col("foggy"), F.col(c))), F.avg(c))
    return p.groupBy(*KEY).agg(correlation("amb", "amount").alias("cloud_corr"), s("amount").alias("cloud_amount"), s("volume").alias("cloud_volume"))


def tide(p: DataFrame) -> DataFrame:
    """Nine-bar centred volume: slopes of close (percent a bar) from the trough before to the peak and to the trough after."""
    nine = _day(*KEY).orderBy("bar").rowsBetween(-4, 4)
    p = p.withColumn("s9", F.when((F.col("bar") >= 4) & (F.col("bar") <= F.col("t_max") - 4) & (F.count("volume").over(nine) == 9), F.sum("volume").over(nine)))
    p = p.filter("s9 is not null").withColumn("peak", F.max_by("bar", F.struct("s9", -F.col("bar"))).over(_day(*KEY)))
    pick = lambda side: F.min_by(F.struct("bar", "close"), F.when(side, F.struct("s9", "bar")))
    out = p.groupBy(*KEY).agg(pick(F.col("bar") < F.col("peak")).alias("a"), pick(F.col("bar") > F.col("peak")).alias("b"), F.max_by(F.struct("bar", "close"), F.col("bar") == F.col("peak")).alias("m"))
    slope = lambda x, y: F.try_divide(100 * (F.col(f"{y}.close") / F.col(f"{x}.close") - 1), F.col(f"{y}.bar") - F.col(f"{x}.bar"))
    return out.select(*KEY, slope("a", "b").alias("tide_full"), slope("a", "m").alias("tide_rising"), slope("m", "b").alias("tide_falling"))


def complete(bars: DataFrame) -> DataFrame:
    """Drops entities whose number of bars on a date is under the date's largest."""
    n = F.count("*").over(_day(*KEY))
    b = bars.withColumn("__n", n)
    return b.withColumn("__m", F.max("__n").over(_day("td"))).filter("__n = __m").drop("__n", "__m")


def crowd_out(p: DataFrame) -> DataFrame:
    """Minutes whose cross-section deviation of returns is not over the day's mean: each entity's mean amount correlation with the others."""
    m = p.groupBy("td", "bar").agg(F.stddev_pop("ret").alias("sd")).withColumn("mean", F.avg("sd").over(_day("td"))).filter("sd <= mean").select("td", "bar")
    calm = p.join(m, ["td", "bar"]).select("td", "bar", "tk", "amount")
    other = calm.select("td", "bar", F.col("tk").alias("tk2"), F.col("amount").alias("amount2"))
    pairs = calm.join(other, ["td", "bar"]).filter("tk <> tk2").groupBy("td", "tk", "tk2").agg(correlation("amount", "amount2").alias("c"))
    return pairs.groupBy(*KEY).agg(F.avg("c").alias("crowd_corr"))


def climb(p: DataFrame) -> DataFrame:
    """bvol: squared variation of the 20 prices of five bars; covariance of ret / bvol with bvol, over all bars and over the extreme ones."""
    five = _day(*KEY).orderBy("bar").rowsBetween(-4, 0)
    prices = ["open", "high", "low", "close"]
    s1 = sum(F.sum(c).over(five) for c in prices)
    s2 = sum(F.sum(F.col(c) * F.col(c)).over(five) for c in prices)
    mean = s1 / 20
    bvol = F.when(F.count("close").over(five) == 5, F.greatest(s2 / 20 - mean * mean, F.lit(0.0)) / (mean * mean))
    p = p.withColumn("bvol", bvol).withColumn("ratio", F.try_divide(F.col("ret"), F.col("bvol")))
    w = _day(*KEY)
    p = p.withColumn("extreme", F.col("bvol") >= F.avg("bvol").over(w) + F.stddev_pop("bvol").over(w))
    return p.groupBy(*KEY).agg(F.covar_pop("ratio", "bvol").alias("cov_ret_bvol"), F.covar_pop(F.when(F.col("extreme"), F.col("ratio")), F.when(F.col("extreme"), F.col("bvol"))).alias("cov_ret_bvol_extreme"))


def lag_regression(p: DataFrame, lags: int = 5) -> DataFrame:
    """Regression of ret on the volume changes of this bar and the ``lags`` before, with intercept, per day and entity: deviation of the slopes' t
    values, t value of the intercept, F value. NULL where there are no more rows than coefficients, or where the regressors depend on each other.

    Cross products are sums by day and entity. Sweeping them, one regressor after the other, turns them into the coefficients, the (negative) inverse
    of the products and the sum of squared residuals; column expressions only.
    """
    w = _day(*KEY).orderBy("bar")
    p = p.withColumn("dv", F.col("volume") - F.lag("volume").over(w))
    p = p.select(*KEY, "ret", *(F.lag("dv", i).over(w).alias(f"x{i}") for i in range(lags + 1))).dropna()
    terms = [F.lit(1.0), *(F.col(f"x{i}") for i in range(lags + 1)), F.col("ret")]
    k = lags + 2
    name = lambda i, j: f"s{min(i, j)}_{max(i, j)}"
    pairs = [(i, j) for i in range(k + 1) for j in range(i, k + 1)]
    out = p.groupBy(*KEY).agg(*(F.sum(terms[i] * terms[j]).alias(name(i, j)) for i, j in pairs))
    out = out.withColumns({"n": F.col("s0_0"), "around": F.col(name(k, k)) - F.col(name(0, k)) * F.col(name(0, k)) / F.col("s0_0"), **{f"o{i}": F.col(name(i, i)) for i in range(k)}})
    for q in range(k):
        out = out.withColumn("d", F.when(F.col(name(q, q)) > 1e-10 * F.col(f"o{q}"), F.col(name(q, q))))
        rest = {name(i, j): F.col(name(i, j)) - F.col(name(i, q)) * F.col(name(j, q)) / F.col("d") for i, j in pairs if q not in (i, j)}
        own = {name(i, q): F.col(name(i, q)) / F.col("d") for i in range(k + 1) if i != q}
        out = out.withColumns(rest | own | {name(q, q): -1 / F.col("d")})
    mse = F.greatest(F.col(name(k, k)), F.lit(0.0)) / F.when(F.col("n") > k, F.col("n") - k)
    t = [F.col(name(i, k)) / F.sqrt(F.greatest(mse * -F.col(name(i, i)), F.lit(1e-300))) for i in range(k)]
    mean = sum(t[1:]) / (lags + 1)
    spread = F.sqrt(sum((x - mean) * (x - mean) for x in t[1:]) / (lags + 1))
    value = F.try_divide((F.col("around") - F.col(name(k, k))) / (k - 1), F.when(mse > 0, mse))
    return out.select(*KEY, spread.alias("t_std"), t[0].alias("intercept_t"), value.alias("f_value"))
