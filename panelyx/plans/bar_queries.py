"""Queries over intraday bars (hourly bars of events, ten user groups a day)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import intraday as bars
from .registry import query, sql_tidy, tidy
from .roles import INTRADAY, intraday

KEYS = ["td", "tk"]


def prepared(spark, sf_dir):
    return bars.prepared(intraday(spark, sf_dir))


def _q(select: str, values: list[str], places: int = 6, ctes: str = "", source: str = "p", where: str = "") -> str:
    return f"WITH {INTRADAY}{ctes}, o AS (SELECT td, tk, {select} FROM {source} {where} GROUP BY td, tk) " + sql_tidy("td, tk", values, "o", places)


def _skew(x: str) -> str:
    return f"(avg({x} ** 3) - 3 * avg({x}) * avg({x} ** 2) + 2 * avg({x}) ** 3) / nullif(stddev_samp({x}) ** 3, 0)"


def _kurt(x: str) -> str:
    return f"(avg({x} ** 4) - 4 * avg({x}) * avg({x} ** 3) + 6 * avg({x}) ** 2 * avg({x} ** 2) - 3 * avg({x}) ** 4) / nullif(stddev_samp({x}) ** 4, 0)"


MOMENTS = ["r_vol", "r_skew", "r_kurt", "v_vol", "v_skew", "v_kurt", "v_hhi", "twap"]


@query("minute_moments", _q(f"stddev_samp(100 * ret) AS r_vol, {_skew('ret')} AS r_skew, {_kurt('ret')} AS r_kurt, stddev_samp(share) AS v_vol, {_skew('share')} AS v_skew, {_kurt('share')} AS v_kurt, 100 * sum(share * share) AS v_hhi, avg((open + close + high + low) / 4) AS twap", MOMENTS, 4, where="WHERE t >= 8"))
def minute_moments(spark, sf_dir):
    p = prepared(spark, sf_dir)
    return tidy(bars.moments(p.join(p.groupBy(*KEYS).count().filter("count >= 8"), KEYS)), KEYS, MOMENTS, 4)


JUMP = ", x0 AS (SELECT *, 100 * ln(1 + ret) AS x, 2 * (ret - ln(1 + ret)) - ln(1 + ret) * ln(1 + ret) AS j FROM p), x1 AS (SELECT *, median(x) OVER d AS med, median(ret) OVER d AS rmed, median(volume) OVER d AS vmed FROM x0 WINDOW d AS (PARTITION BY td, tk)), x2 AS (SELECT *, abs(x - med) AS dev, median(abs(x - med)) OVER (PARTITION BY td, tk) AS mad FROM x1)"
JUMPS = ["r_jump", "r_mad", "v_mad", "jumps", "jumps_stability"]


@query("minute_jump", _q("coalesce(sum(CASE WHEN dev > 1.96::DOUBLE * 1.483::DOUBLE * mad THEN x END), 0) AS r_jump, median(abs(ret - rmed)) AS r_mad, median(abs(volume - vmed)) AS v_mad, avg(j) AS jumps, stddev_pop(j) AS jumps_stability", JUMPS, 5, JUMP, "x2"))
def minute_jump(spark, sf_dir):
    return tidy(bars.jump(prepared(spark, sf_dir)), KEYS, JUMPS, 5)


@query("minute_shares", _q("sum(CASE WHEN bar > t_max - 6 THEN ret END) AS r_close, sum(CASE WHEN bar < 6 THEN share END) AS v_pct_open, sum(CASE WHEN bar > t_max - 6 THEN share END) AS v_pct_close", ["r_close", "v_pct_open", "v_pct_close"]))
def minute_shares(spark, sf_dir):
    return tidy(bars.shares(prepared(spark, sf_dir), 6), KEYS, ["r_close", "v_pct_open", "v_pct_close"])


SIGNED = ["r_vol_up", "r_vol_down", "r_rsj", "v_rsj", "amihud", "amihud_adj", "center_up", "center_down"]


@query("minute_signed", _q("""stddev_samp(ret) FILTER (ret > 0) AS r_vol_up, stddev_samp(ret) FILTER (ret < 0) AS r_vol_down,
 (coalesce(sum(10000 * ret * ret) FILTER (ret < 0), 0) - coalesce(sum(10000 * ret * ret) FILTER (ret > 0), 0)) / (sum(10000 * ret * ret) + 1e-8) AS r_rsj, coalesce(sum(share) FILTER (ret < 0), 0) - coalesce(sum(share) FILTER (ret > 0), 0) AS v_rsj,
 sum(abs(ret) / amount) / count(*) AS amihud, avg(abs(ret)) * avg(1 / amount) - covar_samp(abs(ret), amount) / avg(amount) ** 2 AS amihud_adj,
 sum((bar + 1) * ret) FILTER (ret > 0) / nullif(sum(ret) FILTER (ret > 0), 0) AS center_up, sum((bar + 1) * ret) FILTER (ret < 0) / nullif(sum(ret) FILTER (ret < 0), 0) AS center_down""", SIGNED, 5))
def minute_signed(spark, sf_dir):
    return tidy(bars.signed(prepared(spark, sf_dir)), KEYS, SIGNED, 5)


PATH = ["trend_ratio", "maxdrawdown", "r_overnight"]


@query("minute_path", _q("(last(close ORDER BY bar) - first(close ORDER BY bar)) / (coalesce(sum(abs(dclose)), 0) + 1e-8) AS trend_ratio, min(fall) AS maxdrawdown, first(open / preclose ORDER BY bar) - 1 AS r_overnight", PATH, 5, ", y AS (SELECT *, low / max(high) OVER (PARTITION BY td, tk ORDER BY bar) - 1 AS fall FROM p)", "y", "WHERE t > 1"))
def minute_path(spark, sf_dir):
    p = prepared(spark, sf_dir)
    return tidy(bars.path(p.join(p.groupBy(*KEYS).count().filter("count > 1"), KEYS)), KEYS, PATH, 5)


CORR = "corr(close, volume) AS vp_corr, corr(ret, volume) AS vr_corr, corr(ret, next_volume) AS vr_corr_lag, corr(next_ret, volume) AS vr_corr_lead"
CORRS = ["vp_corr", "vr_corr", "vr_corr_lag", "vr_corr_lead"]


@query("minute_corr", _q(CORR, CORRS, 5, where="WHERE t >= 8"))
def minute_corr(spark, sf_dir):
    p = prepared(spark, sf_dir)
    return tidy(bars.correlations(p.join(p.groupBy(*KEYS).count().filter("count >= 8"), KEYS)), KEYS, CORRS, 5)


@query("minute_topvol", f"WITH {INTRADAY}, o AS (SELECT td, tk, stddev_pop(ret) AS r_vol_large_v, (avg(ret ** 3) - 3 * avg(ret) * avg(ret ** 2) + 2 * avg(ret) ** 3) / nullif(stddev_pop(ret) ** 3, 0) AS r_skew_large_v FROM p WHERE by_volume <= 8 AND t >= 8 GROUP BY td, tk) " + sql_tidy("td, tk", ["r_vol_large_v", "r_skew_large_v"], "o", 5))
def minute_topvol(spark, sf_dir):
    p = prepared(spark, sf_dir)
    p = p.join(p.groupBy(*KEYS).count().filter("count >= 8"), KEYS)
    return tidy(bars.plain_moments(bars.heavy(p, 8), "_large_v"), KEYS, ["r_vol_large_v", "r_skew_large_v"], 5)


@query("minute_blocks", f"WITH {INTRADAY}, k AS (SELECT td, tk, bar // 4 AS block, stddev_pop(ret) AS r, stddev_pop(share) AS v FROM p GROUP BY ALL), o AS (SELECT td, tk, stddev_pop(r) AS vol_of_rvol, stddev_pop(v) AS vol_of_vvol FROM k GROUP BY td, tk) " + sql_tidy("td, tk", ["vol_of_rvol", "vol_of_vvol"], "o"))
def minute_blocks(spark, sf_dir):
    return tidy(bars.block_volatility(prepared(spark, sf_dir), 4), KEYS, ["vol_of_rvol", "vol_of_vvol"])


@query("long_short_game", f"WITH {INTRADAY}, k AS (SELECT td, tk, sum((t + 1 - 2 * rk) * share) AS game FROM (SELECT *, row_number() OVER (PARTITION BY td, tk ORDER BY ret, bar) AS rk FROM p) GROUP BY td, tk), o AS (SELECT td, tk, game, abs(game - avg(game) OVER d) / nullif(stddev_pop(game) OVER d, 0) AS long_short_game FROM k WINDOW d AS (PARTITION BY td)) " + sql_tidy("td, tk", ["game", "long_short_game"], "o"))
def long_short_game(spark, sf_dir):
    return tidy(bars.long_short_game(prepared(spark, sf_dir)), KEYS, ["game", "long_short_game"])


@query("trade_active", _q("(sum(volume) FILTER (by_volume <= t // 5) / sum(trades) FILTER (by_volume <= t // 5)) / (sum(volume) / sum(trades)) AS trade_high_act", ["trade_high_act"]))
def trade_active(spark, sf_dir):
    return tidy(bars.active_trades(prepared(spark, sf_dir)), KEYS, ["trade_high_act"])


@query("volume_peaks", f"WITH {INTRADAY}, k AS (SELECT *, volume > (avg(volume) OVER d + stddev_pop(volume) OVER d) * (1 + 1e-9::DOUBLE) AS hi FROM p WINDOW d AS (PARTITION BY td, tk)), s AS (SELECT *, hi AND NOT coalesce(lag(hi) OVER (PARTITION BY td, tk ORDER BY bar), FALSE) AS st FROM k) SELECT td, tk, count(*) FILTER (st) AS v_peak_num FROM s GROUP BY td, tk")
def volume_peaks(spark, sf_dir):
    return bars.volume_peaks(prepared(spark, sf_dir))


@query("complete_bars", f"WITH {INTRADAY} SELECT td, tk, bar FROM (SELECT *, max(t) OVER (PARTITION BY td) AS m FROM p) WHERE t = m")
def complete_bars(spark, sf_dir):
    return bars.complete(intraday(spark, sf_dir)).select("td", "tk", "bar")


@query("cloud", f"WITH {INTRADAY}, k AS (SELECT *, CASE WHEN count(ret) OVER w = 5 THEN stddev_pop(ret) OVER w END AS s5 FROM p WINDOW w AS (PARTITION BY td, tk ORDER BY bar ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)), a AS (SELECT *, CASE WHEN count(s5) OVER w = 5 THEN stddev_pop(s5) OVER w END AS amb FROM k WINDOW w AS (PARTITION BY td, tk ORDER BY bar ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)), f AS (SELECT *, amb > avg(amb) OVER (PARTITION BY td, tk) AS foggy FROM a), o AS (SELECT td, tk, corr(amb, amount) AS cloud_corr, avg(amount) FILTER (foggy) / avg(amount) AS cloud_amount, avg(volume) FILTER (foggy) / avg(volume) AS cloud_volume FROM f WHERE t >= 12 GROUP BY td, tk) " + sql_tidy("td, tk", ["cloud_corr", "cloud_amount", "cloud_volume"], "o", 5))
def cloud(spark, sf_dir):
    p = prepared(spark, sf_dir)
    return tidy(bars.cloud(p.join(p.groupBy(*KEYS).count().filter("count >= 12"), KEYS)), KEYS, ["cloud_corr", "cloud_amount", "cloud_volume"], 5)


HEAVY = ["r_vol_large_v", "r_skew_large_v", "r_kurt_large_v", "vp_corr_large_v", "vr_corr_large_v", "vr_corr_lag_large_v", "vr_corr_lead_large_v"]
SKEW_POP = "(avg(ret ** 3) - 3 * avg(ret) * avg(ret ** 2) + 2 * avg(ret) ** 3) / nullif(stddev_pop(ret) ** 3, 0)"
KURT_POP = "(avg(ret ** 4) - 4 * avg(ret) * avg(ret ** 3) + 6 * avg(ret) ** 2 * avg(ret ** 2) - 3 * avg(ret) ** 4) / nullif(stddev_pop(ret) ** 4, 0) - 3"


def _part(suffix: str) -> str:
    corr = f"corr(close, volume) AS vp_corr{suffix}, corr(ret, volume) AS vr_corr{suffix}, corr(ret, next_volume) AS vr_corr_lag{suffix}, corr(next_ret, volume) AS vr_corr_lead{suffix}"
    return f"stddev_pop(ret) AS r_vol{suffix}, {SKEW_POP} AS r_skew{suffix}, {KURT_POP} AS r_kurt{suffix}, {corr}"


@query("minute_heavy", _q(_part("_large_v"), HEAVY, 4, where="WHERE by_volume <= 12 AND t >= 12"))
def minute_heavy(spark, sf_dir):
    """The twelve bars of largest volume: moments and correlations."""
    p = bars.heavy(prepared(spark, sf_dir).withColumn("t", F.count("*").over(bars._day(*KEYS))).filter("t >= 12"), 12)
    return tidy(bars.plain_moments(p, "_large_v").join(bars.correlations(p, "_large_v"), KEYS), KEYS, HEAVY, 4)


CLOSING = [n.replace("_large_v", "_close") for n in HEAVY]


@query("minute_closing", _q(_part("_close"), CLOSING, 4, where="WHERE bar > t_max - 12 AND t >= 18"))
def minute_closing(spark, sf_dir):
    """The last twelve hours of a day: moments and correlations."""
    p = bars.closing(prepared(spark, sf_dir).withColumn("t", F.count("*").over(bars._day(*KEYS))).filter("t >= 18"), 12)
    return tidy(bars.plain_moments(p, "_close").join(bars.correlations(p, "_close"), KEYS), KEYS, CLOSING, 4)


@query("minute_squares", f"WITH {INTRADAY}, m AS (SELECT td, tk, stddev_samp(100 * ret) AS r_vol, {_skew('ret')} AS r_skew, {_kurt('ret')} AS r_kurt FROM p GROUP BY td, tk HAVING count(*) >= 8), o AS (SELECT td, tk, r_vol ** 2 AS r_vol_squared, r_skew ** 2 AS r_skew_squared, r_kurt ** 2 AS r_kurt_squared FROM m) " + sql_tidy("td, tk", ["r_vol_squared", "r_skew_squared", "r_kurt_squared"], "o", 3))
def minute_squares(spark, sf_dir):
    p = prepared(spark, sf_dir).withColumn("t", F.count("*").over(bars._day(*KEYS))).filter("t >= 8")
    return tidy(bars.squares(bars.moments(p)), KEYS, ["r_vol_squared", "r_skew_squared", "r_kurt_squared"], 3)


@query("minute_vol_ratio", _q("stddev_pop(ret) FILTER (by_volume <= 8) / nullif(stddev_samp(100 * ret), 0) AS r_vol_ratio_large_v", ["r_vol_ratio_large_v"], 6, where="WHERE t >= 8"))
def minute_vol_ratio(spark, sf_dir):
    """Deviation of the heaviest bars over that of all."""
    p = prepared(spark, sf_dir).withColumn("t", F.count("*").over(bars._day(*KEYS))).filter("t >= 8")
    both = bars.plain_moments(bars.heavy(p, 8), "_large_v").join(bars.moments(p).select(*KEYS, "r_vol"), KEYS)
    return tidy(both.withColumn("r_vol_ratio_large_v", F.try_divide("r_vol_large_v", "r_vol")), KEYS, ["r_vol_ratio_large_v"])


@query("minute_helpers", _q("stddev_pop(volume) / avg(volume) AS cv, covar_samp(ret, volume) / nullif(stddev_pop(ret) * stddev_pop(volume), 0) AS scaled_corr, -sum(share * log2(share)) AS entropy", ["cv", "scaled_corr", "entropy"], 5, where="WHERE t >= 4"))
def minute_helpers(spark, sf_dir):
    p = bars.with_zeros(prepared(spark, sf_dir), "ret").withColumn("t", F.count("*").over(bars._day(*KEYS))).filter("t >= 4")
    o = p.groupBy(*KEYS).agg(bars.variation("volume").alias("cv"), bars.sample_scaled_correlation("ret", "volume").alias("scaled_corr"))
    return tidy(o.join(bars.entropy(p, "volume"), KEYS), KEYS, ["cv", "scaled_corr", "entropy"], 5)


@query("minute_percentile_ratio", f"WITH {INTRADAY}, k AS (SELECT *, row_number() OVER (PARTITION BY td, tk ORDER BY volume, bar) AS k FROM p), o AS (SELECT td, tk, coalesce(sum(volume) FILTER (k <= floor(t * 0.25::DOUBLE)), 0) / sum(volume) AS low_ratio, coalesce(sum(volume) FILTER (k > floor(t * 0.75::DOUBLE)), 0) / sum(volume) AS high_ratio FROM k GROUP BY td, tk) " + sql_tidy("td, tk", ["low_ratio", "high_ratio"], "o"))
def minute_percentile_ratio(spark, sf_dir):
    p = prepared(spark, sf_dir)
    o = bars.percentile_ratio(p, "volume", 0.25, True, "low_ratio").join(bars.percentile_ratio(p, "volume", 0.25, False, "high_ratio"), KEYS)
    return tidy(o, KEYS, ["low_ratio", "high_ratio"])


@query("long_short_game_spread", f"WITH {INTRADAY}, k AS (SELECT td, tk, sum((t + 1 - 2 * rk) * share) AS game FROM (SELECT *, row_number() OVER (PARTITION BY td, tk ORDER BY (high - low) / close, bar) AS rk FROM p) GROUP BY td, tk), o AS (SELECT td, tk, game, abs(game - avg(game) OVER d) / nullif(stddev_pop(game) OVER d, 0) AS long_short_game FROM k WINDOW d AS (PARTITION BY td)) " + sql_tidy("td, tk", ["game", "long_short_game"], "o"))
def long_short_game_spread(spark, sf_dir):
    """Bars ranked by their price range over the close."""
    return tidy(bars.long_short_game(prepared(spark, sf_dir), (F.col("high") - F.col("low")) / F.col("close")), KEYS, ["game", "long_short_game"])


@query("minute_with_daily", f"WITH {INTRADAY}, d AS (SELECT td, tk, max(close) AS top FROM b WHERE tk <> 3 GROUP BY td, tk) SELECT p.td, p.tk, p.bar, round(p.close / d.top, 6) AS part FROM p LEFT JOIN d ON p.td = d.td AND p.tk = d.tk")
def minute_with_daily(spark, sf_dir):
    """A value of the day on each of its bars."""
    b = intraday(spark, sf_dir)
    daily = b.filter("tk <> 3").groupBy(*KEYS).agg(F.max("close").alias("top"))
    return tidy(bars.with_daily(b, daily, "top").withColumn("part", F.col("close") / F.col("top")), [*KEYS, "bar"], ["part"])


S9 = f"WITH {INTRADAY}, n AS (SELECT *, CASE WHEN bar >= 4 AND bar <= t_max - 4 AND count(*) OVER w = 9 THEN sum(volume) OVER w END AS s9 FROM p WINDOW w AS (PARTITION BY td, tk ORDER BY bar ROWS BETWEEN 4 PRECEDING AND 4 FOLLOWING)), h AS (SELECT *, first(bar) OVER (PARTITION BY td, tk ORDER BY s9 DESC, bar) AS peak FROM n WHERE s9 IS NOT NULL)"


@query("tide", S9 + """, g AS (SELECT td, tk, first(bar ORDER BY s9, bar) FILTER (bar < peak) AS ab, first(close ORDER BY s9, bar) FILTER (bar < peak) AS ac, first(bar ORDER BY s9, bar) FILTER (bar > peak) AS bb, first(close ORDER BY s9, bar) FILTER (bar > peak) AS bc, any_value(peak) AS mb, any_value(close) FILTER (bar = peak) AS mc FROM h GROUP BY td, tk),
 o AS (SELECT td, tk, 100 * (bc / ac - 1) / (bb - ab) AS tide_full, 100 * (mc / ac - 1) / (mb - ab) AS tide_rising, 100 * (bc / mc - 1) / (bb - mb) AS tide_falling FROM g) """ + sql_tidy("td, tk", ["tide_full", "tide_rising", "tide_falling"], "o"))
def tide(spark, sf_dir):
    return tidy(bars.tide(prepared(spark, sf_dir)), KEYS, ["tide_full", "tide_rising", "tide_falling"])


@query("crowd_out", f"WITH {INTRADAY}, s AS (SELECT td, bar, stddev_pop(ret) AS sd FROM p GROUP BY td, bar), c AS (SELECT td, bar FROM (SELECT *, avg(sd) OVER (PARTITION BY td) AS m FROM s) WHERE sd <= m), q AS (SELECT td, bar, tk, amount FROM p JOIN c USING (td, bar)), k AS (SELECT x.td AS td, x.tk AS tk, y.tk AS tk2, corr(x.amount, y.amount) AS c FROM q x JOIN q y ON x.td = y.td AND x.bar = y.bar AND x.tk <> y.tk GROUP BY ALL), o AS (SELECT td, tk, avg(CASE WHEN isfinite(c) THEN c END) AS crowd_corr FROM k GROUP BY td, tk) " + sql_tidy("td, tk", ["crowd_corr"], "o", 5))
def crowd_out(spark, sf_dir):
    return tidy(bars.crowd_out(prepared(spark, sf_dir)), KEYS, ["crowd_corr"], 5)
