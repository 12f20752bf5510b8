"""Queries over versioned facts and estimates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins, pit
from .registry import query, sql_tidy, tidy
from .roles import DENSE_FACTS, ESTIMATES, FACTS, WEEKLY, dense_facts, estimates, facts, trading_days

KEYS = ["tk", "rid"]
#: The value of the quarter k back that row x of f sees.
SEEN = lambda k: f"(SELECT last(g.v ORDER BY g.ann, g.rid) FROM f g WHERE g.tk = x.tk AND g.q = x.q - ({k}) AND g.ann <= x.ann)"


def _point(expression: str) -> str:
    return f"WITH {FACTS}, o AS (SELECT tk, rid, {expression} AS v FROM f x) " + sql_tidy("tk, rid", ["v"], "o WHERE v IS NOT NULL", 4)


def _run(operator, places=4, **options):
    return lambda spark, sf_dir: tidy(operator(facts(spark, sf_dir), **options), KEYS, ["v"], places)


query("pit_shift", _point(SEEN(4)))(_run(pit.shift))
query("pit_mrq", _point(f"CASE WHEN q % 4 = 0 THEN v ELSE v - {SEEN(1)} END"))(_run(pit.single_quarter))
query("pit_half_year", _point(f"CASE WHEN q % 4 = 3 THEN v - {SEEN(2)} ELSE v END"))(_run(pit.half_year))
query("pit_ttm", _point(f"CASE WHEN q % 4 = 3 THEN v ELSE v + {SEEN('x.q % 4 + 1')} - {SEEN(4)} END"))(_run(pit.trailing_year))
query("pit_yoy", _point(f"(v - {SEEN(4)}) / nullif(abs({SEEN(4)}), 0)"))(_run(pit.change))
query("pit_yoy_diff", _point(f"v - nullif({SEEN(4)}, 0)"))(_run(pit.change, method="diff"))
query("pit_qoq", _point(f"(v - {SEEN(1)}) / nullif(abs({SEEN(1)}), 0)"))(_run(pit.change, n=1))

NEWEST = "SELECT tk, ann, arg_max(q, q::BIGINT * 1000000 + rid) AS q, arg_max(v, q::BIGINT * 1000000 + rid) AS v, arg_max(rid, q::BIGINT * 1000000 + rid) AS rid FROM {source} WHERE v IS NOT NULL GROUP BY tk, ann"


def seen_in(source: str, k) -> str:
    return SEEN(k).replace("FROM f g", f"FROM {source} g")


#: The chains of pit.CHAINS as SQL over the facts x of a source.
STEPS = {
    "ttm": lambda s: f"CASE WHEN q % 4 = 3 THEN v ELSE v + {seen_in(s, 'x.q % 4 + 1')} - {seen_in(s, 4)} END",
    "mrq": lambda s: f"CASE WHEN q % 4 = 0 THEN v ELSE v - {seen_in(s, 1)} END",
    "yoy": lambda s: f"(v - {seen_in(s, 4)}) / nullif(abs({seen_in(s, 4)}), 0)",
    "qoq": lambda s: f"(v - {seen_in(s, 1)}) / nullif(abs({seen_in(s, 1)}), 0)",
    "yoy_diff": lambda s: f"v - nullif({seen_in(s, 4)}, 0)",
}
CHAIN_STEPS = {"last": [], "ttm": ["ttm"], "mrq": ["mrq"], "mrq_yoy": ["mrq", "yoy"], "ttm_yoy": ["ttm", "yoy"], "ttm_qoq": ["ttm", "qoq"], "yoy": ["yoy"], "yoy_diff": ["yoy_diff"], "qoq": ["qoq"]}


def steps_sql(steps: str, source: str) -> tuple[str, str]:
    """CTEs of a chain, and the name of the last one."""
    ctes = []
    for k, step in enumerate(CHAIN_STEPS[steps]):
        # two CTEs for each step: the value, then the rows that have one
        ctes += [f"{source}_{k}v AS MATERIALIZED (SELECT tk, ann, q, rid, {STEPS[step](source)} AS v FROM {source} x)", f"{source}_{k} AS MATERIALIZED (SELECT * FROM {source}_{k}v WHERE v IS NOT NULL)"]
        source = f"{source}_{k}"
    return "".join(", " + c for c in ctes), source


def fill_sql(source: str) -> str:
    """l: newest facts by date, u: when each of them holds, panel: on the calendar."""
    return f"""l AS ({NEWEST.format(source=source)}), e AS (SELECT *, coalesce((SELECT max(td) FROM cal WHERE td < l.ann), (SELECT min(td) FROM cal)) AS eff FROM l),
 u AS (SELECT *, least(coalesce(lead(eff) OVER (PARTITION BY tk ORDER BY ann, q, rid) - 1, DATE '2999-01-01'), ann + 365) AS until FROM e),
 panel AS (SELECT cal.td AS td, tk, v FROM cal JOIN u ON td BETWEEN eff AND until WHERE q >= year(td) * 4 + quarter(td) - 1 - 4)"""


def chain_sql(steps: str, source: str = "f", more: str = "", value: str = "v", joined: str = "", places: int = 4) -> str:
    ctes, end = steps_sql(steps, source)
    return f"WITH {WEEKLY}, {FACTS}{more}{ctes}, {fill_sql(end)}, o AS (SELECT td, tk, {value} AS v FROM panel {joined}) " + sql_tidy("td, tk", ["v"], "o", places)


LAST = "SELECT tk, ann, arg_max(q, q::BIGINT * 1000000 + rid) AS q, round(arg_max(v, q::BIGINT * 1000000 + rid), 4) AS v FROM f GROUP BY tk, ann"


@query("pit_last", f"WITH {FACTS} {LAST}")
def pit_last(spark, sf_dir):
    return tidy(pit.last(facts(spark, sf_dir)), ["tk", "ann", "q"], ["v"], 4)


@query("pit_newest_two", f"""WITH {DENSE_FACTS}, d AS (SELECT tk, ann, count(*) AS n FROM f GROUP BY tk, ann), r AS (SELECT d.tk, d.ann, d.n, f.q, row_number() OVER (PARTITION BY d.tk, d.ann ORDER BY f.q DESC) AS k FROM d JOIN f ON f.tk = d.tk AND f.ann <= d.ann),
 o AS (SELECT r.tk, r.ann, r.q, (SELECT last(g.v ORDER BY g.ann, g.rid) FROM f g WHERE g.tk = r.tk AND g.q = r.q AND g.ann <= r.ann) AS v, CAST(3 - k AS INTEGER) AS place FROM r WHERE k = 1 OR k = 2 AND n > 1) """ + sql_tidy("tk, ann, q, place", ["v"], "o", 2))
def pit_newest_two(spark, sf_dir):
    """Facts of which a quarter of the dates announce two months at once."""
    return tidy(pit.newest_two(dense_facts(spark, sf_dir)), ["tk", "ann", "q", "place"], ["v"], 2)


HISTORY = f"{FACTS}, h AS (SELECT tk, rid, q, v, gq, gv FROM (SELECT x.tk, x.rid, x.q, x.v, g.q AS gq, g.v AS gv, row_number() OVER (PARTITION BY x.tk, x.rid, g.q ORDER BY g.ann DESC, g.rid DESC) AS k FROM f x JOIN f g ON x.tk = g.tk AND g.q BETWEEN x.q - 7 AND x.q AND g.ann <= x.ann) WHERE k = 1)"


def _window(expression: str, having: str, places: int = 7) -> str:
    return f"WITH {HISTORY}, o AS (SELECT tk, rid, {expression} AS v FROM h GROUP BY tk, rid HAVING {having}) " + sql_tidy("tk, rid", ["v"], "o WHERE v IS NOT NULL", places)


query("pit_sum", _window("sum(gv)", "true"))(_run(pit.window_stat, places=7, stat="sum", n=8))
query("pit_mean", _window("avg(gv)", "count(*) >= 2"))(_run(pit.window_stat, places=7, stat="mean", n=8))
query("pit_std", _window("stddev_pop(gv)", "count(*) > 2", 3))(_run(pit.window_stat, places=3, stat="std", n=8))
query("pit_mscore", _window("avg(gv) / nullif(stddev_pop(gv), 0)", "count(*) > 2"))(_run(pit.window_stat, places=7, stat="mscore", n=8))
query("pit_cagr", _window("pow(arg_max(gv, gq) / arg_min(gv, gq), 4.0::DOUBLE / (max(gq) - min(gq))) - 1", "count(*) >= 2"))(_run(pit.window_stat, places=7, stat="cagr", n=8))
query("pit_zscore", f"WITH {FACTS}, h AS (SELECT tk, rid, v, gv FROM (SELECT x.tk, x.rid, x.v, g.v AS gv, row_number() OVER (PARTITION BY x.tk, x.rid, g.q ORDER BY g.ann DESC, g.rid DESC) AS k FROM f x JOIN f g ON x.tk = g.tk AND g.q BETWEEN x.q - 2 AND x.q AND g.ann <= x.ann) WHERE k = 1), o AS (SELECT tk, rid, (any_value(v) - avg(gv)) / nullif(stddev_pop(gv), 0) AS v FROM h GROUP BY tk, rid HAVING count(*) = 3) " + sql_tidy("tk, rid", ["v"], "o WHERE v IS NOT NULL", 4))(_run(pit.window_stat, stat="zscore", n=3))

def _dense(operator, places=5, **options):
    return lambda spark, sf_dir: tidy(operator(dense_facts(spark, sf_dir), **options), KEYS, ["v"], places)


def _lists(n: int, source: str = "f") -> str:
    """hl: for each row its visible history of n quarters as list a (oldest first), with the quarters as list qs."""
    return f"hl AS (SELECT tk, rid, any_value(v) AS v, list(gv ORDER BY gq) AS a, list(gq ORDER BY gq) AS qs FROM (SELECT x.tk, x.rid, x.v, g.q AS gq, g.v AS gv, row_number() OVER (PARTITION BY x.tk, x.rid, g.q ORDER BY g.ann DESC, g.rid DESC) AS k FROM {source} x JOIN {source} g ON x.tk = g.tk AND g.q BETWEEN x.q - {n - 1} AND x.q AND g.ann <= x.ann) WHERE k = 1 GROUP BY tk, rid)"


def _listed(n: int, expression: str, where: str, ctes: str = "") -> str:
    return f"WITH {DENSE_FACTS}, {_lists(n)}{ctes}, o AS (SELECT tk, rid, {expression} AS v FROM hl WHERE {where}) " + sql_tidy("tk, rid", ["v"], "o WHERE v IS NOT NULL AND isfinite(v)", 5)


SD = "nullif(list_aggregate(a, 'stddev_pop'), 0)"
query("pit_trend", _listed(8, f"(a[5] - a[1] + a[6] - a[2] + a[7] - a[3] + a[8] - a[4]) / {SD} / 16", "len(a) = 8"))(_dense(pit.window_stat, stat="trend", n=8))
DIFFS = "list_transform(range(5, 13), lambda i: a[i] - a[i - 4])"
query("pit_surprise", _listed(13, f"(v - a[9] - list_aggregate({DIFFS}, 'avg')) / nullif(list_aggregate({DIFFS}, 'stddev_pop'), 0)", "len(a) = 13"))(_dense(pit.surprise, n=8))
query("pit_zscore_diff", _listed(8, f"(a[-1] - a[-5]) / {SD}", "len(a) > 4"))(_dense(pit.zscore_diff))
query("pit_acceleration", _listed(8, f"(a[-1] - a[-5] - a[-2] + a[-6]) / {SD} - CAST(a[-1] < a[-5] AS INTEGER) - CAST(a[-1] < 0 AS INTEGER)", "len(a) > 5"))(_dense(pit.acceleration))
RATIO = f"c AS (SELECT tk, ann, q, rid, (v - {SEEN(4)}) / nullif(abs({SEEN(4)}), 0) AS v FROM f x), cc AS (SELECT * FROM c WHERE v IS NOT NULL)"
query("pit_vol_adj", f"WITH {DENSE_FACTS}, {RATIO}, {_lists(8, 'cc')}, o AS (SELECT f.tk AS tk, f.rid AS rid, f.v / nullif(list_aggregate(a, 'stddev_pop'), 0) AS v FROM hl JOIN f ON hl.tk = f.tk AND hl.rid = f.rid WHERE len(a) > 2) " + sql_tidy("tk, rid", ["v"], "o WHERE v IS NOT NULL", 1))(_dense(pit.volatility_adjusted, 1, n=8))


@query("pit_divide", f"WITH {FACTS}, y AS (SELECT * FROM f WHERE rid % 2 = 0), o AS (SELECT tk, rid, v / nullif(abs((SELECT last(y.v ORDER BY y.q, y.ann, y.rid) FROM y WHERE y.tk = x.tk AND y.q <= x.q AND y.ann <= x.ann)), 0) AS v FROM f x WHERE rid % 2 = 1) " + sql_tidy("tk, rid", ["v"], "o WHERE v IS NOT NULL", 4))
def pit_divide(spark, sf_dir):
    return tidy(pit.combine_own(facts(spark, sf_dir), F.col("rid") % 2 == 1), KEYS, ["v"], 4)


@query("pit_multiply", f"WITH {FACTS}, y AS (SELECT * FROM f WHERE rid % 2 = 0), o AS (SELECT tk, rid, v * (SELECT last(y.v ORDER BY y.q, y.ann, y.rid) FROM y WHERE y.tk = x.tk AND y.q <= x.q AND y.ann <= x.ann) AS v FROM f x WHERE rid % 2 = 1) " + sql_tidy("tk, rid", ["v"], "o WHERE v IS NOT NULL", 0))
def pit_multiply(spark, sf_dir):
    return tidy(pit.combine_own(facts(spark, sf_dir), F.col("rid") % 2 == 1, "multiply"), KEYS, ["v"], 0)


@query("asof_fundamental", f"""WITH {WEEKLY}, {FACTS}, l AS ({LAST.replace('round(', '(').replace(', 4)', ')')}), e AS (SELECT *, coalesce((SELECT max(td) FROM cal WHERE td < l.ann), (SELECT min(td) FROM cal)) AS eff FROM l),
 u AS (SELECT *, least(coalesce(lead(eff) OVER (PARTITION BY tk ORDER BY ann, q) - 1, DATE '2999-01-01'), ann + 365) AS until FROM e)
SELECT cal.td, tk, round(v, 4) AS v FROM cal JOIN u ON td BETWEEN eff AND until WHERE q >= year(td) * 4 + quarter(td) - 1 - 4""")
def asof_fundamental(spark, sf_dir):
    days = trading_days(spark, sf_dir)
    return tidy(pit.fill_to_dates(facts(spark, sf_dir), days), ["td", "tk"], ["v"], 4)


@query("factor_chain_ttm_yoy", chain_sql("ttm_yoy"))
def factor_chain_ttm_yoy(spark, sf_dir):
    """A factor of the library: year-on-year change of the trailing year, on the calendar."""
    days = trading_days(spark, sf_dir)
    return tidy(pit.fill_to_dates(pit.chain(facts(spark, sf_dir), "ttm_yoy"), days), ["td", "tk"], ["v"], 4)


@query("analyst_coverage", f"WITH {WEEKLY}, {ESTIMATES} SELECT td, tk, count(DISTINCT inst) AS n FROM cal JOIN est ON td BETWEEN est_dt AND est_dt + 60 GROUP BY td, tk")
def analyst_coverage(spark, sf_dir):
    return pit.coverage(estimates(spark, sf_dir), trading_days(spark, sf_dir), window_days=60)


@query("analyst_consensus", f"""WITH {WEEKLY}, {ESTIMATES}, s AS (SELECT td, tk, period, inst, est, est_dt, row_number() OVER (PARTITION BY td, tk, period, inst ORDER BY est_dt DESC, l_orderkey DESC, l_linenumber DESC, est DESC) AS k FROM cal JOIN est ON td BETWEEN est_dt AND est_dt + 60 WHERE est <> 0),
 o AS (SELECT td, tk, period, count(*) AS n, sum(est * pow(0.5::DOUBLE, (td - est_dt) / 30.0::DOUBLE)) / sum(pow(0.5::DOUBLE, (td - est_dt) / 30.0::DOUBLE)) AS est FROM s WHERE k = 1 GROUP BY td, tk, period) """ + sql_tidy("td, tk, period, n", ["est"], "o", 4))
def analyst_consensus(spark, sf_dir):
    return tidy(pit.consensus(estimates(spark, sf_dir), trading_days(spark, sf_dir), window_days=60), ["td", "tk", "period", "n"], ["est"], 4)


@query("asof_join", f"WITH {FACTS}, e AS (SELECT event_id, user_id, ts FROM events) SELECT event_id, round((SELECT last(v ORDER BY ann, rid) FROM f WHERE f.tk = e.user_id AND f.ann <= e.ts), 4) AS v FROM e")
def asof_join(spark, sf_dir):
    """Latest fact of the customer with the user's number at each event."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", "ts")
    f = facts(spark, sf_dir).withColumnRenamed("tk", "user_id")
    return tidy(joins.as_of(e, f, "user_id", "ts", "ann", ["v"], order=["rid"]), ["event_id"], ["v"], 4)
