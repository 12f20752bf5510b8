"""The risk model's exposures from its declared graph, and what the graph is made of."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import cross_section as xs
from ..functions import windows as win
from ..operators import graph, joins, pit, risk, risk_formulas
from ..operators import universe as un
from .fact_queries import NEWEST, STEPS
from .panel_queries import KEYS, LAG, MOM, RET, TRAIL, momentum, returns
from .registry import query, sql_tidy, tidy
from .roles import WEEKLY, bars, table, trading_days

# --- roles -------------------------------------------------------------------------------------------------------------


def listings(spark, sf_dir):
    """Suppliers with a date of listing and, for some, of delisting."""
    listed = F.date_add(F.lit("1995-01-01").cast("date"), (F.col("s_suppkey") * 37 % 400).cast("int"))
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("int").alias("tk"), listed.alias("list_dt"), F.when(F.col("s_suppkey") % 17 == 3, F.date_add(listed, 1500)).alias("delist_dt"), "s_nationkey")


def industries(spark, sf_dir, days):
    rows = listings(spark, sf_dir).join(table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.col("r_name").alias("industry")), F.col("s_nationkey") == F.col("n_nationkey"))
    return un.industry(days, rows, start="list_dt", end="delist_dt")


#: Orders as statements of three kinds: what the measure of each is.
MEASURES = {"earnings": ("o_totalprice", lambda o: F.col("o_totalprice")), "equity": ("o_totalprice * (1 + o_orderkey % 3)", lambda o: F.col("o_totalprice") * (1 + F.col("o_orderkey") % 3)), "sales": ("CASE WHEN o_orderkey % 4 < 3 THEN o_totalprice ELSE 0 END", lambda o: F.when(F.col("o_orderkey") % 4 < 3, F.col("o_totalprice")).otherwise(F.lit(0.0)))}


def statements(spark, sf_dir, kind: str):
    """Monthly sums of 50 groups of customers as versioned facts."""
    o = table(spark, sf_dir, "orders")
    o = o.withColumn("x", MEASURES[kind][1](o)).groupBy((F.col("o_custkey") % 50).cast("int").alias("tk"), F.to_date(F.date_trunc("month", "o_orderdate")).alias("m"))
    o = o.agg(F.to_date(F.max("o_orderdate")).alias("ann"), F.round(F.sum("x"), 2).alias("v")).withColumn("end", F.date_sub(F.to_date(F.date_trunc("quarter", "m")), 1))
    return pit.facts(o, "tk", "ann", "end", "v", "m")


def holdings(spark, sf_dir):
    """Orders as institutions' holdings at the end of the quarter before the order."""
    o = table(spark, sf_dir, "orders")
    return o.select((F.col("o_custkey") % 100).cast("int").alias("tk"), F.date_sub(F.to_date(F.date_trunc("quarter", F.date_sub(F.to_date("o_orderdate"), (F.col("o_orderkey") % 200).cast("int")))), 1).alias("end_dt"), F.to_date("o_orderdate").alias("ann_dt"), F.col("o_totalprice").alias("quantity"))


def float_shares(days, names):
    """Shares of listed names; of some none."""
    rows = joins.interval_join(days, names, "list_dt", "delist_dt")
    return rows.select("td", "tk", (F.col("tk") % 7).cast("double").alias("shares"))


def order_estimates(spark, sf_dir):
    return table(spark, sf_dir, "orders").select((F.col("o_custkey") % 100).cast("int").alias("tk"), (F.col("o_custkey") % 40).alias("inst"), F.to_date("o_orderdate").alias("est_dt"))


def capital(spark, sf_dir):
    o = table(spark, sf_dir, "orders").filter("o_orderkey % 5 = 0")
    return o.select((F.col("o_custkey") % 100).cast("int").alias("tk"), F.to_date("o_orderdate").alias("ann_dt"), F.date_sub(F.to_date("o_orderdate"), (F.col("o_orderkey") % 30).cast("int")).alias("change_dt"), (F.col("o_orderkey") % 11).cast("double").alias("state"), (F.col("o_orderkey") % 11 + F.col("o_custkey") % 5 + 1).cast("double").alias("total"))


LISTINGS = """names AS MATERIALIZED (SELECT CAST(s_suppkey AS INTEGER) AS tk, list_dt, CASE WHEN s_suppkey % 17 = 3 THEN list_dt + 1500 END AS delist_dt, s_nationkey
 FROM (SELECT *, DATE '1995-01-01' + CAST(s_suppkey * 37 % 400 AS INTEGER) AS list_dt FROM supplier)),
inds AS MATERIALIZED (SELECT td, tk, r_name AS industry FROM cal JOIN (names JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) ON td BETWEEN list_dt AND coalesce(delist_dt, DATE '2100-01-01'))"""
HOLDINGS = """hold AS (SELECT CAST(o_custkey % 100 AS INTEGER) AS tk, CAST(date_trunc('quarter', CAST(o_orderdate AS DATE) - CAST(o_orderkey % 200 AS INTEGER)) AS DATE) - 1 AS end_dt, CAST(o_orderdate AS DATE) AS ann_dt, o_totalprice AS quantity FROM orders),
hk AS (SELECT *, CASE WHEN month(end_dt) = 12 THEN make_date(year(end_dt) + 1, 4, 30) WHEN month(end_dt) = 6 THEN make_date(year(end_dt), 8, 31) END AS known FROM hold),
hq AS (SELECT (SELECT max(td) FROM cal WHERE td <= known) AS td, tk, sum(quantity) AS quantity FROM hk WHERE known >= ann_dt AND known <= (SELECT max(td) FROM cal) GROUP BY ALL),
hv AS MATERIALIZED (SELECT hq.td AS td, tk, quantity / (tk % 7) / 10000 AS v FROM hq JOIN names USING (tk) WHERE td BETWEEN list_dt AND coalesce(delist_dt, DATE '2100-01-01') AND tk % 7 > 0),
hd AS (SELECT cal.td AS td, (SELECT max(td) FROM hv WHERE hv.td <= cal.td) AS d FROM cal),
hshare AS MATERIALIZED (SELECT hd.td AS td, tk, v FROM hd JOIN hv ON hv.td = hd.d)"""


@query("institution_share", f"WITH {WEEKLY}, {LISTINGS}, {HOLDINGS} " + sql_tidy("td, tk", ["v"], "hshare", 9))
def institution_share(spark, sf_dir):
    """What institutions hold of each name, known at fixed dates and carried while no name has anything newer."""
    days = joins.local(trading_days(spark, sf_dir))
    return tidy(risk.institution_share(holdings(spark, sf_dir), float_shares(days, listings(spark, sf_dir)), days), KEYS, ["v"], 9)


CAPITAL = """capi AS (SELECT CAST(o_custkey % 100 AS INTEGER) AS tk, CAST(o_orderdate AS DATE) AS ann, CAST(o_orderdate AS DATE) - CAST(o_orderkey % 30 AS INTEGER) AS change, CAST(o_orderkey % 11 AS DOUBLE) AS state, CAST(o_orderkey % 11 + o_custkey % 5 + 1 AS DOUBLE) AS total FROM orders WHERE o_orderkey % 5 = 0),
capn AS (SELECT tk, ann, arg_max(state / total, (change, total, state)) AS ratio FROM capi GROUP BY ALL),
sshare AS MATERIALIZED (SELECT td, tk, arg_max(ratio, ann) AS v FROM (SELECT *, (SELECT max(td) FROM cal WHERE td <= ann) AS td FROM capn) WHERE td IS NOT NULL GROUP BY td, tk)"""


@query("state_share", f"WITH {WEEKLY}, {CAPITAL} " + sql_tidy("td, tk", ["v"], "sshare", 6))
def state_share(spark, sf_dir):
    return tidy(risk.state_share(capital(spark, sf_dir), joins.local(trading_days(spark, sf_dir))), KEYS, ["v"], 6)


# --- numerics of the graph ------------------------------------------------------------------------------------------------


def box_sql(source: str, cols: list[str], out: str) -> str:
    """CTE out: source with cols clipped to their boxes, by the matrix of all pairs of a date."""
    ctes = []
    for c in cols:
        b = f"{out}_{c}"
        ctes.append(f"{b}_q AS MATERIALIZED (SELECT td, quantile_cont({c}, 0.25) AS bx_q1, quantile_cont({c}, 0.75) AS bx_q3, median({c}) AS bx_m FROM {source} GROUP BY td HAVING count({c}) > 10)")
        ctes.append(f"{b}_d AS MATERIALIZED (SELECT td, {c} - bx_m AS d, row_number() OVER (PARTITION BY td, {c} = bx_m ORDER BY tk) AS r FROM {source} JOIN {b}_q USING (td) WHERE {c} IS NOT NULL)")
        ctes.append(f"{b}_m AS MATERIALIZED (SELECT a.td AS td, median(CASE WHEN a.d = 0 AND b.d = 0 THEN sign(a.r - b.r) ELSE (a.d + b.d) / (a.d - b.d) END) AS mc FROM {b}_d a JOIN {b}_d b ON a.td = b.td AND a.d >= 0 AND b.d <= 0 GROUP BY a.td)")
        ctes.append(f"{b}_l AS MATERIALIZED (SELECT td, bx_q1 - 1.5::DOUBLE * exp((CASE WHEN mc >= 0 THEN -3.5::DOUBLE ELSE -4 END) * mc) * (bx_q3 - bx_q1) AS lo, bx_q3 + 1.5::DOUBLE * exp((CASE WHEN mc >= 0 THEN 4 ELSE 3.5::DOUBLE END) * mc) * (bx_q3 - bx_q1) AS hi FROM {b}_q JOIN {b}_m USING (td))")
    clip = ", ".join(f"CASE WHEN {c} IS NULL OR {out}_{c}_l.lo IS NULL THEN {c} ELSE least(greatest({c}, {out}_{c}_l.lo), {out}_{c}_l.hi) END AS {c}" for c in cols)
    from_ = " ".join(f"LEFT JOIN {out}_{c}_l ON {out}_{c}_l.td = {source}.td" for c in cols)
    ctes.append(f"{out} AS MATERIALIZED (SELECT {source}.* REPLACE ({clip}) FROM {source} {from_})")
    return ", ".join(ctes)


def z_sql(source: str, cols: list[str], out: str, weight: str = "cap") -> str:
    z = ", ".join(f"({c} - sum({c} * {weight}) OVER d / sum(CASE WHEN {c} IS NOT NULL THEN {weight} END) OVER d) / (stddev_samp({c}) OVER d + 1e-8) AS {c}" for c in cols)
    return f"{out} AS MATERIALIZED (SELECT * REPLACE ({z}) FROM {source} WINDOW d AS (PARTITION BY td))"


def squeeze_sql(source: str, cols: list[str], out: str) -> str:
    up = lambda c: f"greatest(0, least(1, 0.5::DOUBLE / (max({c}) OVER d - 3)))"
    down = lambda c: f"greatest(0, least(1, 0.5::DOUBLE / (-min({c}) OVER d - 3)))"
    x = ", ".join(f"CASE WHEN {c} > 3 THEN 3 * (1 - {up(c)}) + {c} * {up(c)} WHEN {c} < -3 THEN -3 * (1 - {down(c)}) + {c} * {down(c)} ELSE {c} END AS {c}" for c in cols)
    return f"{out} AS MATERIALIZED (SELECT * REPLACE ({x}) FROM {source} WINDOW d AS (PARTITION BY td))"


@query("box_winsor", f"WITH {MOM}, s AS (SELECT td, tk, mom AS w FROM m WHERE mom IS NOT NULL), {box_sql('s', ['w'], 'o')} " + sql_tidy("td, tk", ["w"], "o"))
def box_winsor(spark, sf_dir):
    """Momentum, clipped to the date's skewness-adjusted box."""
    return tidy(xs.winsorize_box(momentum(spark, sf_dir).filter("mom is not null"), "mom", "w"), KEYS, ["w"])


def eliminated_sql(source: str, k: int, out: str, keep: str) -> str:
    """CTEs that take k regressors out of the window sums s0_0 ... of source, and the CTE out with rss and n."""
    ctes, at = [], source
    for p in range(k):
        left = ", ".join(f"s{i}_{j} - s{p}_{i} * s{p}_{j} * v AS s{i}_{j}" for i in range(p + 1, k + 1) for j in range(i, k + 1))
        first = "".join(f", {'o' if p else 's'}{i}{'' if p else f'_{i}'} AS o{i}" for i in range(p + 1, k))
        own = f"CASE WHEN s{p}_{p} > 1e-10 * {f'o{p}' if p else f's{p}_{p}'} THEN 1 / s{p}_{p} ELSE 0 END"
        ctes.append(f"{out}_{p} AS MATERIALIZED (SELECT {keep}, n, {left}{first} FROM (SELECT *, {own} AS v FROM {at}))")
        at = f"{out}_{p}"
    return ", ".join([*ctes, f"{out} AS (SELECT {keep}, n, s{k}_{k} AS rss FROM {at})"])


def products_sql(terms: list[str], n: int, there: str) -> str:
    return ", ".join(f"sum(CASE WHEN {there} THEN ({a}) * ({b}) END) OVER t AS s{i}_{j}" for i, a in enumerate(terms) for j, b in enumerate(terms) if i <= j) + f", count(CASE WHEN {there} THEN 1 END) OVER t AS n"


@query("residual_volatility", f"""WITH {RET}, mk AS (SELECT *, avg(ret) OVER (PARTITION BY td) AS m FROM r), pr AS (SELECT td, tk, {products_sql(['1.0::DOUBLE', 'm', 'm * m', 'ret'], 52, 'ret IS NOT NULL AND m IS NOT NULL')} FROM mk WINDOW t AS {TRAIL(52)}),
 {eliminated_sql('pr', 3, 'e', 'td, tk')}, o AS (SELECT td, tk, sqrt(greatest(rss, 0) / n) AS ivol FROM e WHERE n >= 26) """ + sql_tidy("td, tk", ["ivol"], "o", 3))
def residual_volatility(spark, sf_dir):
    """Deviation of returns around a rolling regression on the market and its square."""
    p = returns(spark, sf_dir).withColumn("m", F.avg("ret").over(Window.partitionBy("td"))).withColumn("m2", F.col("m") * F.col("m"))
    return tidy(risk.residual_volatility(p, "ret", ["m", "m2"], 52, 26).filter("ivol is not null"), KEYS, ["ivol"], 3)


# --- the graph ------------------------------------------------------------------------------------------------------------

WINDOW, PERIODS = 52, 26
FACTORS = ["size", "beta", "trend", "liquidity", "volatility", "value", "growth", "nls", "certainty", "soe", "market"]
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")


def cap(amount: str):
    """Amounts of a quarter stand for capital."""
    return F.sum(amount).over(win.trailing(13))


def model() -> graph.Graph:
    config = risk_formulas.config(WINDOW, PERIODS, long=48, middle=24, short=5, industries=REGIONS)
    sub = graph.Sub
    inputs = [
        sub("beta_sums", "beta_sums", {"window": WINDOW}), sub("beta_fit", "beta_fit", {"min_periods": PERIODS}), sub("turnover_sums", "turnover_sums", {"window": WINDOW}), sub("factor_products", "factor_products", {"window": WINDOW}),
        sub("seasoned_return", "seasoned_return", {"positions": WINDOW, "limit": 0.5}),
    ]
    return graph.Graph(graph.from_config(config), risk_formulas.FORMULAS | {"cap": cap}, inputs=inputs)


def exposures(spark, sf_dir, start: str = "1997-01-01"):
    """One reading of the line items: the calendar is held as rows, everything else comes from small tables."""
    days = joins.local(trading_days(spark, sf_dir))
    names = listings(spark, sf_dir)
    tables = {
        "days": days, "earnings": statements(spark, sf_dir, "earnings"), "equity": statements(spark, sf_dir, "equity"), "sales": statements(spark, sf_dir, "sales"), "holdings": holdings(spark, sf_dir),
        "float_shares": float_shares(days, names), "estimates": order_estimates(spark, sf_dir), "listings": names, "capital": capital(spark, sf_dir), "industries": industries(spark, sf_dir, days),
    }
    panel = bars(spark, sf_dir).join(F.broadcast(days.select("td", "ix")), "td")
    universes = {"listed": un.listed(days, names, 0), "seasoned": un.listed(days, names, 250)}
    return model().exposures(panel, tables, weight="cap", member="listed", universes=universes, industries="industries", start=start)


def _fill(source: str, out: str) -> str:
    """Newest facts on the calendar, from the last date before the announcement on."""
    return f"""{out}_l AS ({NEWEST.format(source=source)}), {out}_e AS (SELECT *, coalesce((SELECT max(td) FROM cal WHERE td < {out}_l.ann), (SELECT min(td) FROM cal)) AS eff FROM {out}_l),
 {out}_u AS (SELECT *, least(coalesce(lead(eff) OVER (PARTITION BY tk ORDER BY ann, q, rid) - 1, DATE '2999-01-01'), ann + 365) AS until FROM {out}_e),
 {out} AS MATERIALIZED (SELECT cal.td AS td, tk, v FROM cal JOIN {out}_u ON td BETWEEN eff AND until WHERE q >= year(td) * 4 + quarter(td) - 1 - 4)"""


def _statements(kind: str) -> str:
    return f"""{kind} AS MATERIALIZED (SELECT tk, ann, q, v, row_number() OVER (PARTITION BY tk ORDER BY ann, q, m) AS rid FROM (
        SELECT tk, m, ann, v, CAST(year(e) * 4 + quarter(e) - 1 AS INTEGER) AS q FROM (
          SELECT CAST(o_custkey % 50 AS INTEGER) AS tk, date_trunc('month', o_orderdate) AS m, CAST(max(o_orderdate) AS DATE) AS ann, round(sum({MEASURES[kind][0]}), 2) AS v,
                 date_trunc('quarter', date_trunc('month', o_orderdate)) - INTERVAL 1 DAY AS e FROM orders GROUP BY ALL) WHERE v IS NOT NULL))"""


def _history(n: int, source: str, out: str) -> str:
    return f"{out} AS MATERIALIZED (SELECT tk, ann, q, rid, any_value(v) AS v, list(gv ORDER BY gq) AS a, list(gq ORDER BY gq) AS qs FROM (SELECT x.tk, x.ann, x.q, x.rid, x.v, g.q AS gq, g.v AS gv, row_number() OVER (PARTITION BY x.tk, x.rid, g.q ORDER BY g.ann DESC, g.rid DESC) AS k FROM {source} x JOIN {source} g ON x.tk = g.tk AND g.q BETWEEN x.q - {n - 1} AND x.q AND g.ann <= x.ann) WHERE k = 1 GROUP BY tk, ann, q, rid)"


def _cagr(history: str, out: str) -> str:
    return f"{out} AS (SELECT tk, ann, q, rid, CASE WHEN b[-1].v / b[1].v > 0 THEN pow(b[-1].v / b[1].v, 4.0::DOUBLE / (b[-1].q - b[1].q)) - 1 END AS v FROM (SELECT *, list_filter(list_transform(range(1, len(a) + 1), lambda i: {{'q': qs[i], 'v': a[i]}}), lambda s: s.v <> 0) AS b FROM {history}) WHERE len(b) >= 2)"


def _ewm(half: int, least: int) -> str:
    w = f"pow(2.0::DOUBLE, ix / {half}.0::DOUBLE)"
    return f"CASE WHEN count(close) OVER e >= {least} THEN sum(close * {w}) OVER e / sum({w}) OVER e END"


def _model_sql(start: str = "1997-01-01") -> str:
    ctes = [WEEKLY, LISTINGS, HOLDINGS, CAPITAL, *(_statements(k) for k in MEASURES)]
    # facts: trailing year, growth, return on equity
    for k in ("earnings", "sales"):
        ctes += [f"{k}_t0 AS MATERIALIZED (SELECT tk, ann, q, rid, {STEPS['ttm'](k)} AS v FROM {k} x)", f"{k}_t AS MATERIALIZED (SELECT * FROM {k}_t0 WHERE v IS NOT NULL)"]
    ctes += [
        "roe0 AS MATERIALIZED (SELECT tk, ann, q, rid, v / nullif(abs((SELECT last(y.v ORDER BY y.q, y.ann, y.rid) FROM equity y WHERE y.tk = x.tk AND y.q <= x.q AND y.ann <= x.ann)), 0) AS v FROM earnings_t x)",
        "roe AS MATERIALIZED (SELECT * FROM roe0 WHERE v IS NOT NULL)", f"droe0 AS MATERIALIZED (SELECT tk, ann, q, rid, {STEPS['yoy_diff']('roe')} AS v FROM roe x)", "droe AS MATERIALIZED (SELECT * FROM droe0 WHERE v IS NOT NULL)",
        _history(12, "droe", "droe_h"), "droe_m AS (SELECT tk, ann, q, rid, list_aggregate(a, 'avg') AS v FROM droe_h WHERE len(a) >= 2)", _history(12, "sales_t", "sales_h"), _cagr("sales_h", "sales_g"), _history(12, "equity", "equity_h"), _cagr("equity_h", "equity_g"),
        _fill("earnings_t", "profit"), _fill("equity", "book"), _fill("droe_m", "d_roe"), _fill("sales_g", "s_growth"), _fill("equity_g", "n_growth"),
        "oest AS (SELECT CAST(o_custkey % 100 AS INTEGER) AS tk, o_custkey % 40 AS inst, CAST(o_orderdate AS DATE) AS est_dt FROM orders)",
        "insts AS MATERIALIZED (SELECT td, tk, count(DISTINCT inst) AS v FROM cal JOIN oest ON td BETWEEN est_dt AND est_dt + 170 GROUP BY td, tk)",
    ]
    # the panel with everything that comes from tables
    tables = {"profit": "profit", "book": "book", "d_roe": "d_roe", "s_growth": "s_growth", "n_growth": "n_growth", "hshare": "hshare", "sshare": "sshare", "insts": "insts"}
    join = " ".join(f"LEFT JOIN {t} ON {t}.td = wk.td AND {t}.tk = wk.tk" for t in tables.values())
    ctes += [
        f"""p0 AS MATERIALIZED (SELECT wk.*, {', '.join(f'{t}.v AS {t}_v' for t in tables)}, inds.industry, wk.td BETWEEN list_dt AND coalesce(delist_dt, DATE '2100-01-01') AS listed, wk.td BETWEEN list_dt + 250 AND coalesce(delist_dt, DATE '2100-01-01') AS seasoned, wk.td - list_dt AS age
         FROM wk {join} LEFT JOIN inds ON inds.td = wk.td AND inds.tk = wk.tk LEFT JOIN names ON names.tk = wk.tk)""",
        f"p1 AS MATERIALIZED (SELECT *, close / nullif(max(close) OVER {LAG(1)}, 0) - 1 AS ret, sum(amount) OVER {TRAIL(13)} AS cap, last(sshare_v IGNORE NULLS) OVER {TRAIL(244)} AS held_state FROM p0)",
        f"p2 AS MATERIALIZED (SELECT *, sum(ret * cap) OVER d / sum(CASE WHEN ret IS NOT NULL THEN cap END) OVER d AS mret, ln(amount / nullif(max(cap) OVER {LAG(1)}, 0)) AS turn, ln(sum(amount) OVER d / sum(cap) OVER d) AS mturn, CASE WHEN (ix < {WINDOW} OR max(ret) OVER {LAG(WINDOW)} IS NOT NULL) AND abs(ret) <= 0.5::DOUBLE THEN ret END AS sret, max(cap) OVER {LAG(1)} AS lcap, 1 / max(cap / book_v) OVER {LAG(1)} AS lval FROM p1 WINDOW d AS (PARTITION BY td))",
        "p3 AS MATERIALIZED (SELECT *, quantile_cont(lcap, 0.5) OVER d AS c1, quantile_cont(lval, 0.3) OVER d AS v1, quantile_cont(lval, 0.7) OVER d AS v2 FROM p2 WINDOW d AS (PARTITION BY td))",
        "p4 AS MATERIALIZED (SELECT *, avg(CASE WHEN lcap <= c1 THEN sret END) OVER d - avg(CASE WHEN lcap > c1 THEN sret END) OVER d AS smb, avg(CASE WHEN lval <= v1 THEN sret END) OVER d - avg(CASE WHEN lval > v2 THEN sret END) OVER d AS hml FROM p3 WINDOW d AS (PARTITION BY td))",
        f"pr AS MATERIALIZED (SELECT td, tk, {products_sql(['1.0::DOUBLE', 'coalesce(mret, 0)', 'coalesce(smb, 0)', 'coalesce(hml, 0)', 'ret'], WINDOW, 'ret IS NOT NULL')} FROM p4 WINDOW t AS {TRAIL(WINDOW)})", eliminated_sql("pr", 4, "iv", "td, tk"),
        f"""rg AS MATERIALIZED (SELECT *, regr_slope(ret, mret) OVER t AS b, regr_count(ret, mret) OVER t AS bn, (regr_syy(ret, mret) OVER t - regr_sxy(ret, mret) OVER t ** 2 / nullif(regr_sxx(ret, mret) OVER t, 0)) / nullif(CAST(regr_count(ret, mret) OVER t AS BIGINT) - 2, 0) / nullif(regr_sxx(ret, mret) OVER t, 0) AS se2,
          regr_slope(turn, mturn) OVER t AS lb, regr_count(turn, mturn) OVER t AS ln FROM p4 WINDOW t AS {TRAIL(WINDOW)})""",
        f"bt AS MATERIALIZED (SELECT *, bn >= {PERIODS} AND b IS NOT NULL AND se2 IS NOT NULL AND industry IS NOT NULL AS used FROM rg)",
        "bm AS MATERIALIZED (SELECT *, sum(CASE WHEN used THEN b * cap END) OVER g / sum(CASE WHEN used THEN cap END) OVER g AS bmean, avg(CASE WHEN used THEN b * b END) OVER g AS bb, avg(CASE WHEN used THEN b END) OVER g AS ba FROM bt WINDOW g AS (PARTITION BY td, industry))",
        "bs AS MATERIALIZED (SELECT *, bb - 2 * bmean * ba + bmean * bmean AS bvar FROM bm)",
        f"""f0 AS MATERIALIZED (SELECT bs.td AS td, bs.tk AS tk, cap, industry, CASE WHEN listed THEN ln(1 + cap) END AS size_sub, CASE WHEN listed AND seasoned AND used THEN bvar / nullif(bvar + se2, 0) * b + (1 - bvar / nullif(bvar + se2, 0)) * bmean END AS beta_sub,
          CASE WHEN listed THEN {_ewm(5, 2)} / {_ewm(24, 12)} END AS trend_24, CASE WHEN listed THEN {_ewm(5, 2)} / {_ewm(48, 24)} END AS trend_48,
          CASE WHEN listed AND count(turn) OVER t >= {PERIODS} THEN avg(turn) OVER t END AS turnover_sub, CASE WHEN listed AND seasoned AND ln >= {PERIODS} THEN lb END AS liquidity_beta_sub,
          CASE WHEN listed AND count(ret) OVER t >= {PERIODS} THEN stddev_samp(ret) OVER t END AS stdvol_sub, CASE WHEN listed AND count(high) OVER t >= {PERIODS} THEN max(high) OVER t / min(low) OVER t - 1 END AS price_range_sub,
          CASE WHEN listed AND count(ret) OVER t >= {PERIODS} THEN list_aggregate(list_sort(list(ret) FILTER (ret IS NOT NULL) OVER t, 'DESC')[1:6], 'avg') END AS max_ret_6, CASE WHEN listed AND count(ret) OVER t >= {PERIODS} THEN list_aggregate(list_sort(list(ret) FILTER (ret IS NOT NULL) OVER t)[1:6], 'avg') END AS min_ret_6,
          CASE WHEN listed AND seasoned AND iv.n >= {PERIODS} THEN sqrt(greatest(rss, 0) / iv.n) END AS ivff_sub, CASE WHEN listed THEN profit_v / cap END AS ep_sub, CASE WHEN listed THEN book_v / cap END AS bp_sub,
          CASE WHEN listed THEN d_roe_v END AS delta_roe_sub, CASE WHEN listed THEN s_growth_v END AS sales_growth_sub, CASE WHEN listed THEN n_growth_v END AS na_growth_sub, CASE WHEN listed THEN hshare_v END AS instholder_sub, coalesce(insts_v, 0) AS cover, CASE WHEN listed THEN CAST(age AS DOUBLE) END AS listed_days_sub,
          CASE WHEN listed THEN coalesce(held_state, 0) END AS soe_sub, listed
         FROM bs JOIN iv ON iv.td = bs.td AND iv.tk = bs.tk WINDOW t AS (PARTITION BY bs.tk ORDER BY ix RANGE BETWEEN {WINDOW - 1} PRECEDING AND CURRENT ROW), e AS (PARTITION BY bs.tk ORDER BY ix RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""",
    ]
    box = ["beta_sub", "trend_24", "trend_48", "turnover_sub", "liquidity_beta_sub", "stdvol_sub", "price_range_sub", "max_ret_6", "min_ret_6", "ivff_sub", "ep_sub", "bp_sub", "delta_roe_sub", "sales_growth_sub", "na_growth_sub", "size_sub", "instholder_sub", "listed_days_sub"]
    ctes += [box_sql("f0", box, "f1"), z_sql("f1", [*box, "soe_sub"], "f2"), squeeze_sql("f2", ["instholder_sub"], "f3"), z_sql("f3", ["instholder_sub"], "f4")]
    # what reads the processed size: residuals of its cube and of the coverage
    ctes += [
        """n0 AS MATERIALIZED (SELECT *, sqrt(cap) AS w, size_sub AS x, pow(size_sub, 3) AS y FROM f4)""",
        """n1 AS MATERIALIZED (SELECT *, sum(CASE WHEN y IS NOT NULL THEN w END) OVER d AS sw, sum(w * x) OVER d AS sx, sum(w * y) OVER d AS sy, sum(w * x * x) OVER d AS sxx, sum(w * x * y) OVER d AS sxy, count(x) OVER d AS m, sum(x) OVER d AS tx, sum(CASE WHEN x IS NOT NULL THEN cover END) OVER d AS ty, sum(x * x) OVER d AS txx, sum(x * cover) OVER d AS txy FROM n0 WINDOW d AS (PARTITION BY td))""",
        """n2 AS MATERIALIZED (SELECT *, (sw * sxy - sx * sy) / nullif(sw * sxx - sx * sx, 0) AS k1, (m * txy - tx * ty) / nullif(m * txx - tx * tx, 0) AS k2 FROM n1)""",
        """f5 AS MATERIALIZED (SELECT *, CASE WHEN listed THEN y - (sy - k1 * sx) / sw - k1 * x END AS nls_sub, CASE WHEN listed THEN coalesce(cover - (ty - k2 * tx) / m - k2 * x, 0) END AS coverage_sub FROM n2)""",
        box_sql("f5", ["nls_sub", "coverage_sub"], "f6"), z_sql("f6", ["nls_sub", "coverage_sub"], "f7"), squeeze_sql("f7", ["coverage_sub"], "f8"), z_sql("f8", ["coverage_sub"], "f9"),
    ]
    groups = {"size": ["size_sub"], "beta": ["beta_sub"], "trend": ["trend_24", "trend_48"], "liquidity": ["turnover_sub", "liquidity_beta_sub"], "volatility": ["stdvol_sub", "price_range_sub", "max_ret_6", "min_ret_6", "ivff_sub"], "value": ["ep_sub", "bp_sub"], "growth": ["delta_roe_sub", "sales_growth_sub", "na_growth_sub"], "nls": ["nls_sub"], "certainty": ["instholder_sub", "coverage_sub", "listed_days_sub"], "soe": ["soe_sub"]}
    mean = lambda of: f"({' + '.join(f'coalesce({c}, 0)' for c in of)}) / nullif({' + '.join(f'CAST({c} IS NOT NULL AS INTEGER)' for c in of)}, 0)"
    ctes.append(f"g0 AS MATERIALIZED (SELECT td, tk, cap, industry, {', '.join(f'{mean(of)} AS {name}' for name, of in groups.items())} FROM f9)")
    again = ["trend", "liquidity", "volatility", "value", "growth"]
    ctes += [box_sql("g0", again, "g1"), z_sql("g1", again, "g2")]
    dummies = ", ".join(f"CASE WHEN industry = '{r}' THEN 1.0 ELSE 0.0 END AS \"{r}\"" for r in REGIONS)
    return f"WITH {', '.join(ctes)}, o AS (SELECT *, 1.0 AS market, {dummies} FROM g2 WHERE td >= DATE '{start}') "


MODEL_COLUMNS = [*FACTORS, *REGIONS]


@query("exposure_graph", _model_sql() + "SELECT td, tk, " + ", ".join(f"round(CASE WHEN isfinite(CAST({c} AS DOUBLE)) THEN CAST({c} AS DOUBLE) END, 3) AS {c}" for c in FACTORS) + ", " + ", ".join(f'round(CAST("{c}" AS DOUBLE), 3) AS "{c}"' for c in REGIONS) + " FROM o")
def exposure_graph(spark, sf_dir):
    """Twelve factors (one of them the industries) of all names from 1997 on."""
    return tidy(exposures(spark, sf_dir), KEYS, MODEL_COLUMNS, 3)
