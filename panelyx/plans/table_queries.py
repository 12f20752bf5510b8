"""Queries of single tables: filters, semi-joins, expression joins, de-duplication, synchronisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins
from ..sources.tables import corrected_date
from .registry import query, tidy
from .roles import table


@query("filters_in_list", "SELECT p_brand, p_size, count(*) AS n FROM part WHERE p_size IN (1, 5, 9, 14) AND p_retailprice <= 1500 AND p_brand <> 'Brand#11' AND p_name IS NOT NULL GROUP BY ALL")
def filters_in_list(spark, sf_dir):
    p = table(spark, sf_dir, "part").filter(F.col("p_size").isin(1, 5, 9, 14) & (F.col("p_retailprice") <= 1500) & (F.col("p_brand") != "Brand#11") & F.col("p_name").isNotNull())
    return p.groupBy("p_brand", "p_size").agg(F.count("*").alias("n"))


@query("scalar_subquery", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 30 DAY")
def scalar_subquery(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    newest = o.agg(F.max("o_orderdate").alias("m"))
    return o.join(F.broadcast(newest)).filter(F.col("o_orderdate") >= F.col("m") - F.expr("INTERVAL 30 DAY")).select("o_orderkey", F.to_date("o_orderdate").alias("d"))


@query("semi_join_members", "SELECT c_mktsegment, count(*) AS n FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000) AND c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 3) GROUP BY c_mktsegment")
def semi_join_members(spark, sf_dir):
    rich = table(spark, sf_dir, "orders").filter("o_totalprice > 400000").select("o_custkey")
    near = table(spark, sf_dir, "nation").filter("n_regionkey < 3").select("n_nationkey")
    c = table(spark, sf_dir, "customer")
    c = c.join(rich, c.c_custkey == rich.o_custkey, "left_semi").join(near, c.c_nationkey == near.n_nationkey, "left_semi")
    return c.groupBy("c_mktsegment").agg(F.count("*").alias("n"))


@query("anti_join", "SELECT count(*) AS n FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL)")
def anti_join(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").join(o, "c_custkey", "left_anti").agg(F.count("*").alias("n"))


@query("expression_join", "SELECT r_name, count(*) AS n FROM nation JOIN region ON n_nationkey % 5 = r_regionkey GROUP BY r_name")
def expression_join(spark, sf_dir):
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return n.join(r, F.col("n_nationkey") % 5 == F.col("r_regionkey")).groupBy("r_name").agg(F.count("*").alias("n"))


@query("prefix_classes", "SELECT substr(p_brand, 1, 7) AS class, count(DISTINCT p_type) AS kinds FROM part GROUP BY 1")
def prefix_classes(spark, sf_dir):
    return table(spark, sf_dir, "part").groupBy(F.substring("p_brand", 1, 7).alias("class")).agg(F.count_distinct("p_type").alias("kinds"))


@query("keep_last", "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS k FROM orders) WHERE k = 1")
def keep_last(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return joins.keep_last(o, ["o_custkey"], F.desc("o_orderdate"), F.desc("o_orderkey")).select("o_custkey", "o_orderkey")


@query("roll_back_sync", """WITH old AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, o_totalprice AS v FROM orders WHERE o_orderdate < DATE '1998-01-01'), fresh AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, o_totalprice + 1 AS v FROM orders),
c AS (SELECT max(d) - 30 AS cut FROM old) SELECT o_orderkey, d, round(v, 2) AS v FROM (SELECT old.* FROM old, c WHERE d <= cut UNION ALL SELECT fresh.* FROM fresh, c WHERE d > cut)""")
def roll_back_sync(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"), F.col("o_totalprice").alias("v"))
    old = o.filter("d < date '1998-01-01'")
    return tidy(joins.roll_back_sync(old, o.withColumn("v", F.col("v") + 1), "d", ["o_orderkey"]), ["o_orderkey", "d"], ["v"], 2)


@query("corrected_dates", """SELECT event_id, CASE WHEN a = own THEN a + 1 ELSE a END AS d FROM (SELECT event_id, CAST(ts AS DATE) AS a, CASE WHEN hour(ts) < 5 THEN CAST(ts AS DATE) - 1 ELSE CAST(ts AS DATE) END AS own FROM events)""")
def corrected_dates(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", corrected_date(F.col("ts"), F.col("ts")).alias("d"))


@query("set_operations", "SELECT 'both' AS kind, count(*) AS n FROM (SELECT s_nationkey AS k FROM supplier INTERSECT SELECT c_nationkey FROM customer) UNION ALL SELECT 'only', count(*) FROM (SELECT o_custkey AS k FROM orders EXCEPT SELECT s_suppkey FROM supplier)")
def set_operations(spark, sf_dir):
    both = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k")).intersect(table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k")))
    only = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")).subtract(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k")))
    count = lambda df, name: df.agg(F.lit(name).alias("kind"), F.count("*").alias("n"))
    return count(both, "both").unionByName(count(only, "only"))


@query("pivot_flags", "SELECT l_linestatus, sum(l_quantity) FILTER (l_returnflag = 'A') AS a, sum(l_quantity) FILTER (l_returnflag = 'N') AS n, sum(l_quantity) FILTER (l_returnflag = 'R') AS r FROM lineitem GROUP BY l_linestatus")
def pivot_flags(spark, sf_dir):
    p = table(spark, sf_dir, "lineitem").groupBy("l_linestatus").pivot("l_returnflag", ["A", "N", "R"]).agg(F.sum("l_quantity"))
    return p.toDF("l_linestatus", "a", "n", "r")
