"""The queries over the relational tables, each with the SQL it agrees with."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import json_long, money
from ..operators import asof_join, greeting, interval_join
from ..sources import table
from ..streaming import closed_sessions, daily_counts, event_pairs, event_stream, run_appended, run_to_end, windowed_counts


def hello(spark: SparkSession, sf_dir: str) -> DataFrame:
    return greeting(spark)


def pricing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    net = money("l_extendedprice") * (1 - money("l_discount"))
    rows = table(spark, sf_dir, "lineitem").where(F.col("l_shipdate") <= F.lit("2001-09-02").cast("timestamp_ntz"))
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.sum(money("l_quantity")).cast("double").alias("sum_qty"), F.sum(money("l_extendedprice")).cast("double").alias("sum_base"), F.sum(net).cast("double").alias("sum_net"), F.count("*").alias("n"))


def revenue_by_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    # nations and regions are tiny by their nature; Spark broadcasts them by their file size
    t = {n: table(spark, sf_dir, n) for n in ("customer", "orders", "lineitem", "nation", "region")}
    joined = t["lineitem"].join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey")).join(t["customer"], F.col("o_custkey") == F.col("c_custkey")).join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey")).join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.groupBy("r_name", "n_name").agg(F.sum(money("l_extendedprice") * (1 - money("l_discount"))).cast("double").alias("revenue"))


def late_priorities(spark: SparkSession, sf_dir: str) -> DataFrame:
    late = table(spark, sf_dir, "lineitem").where("l_quantity >= 45").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, sf_dir, "orders").join(late, "o_orderkey", "left_semi").groupBy("o_orderpriority").agg(F.count("*").alias("n"))


def customers_without_urgent_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").join(table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_name")


def orders_per_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", "left")
    return joined.groupBy("c_custkey").agg(F.count("o_orderkey").alias("n")).groupBy("n").agg(F.count("*").alias("customers"))


def top_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20).select("o_orderkey", "o_totalprice")


def quantity_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.sum(money("l_quantity")).cast("double").alias("qty"), F.grouping_id().cast("bigint").alias("level"))


def latest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    window = Window.partitionBy("o_custkey").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey"))
    return table(spark, sf_dir, "orders").withColumn("place", F.row_number().over(window).cast("bigint")).where("place <= 3").select("o_custkey", "o_orderkey", "place")


def nations_without_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"))
    return customers.exceptAll(table(spark, sf_dir, "supplier").select("s_nationkey")).groupBy("nation").agg(F.count("*").alias("n"))


def json_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.sum(json_long("props", "$.k")).alias("k"), F.count("*").alias("n"))


def user_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("user_id", F.session_window("ts", "30 minutes").alias("w")).agg(F.count("*").alias("n")).select("user_id", F.col("w.start").cast("timestamp_ntz").alias("begun"), "n")


def purchases_before_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    errors = events.where("event_type = 'error'").select("event_id", "user_id", "ts")
    bought = events.where("event_type = 'purchase'").select("user_id", "ts", F.col("event_id").alias("purchase_id"))
    return asof_join(errors, bought, ["user_id"], "ts", ["purchase_id"], F.col("purchase_id")).select("event_id", "purchase_id")


def views_before_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    bought = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    viewed = events.where("event_type = 'view'").select("user_id", "ts", F.col("event_id").alias("earlier_id"))
    return interval_join(bought, viewed, ["user_id"], "ts", timedelta(hours=-1), timedelta(0)).select("event_id", "earlier_id")


def streamed_daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_to_end(daily_counts(event_stream(spark, sf_dir)), spark)


def streamed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_appended(windowed_counts(event_stream(spark, sf_dir)), spark)[0]


def streamed_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_appended(closed_sessions(event_stream(spark, sf_dir)), spark)[0]


def streamed_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    viewed, bought = (event_stream(spark, sf_dir).where(F.col("event_type") == t) for t in ("view", "purchase"))
    return run_appended(event_pairs(viewed, bought), spark)[0]


QUERIES = {
    "greeting": hello,
    "pricing_summary": pricing_summary,
    "revenue_by_nation": revenue_by_nation,
    "semi_join": late_priorities,
    "anti_join": customers_without_urgent_orders,
    "outer_join": orders_per_customer,
    "top_k": top_orders,
    "rollup": quantity_rollup,
    "window_rank": latest_orders,
    "except_all": nations_without_suppliers,
    "json": json_totals,
    "sessions": user_sessions,
    "asof_join": purchases_before_errors,
    "interval_join": views_before_purchases,
    "stream_daily_counts": streamed_daily_counts,
    "stream_windows": streamed_windows,
    "stream_sessions": streamed_sessions,
    "stream_interval_join": streamed_pairs,
}

_PAIRS = "SELECT p.event_id, v.event_id AS earlier_id FROM events p JOIN events v ON p.user_id = v.user_id AND v.ts >= p.ts - INTERVAL 1 HOUR AND v.ts <= p.ts WHERE p.event_type = 'purchase' AND v.event_type = 'view'"
_M = "CAST({} AS DECIMAL(15,2))".format
SQL = {
    "greeting": "SELECT 'Hello from tidewell!' AS greeting",
    "pricing_summary": f"SELECT l_returnflag, l_linestatus, CAST(sum({_M('l_quantity')}) AS DOUBLE) AS sum_qty, CAST(sum({_M('l_extendedprice')}) AS DOUBLE) AS sum_base, CAST(sum({_M('l_extendedprice')} * (1 - {_M('l_discount')})) AS DOUBLE) AS sum_net, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '2001-09-02' GROUP BY 1, 2",
    "revenue_by_nation": f"SELECT r_name, n_name, CAST(sum({_M('l_extendedprice')} * (1 - {_M('l_discount')})) AS DOUBLE) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2",
    "semi_join": "SELECT o_orderpriority, count(*) AS n FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity >= 45) GROUP BY 1",
    "anti_join": "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')",
    "outer_join": "SELECT n, count(*) AS customers FROM (SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1) GROUP BY n",
    "top_k": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20",
    "rollup": f"SELECT l_returnflag, l_linestatus, CAST(sum({_M('l_quantity')}) AS DOUBLE) AS qty, CAST(grouping(l_returnflag, l_linestatus) AS BIGINT) AS level FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)",
    "window_rank": "SELECT o_custkey, o_orderkey, CAST(place AS BIGINT) AS place FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS place FROM orders) WHERE place <= 3",
    "except_all": "SELECT nation, count(*) AS n FROM (SELECT c_nationkey AS nation FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier) GROUP BY 1",
    "json": "SELECT event_type, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k, count(*) AS n FROM events GROUP BY 1",
    "sessions": "WITH gaps AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER w + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), runs AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run FROM gaps) SELECT user_id, min(ts) AS begun, count(*) AS n FROM runs GROUP BY user_id, run",
    "asof_join": "SELECT event_id, (SELECT max(struct_pack(t := p.ts, i := p.event_id)).i FROM events p WHERE p.event_type = 'purchase' AND p.user_id = e.user_id AND p.ts <= e.ts) AS purchase_id FROM events e WHERE event_type = 'error'",
    "interval_join": _PAIRS,
    "stream_interval_join": _PAIRS,
    "stream_daily_counts": "SELECT date_trunc('day', ts)::TIMESTAMP AS day, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS total FROM events GROUP BY 1, 2",
    # windows and sessions that the watermark, an hour behind the latest event, has passed
    "stream_windows": "SELECT date_trunc('day', ts)::TIMESTAMP AS begun, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS total FROM events GROUP BY 1, 2 HAVING date_trunc('day', ts)::TIMESTAMP + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)",
    "stream_sessions": "WITH gaps AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER w + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts)), runs AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run FROM gaps) SELECT user_id, min(ts) AS begun, count(*) AS n FROM runs GROUP BY user_id, run HAVING max(ts) + INTERVAL 30 MINUTE <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)",
}
