"""Joins, nesting, representatives and recent rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.operators.nesting import first_row, nest_list as nest_rows, nest_set as nest_distinct, one_per_day, pick_first
from chartloom.operators.relational import attach_children, lookup, lookup_hot
from chartloom.operators.windows import latest_n as latest
from workload.registry import query
from workload.standin import load


@query(
    """SELECT o_orderkey, c_name, c_mktsegment, n_name FROM orders
       JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""
)
def lookup_inner(spark: SparkSession, sf: str) -> DataFrame:
    orders = load(spark, sf, "orders").select("o_orderkey", "o_custkey")
    customer = load(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    named = lookup(orders, customer, [("o_custkey", "c_custkey")])
    nation = load(spark, sf, "nation").select("n_nationkey", "n_name")
    return lookup(named, nation, [("c_nationkey", "n_nationkey")]).drop("o_custkey", "c_nationkey")


@query(
    """SELECT o_orderkey, s_name FROM orders
       LEFT JOIN supplier ON s_suppkey = CASE WHEN o_orderstatus <> 'P' THEN o_custkey END"""
)
def lookup_left(spark: SparkSession, sf: str) -> DataFrame:
    optional = F.when(F.col("o_orderstatus") != "P", F.col("o_custkey"))
    orders = load(spark, sf, "orders").select("o_orderkey", optional.alias("supplier"))
    supplier = load(spark, sf, "supplier").select("s_suppkey", "s_name")
    return lookup(orders, supplier, [("supplier", "s_suppkey")], "left", spread_nulls=True).drop("supplier")


@query(
    """SELECT l_orderkey, l_linenumber, s_name FROM lineitem
       LEFT JOIN supplier ON s_suppkey = CASE WHEN l_returnflag = 'R' THEN NULL WHEN l_returnflag = 'N' THEN 1 ELSE l_suppkey END"""
)
def join_hot_key(spark: SparkSession, sf: str) -> DataFrame:
    """Half of the rows have one key, and a quarter none."""
    key = F.when(F.col("l_returnflag") == "N", F.lit(1)).when(F.col("l_returnflag") != "R", F.col("l_suppkey"))
    lines = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", key.cast("bigint").alias("supplier"))
    supplier = load(spark, sf, "supplier").select("s_suppkey", "s_name")
    return lookup_hot(lines, supplier, ("supplier", "s_suppkey"), "left").drop("supplier")


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, o_custkey, o_orderdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
)
def join_inner(spark: SparkSession, sf: str) -> DataFrame:
    lines = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    orders = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return lookup(lines, orders, [("l_orderkey", "o_orderkey")])


@query(
    """SELECT o_orderkey, l_linenumber, l_partkey FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey"""
)
def join_left(spark: SparkSession, sf: str) -> DataFrame:
    orders = load(spark, sf, "orders").select("o_orderkey")
    lines = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return lookup(orders, lines, [("o_orderkey", "l_orderkey")], "left")


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, b.n_name AS buyer_n_name, s.n_name AS seller_n_name
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN supplier ON l_suppkey = s_suppkey JOIN nation b ON c_nationkey = b.n_nationkey
       JOIN nation s ON s_nationkey = s.n_nationkey"""
)
def role_playing_lookup(spark: SparkSession, sf: str) -> DataFrame:
    lines = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    orders = load(spark, sf, "orders").select("o_orderkey", "o_custkey")
    customer = load(spark, sf, "customer").select("c_custkey", "c_nationkey")
    supplier = load(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    nation = load(spark, sf, "nation").select("n_nationkey", "n_name")
    rows = lookup(lines, orders, [("l_orderkey", "o_orderkey")])
    rows = lookup(rows, customer, [("o_custkey", "c_custkey")])
    rows = lookup(rows, supplier, [("l_suppkey", "s_suppkey")])
    rows = lookup(rows, nation, [("c_nationkey", "n_nationkey")], prefix="buyer_")
    rows = lookup(rows, nation, [("s_nationkey", "n_nationkey")], prefix="seller_")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "buyer_n_name", "seller_n_name")


@query(
    """SELECT p.conv_id, p.role, c.turn AS child_turn, c.role AS child_role, length(c.text) AS n_chars
       FROM conversations p JOIN conversations c ON c.conv_id = p.conv_id AND c.turn > 0
       WHERE p.turn = 0"""
)
def parent_child_group(spark: SparkSession, sf: str) -> DataFrame:
    turns = load(spark, sf, "conversations").select(
        "conv_id",
        "turn",
        "role",
        F.length("text").cast("bigint").alias("n_chars"),
        (F.col("conv_id") * 100 + F.col("turn")).alias("obs_id"),
        F.when(F.col("turn") > 0, F.col("conv_id") * 100).alias("obs_group_id"),
    )
    pairs = attach_children(turns, "obs_id", "obs_group_id")
    return pairs.select("conv_id", "role", "child_turn", "child_role", F.col("child_n_chars").alias("n_chars"))


@query(
    """SELECT l_orderkey, count(*) AS n, string_agg(el, ',' ORDER BY el) AS items
       FROM (SELECT DISTINCT l_orderkey, l_returnflag || '/' || l_linestatus AS el FROM lineitem) GROUP BY 1"""
)
def nest_set(spark: SparkSession, sf: str) -> DataFrame:
    fields = {"flag": "l_returnflag", "status": "l_linestatus"}
    nested = nest_distinct(load(spark, sf, "lineitem"), "l_orderkey", fields)
    text = F.transform("items", lambda x: F.concat_ws("/", x["flag"], x["status"]))
    return nested.select(
        "l_orderkey", F.size("items").cast("bigint").alias("n"), F.array_join(text, ",").alias("items")
    )


@query(
    """SELECT l_orderkey, count(*) AS n, string_agg(l_partkey, ',' ORDER BY l_linenumber, l_partkey) AS items
       FROM lineitem GROUP BY 1"""
)
def nest_list(spark: SparkSession, sf: str) -> DataFrame:
    nested = nest_rows(load(spark, sf, "lineitem"), "l_orderkey", {"part": "l_partkey"}, ["l_linenumber"])
    text = F.transform("items", lambda x: x["part"].cast("string"))
    return nested.select(
        "l_orderkey", F.size("items").cast("bigint").alias("n"), F.array_join(text, ",").alias("items")
    )


@query(
    """SELECT l_orderkey, count(el) AS n, coalesce(string_agg(el, ',' ORDER BY el), '') AS items
       FROM (SELECT DISTINCT l_orderkey, CASE WHEN l_returnflag = 'R' THEN l_suppkey END AS el FROM lineitem) GROUP BY 1"""
)
def nest_conditional(spark: SparkSession, sf: str) -> DataFrame:
    nested = nest_distinct(
        load(spark, sf, "lineitem"), "l_orderkey", {"supplier": "l_suppkey"}, when=F.col("l_returnflag") == "R"
    )
    text = F.transform("items", lambda x: x["supplier"].cast("string"))
    return nested.select(
        "l_orderkey", F.size("items").cast("bigint").alias("n"), F.array_join(text, ",").alias("items")
    )


@query(
    """WITH item AS (
          SELECT l_suppkey, l_orderkey || '/' || l_partkey || '/' || l_returnflag AS item,
                 row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_partkey, l_returnflag) - 1 AS r
          FROM lineitem)
       SELECT l_suppkey, CAST(r // 50 AS INTEGER) AS part, string_agg(item, ',' ORDER BY r) AS items FROM item GROUP BY 1, 2"""
)
def nest_in_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Large groups: arrays of at most fifty elements, in the order of their parts."""
    fields = {"order": "l_orderkey", "part": "l_partkey", "flag": "l_returnflag"}
    parts = nest_rows(load(spark, sf, "lineitem"), "l_suppkey", fields, ["l_shipdate"], part_rows=50)
    text = F.transform("items", lambda x: F.concat_ws("/", x["order"].cast("string"), x["part"].cast("string"), x["flag"]))
    return parts.select("l_suppkey", "part", F.array_join(text, ",").alias("items"))


@query(
    """SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS first_order,
              arg_min(o_orderstatus, (o_orderdate, o_orderkey)) AS first_status
       FROM orders GROUP BY 1"""
)
def group_first(spark: SparkSession, sf: str) -> DataFrame:
    first = pick_first({"first_order": "o_orderkey", "first_status": "o_orderstatus"}, ["o_orderdate", "o_orderkey"])
    orders = load(spark, sf, "orders")
    return orders.groupBy("o_custkey").agg(first.alias("f")).select("o_custkey", "f.*")


@query(
    """SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1"""
)
def group_first_row(spark: SparkSession, sf: str) -> DataFrame:
    return first_row(load(spark, sf, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"])


@query(
    """SELECT user_id, CAST(ts AS DATE) AS day, min(ts) AS ts, arg_min(event_id, (ts, event_id)) AS event_id,
              arg_min(event_type, (ts, event_id)) AS event_type
       FROM events WHERE event_type <> 'error' GROUP BY 1, 2"""
)
def day_dedup(spark: SparkSession, sf: str) -> DataFrame:
    clinical = load(spark, sf, "events").where("event_type <> 'error'")
    return one_per_day(clinical, "ts", ["event_id", "event_type"], by=["user_id"], tiebreak=["event_id"])


@query(
    """SELECT user_id, event_id, ts, value FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 10"""
)
def latest_n(spark: SparkSession, sf: str) -> DataFrame:
    events = load(spark, sf, "events").select("user_id", "event_id", "ts", "value")
    return latest(events, "user_id", "ts", 10, tiebreak="event_id")
