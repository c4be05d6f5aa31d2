"""Window functions, written for keys of any size."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import bindings as b
from ..operators import windows as w
from . import query

NEWEST = "l_shipdate DESC, l_extendedprice DESC, l_partkey, l_suppkey, l_quantity, l_discount, l_tax"


def lineitem(spark, sf):
    return b.table(spark, sf, "lineitem")


def newest():
    return [F.col("l_shipdate").desc(), F.col("l_extendedprice").desc(), F.col("l_partkey"), F.col("l_suppkey"),
            F.col("l_quantity"), F.col("l_discount"), F.col("l_tax")]


@query("keep_latest_per_key", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {NEWEST}) = 1""")
def _(spark, sf):
    return w.keep_latest(lineitem(spark, sf), ["l_orderkey", "l_linenumber"], newest()).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


@query("keep_first_per_key", """
SELECT o_custkey, o_orderkey FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1""")
def _(spark, sf):
    return w.keep_latest(b.table(spark, sf, "orders"), ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")]).select(
        "o_custkey", "o_orderkey")


@query("keep_by_priority_then_latest", """
SELECT o_custkey, o_orderkey FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, o_orderdate DESC, o_orderkey) = 1""")
def _(spark, sf):
    order = [F.col("o_orderpriority"), F.col("o_orderdate").desc(), F.col("o_orderkey")]
    return w.keep_latest(b.table(spark, sf, "orders"), ["o_custkey"], order).select("o_custkey", "o_orderkey")


@query("top_three_per_supplier", f"""
SELECT l_suppkey, l_orderkey, l_linenumber, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, {NEWEST}) <= 3""")
def _(spark, sf):
    order = [F.col("l_extendedprice").desc(), F.col("l_orderkey"), F.col("l_linenumber"), *newest()]
    return w.top_per_key(lineitem(spark, sf), ["l_suppkey"], order, 3).select(
        "l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice")


@query("lead_and_lag", """
SELECT event_id, user_id, lag(value) OVER u AS previous_value, lead(event_id) OVER u AS next_event FROM events
WINDOW u AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def _(spark, sf):
    events = b.table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    return w.ordered_windows(events, ["user_id"], ["ts", "event_id"], previous={"previous_value": "value"},
                             following={"next_event": "event_id"}).drop("ts", "value")


@query("row_number_column", """
SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS row_number FROM events""")
def _(spark, sf):
    events = b.table(spark, sf, "events").select("event_id", "user_id", "ts")
    return w.row_numbers(events, ["user_id"], ["ts", "event_id"]).drop("ts")


@query("global_row_number", """
SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS place FROM customer""")
def _(spark, sf):
    customer = b.table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return w.row_numbers(customer, [], [F.col("c_acctbal").desc(), F.col("c_custkey")], "place").drop("c_acctbal")


@query("rank_with_ties", """
SELECT l_orderkey, l_linenumber, l_quantity, l_suppkey, rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC) AS rank FROM lineitem""")
def _(spark, sf):
    items = lineitem(spark, sf).select("l_orderkey", "l_linenumber", "l_quantity", "l_suppkey")
    return w.ranks(items, ["l_suppkey"], "l_quantity")


@query("running_total", """
SELECT o_orderkey, o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (
  PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS spent_so_far FROM orders""")
def _(spark, sf):
    orders = b.table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    df = w.ordered_windows(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], totals={"spent_so_far": "price"})
    return df.select("o_orderkey", "o_custkey", F.col("spent_so_far").cast("double"))
