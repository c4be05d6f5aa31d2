"""Filters, joins, set operations, aggregates, top-k and scalar functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from .. import bindings as b
from ..functions import columns as c
from ..operators import aggregates as agg
from ..operators import relational as rel
from . import query
from .fragments import with_invoices
from .invoices import amounts

DAY = "CAST(o_orderdate AS DATE)"


def orders(spark, sf):
    return b.table(spark, sf, "orders")


def lineitem(spark, sf):
    return b.table(spark, sf, "lineitem")


def money(name):
    return F.col(name).cast("decimal(18,2)")


# --- projections and filters -----------------------------------------------------

@query("value_map_with_default", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'FINAL' WHEN 'O' THEN 'OPEN' ELSE 'UNKNOWN' END AS status,
  'ORDERS' AS origin FROM orders""")
def _(spark, sf):
    return orders(spark, sf).select(
        "o_orderkey", c.value_map("o_orderstatus", {"F": "FINAL", "O": "OPEN"}, "UNKNOWN").alias("status"),
        F.lit("ORDERS").alias("origin"))


@query("computed_columns_and_casts", """
SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS quantity,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE) AS net_price,
  CAST(l_linenumber AS VARCHAR) || '/' || l_returnflag AS line_label, upper(l_linestatus) AS linestatus
FROM lineitem""")
def _(spark, sf):
    net = money("l_extendedprice") * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))
    return lineitem(spark, sf).select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").cast("bigint").alias("quantity"),
        net.cast("double").alias("net_price"),
        F.concat(F.col("l_linenumber").cast("string"), F.lit("/"), F.col("l_returnflag")).alias("line_label"),
        F.upper("l_linestatus").alias("linestatus"))


@query("filter_half_open_dates", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_day FROM orders
WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'""")
def _(spark, sf):
    start, end = dt.datetime(1997, 1, 1), dt.datetime(1998, 1, 1)
    inside = (F.col("o_orderdate") >= c.instant(start)) & (
        F.col("o_orderdate") < c.instant(end))
    return orders(spark, sf).where(inside).select("o_orderkey", F.to_date("o_orderdate").alias("order_day"))


@query("filter_between_in_like", """
SELECT p_partkey, p_name, p_type FROM part
WHERE p_size BETWEEN 10 AND 30 AND p_type IN ('ECONOMY', 'SMALL', 'STANDARD')
  AND (p_name ILIKE '%RING%' OR p_brand LIKE 'Brand#1%') AND NOT p_brand = 'Brand#13'""")
def _(spark, sf):
    part = b.table(spark, sf, "part")
    wanted = part.p_name.ilike("%RING%") | part.p_brand.like("Brand#1%")
    return part.where(part.p_size.between(10, 30) & part.p_type.isin("ECONOMY", "SMALL", "STANDARD")
                      & wanted & ~(part.p_brand == "Brand#13")).select("p_partkey", "p_name", "p_type")


@query("null_handling", with_invoices("""
SELECT invoice_id, coalesce(po_number, 'NONE') AS po, po_number IS NULL AS no_po,
  CASE WHEN po_number IS NULL THEN 0 ELSE 1 END AS has_po, nullif(currency_code, 'USD') AS foreign_currency
FROM inv"""))
def _(spark, sf):
    po = F.col("po_number")
    return b.invoices(spark, sf).select(
        "invoice_id", F.coalesce(po, F.lit("NONE")).alias("po"), po.isNull().alias("no_po"),
        F.when(po.isNull(), 0).otherwise(1).alias("has_po"),
        F.nullif(F.col("currency_code"), F.lit("USD")).alias("foreign_currency"))


@query("scalar_subquery", """
SELECT c_custkey, c_name FROM customer
WHERE CAST(c_acctbal AS DECIMAL(18,2)) > (SELECT max(CAST(s_acctbal AS DECIMAL(18,2))) / 2 FROM supplier)""")
def _(spark, sf):
    top = b.table(spark, sf, "supplier").agg(F.max(money("s_acctbal")) / 2).scalar()
    return b.table(spark, sf, "customer").where(money("c_acctbal") > top).select("c_custkey", "c_name")


@query("in_subquery", """
SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""")
def _(spark, sf):
    poor = b.table(spark, sf, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return orders(spark, sf).join(poor, "o_custkey", "left_semi").select("o_orderkey")


@query("exists_correlated", """
SELECT o_orderkey FROM orders o WHERE EXISTS (
  SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_shipdate < o.o_orderdate)""")
def _(spark, sf):
    o, items = orders(spark, sf), lineitem(spark, sf)
    early = (items.l_orderkey == o.o_orderkey) & (items.l_shipdate < o.o_orderdate)
    return o.join(items, early, "left_semi").select("o_orderkey")


@query("not_exists_correlated", """
SELECT o_orderkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""")
def _(spark, sf):
    keys = lineitem(spark, sf).select(F.col("l_orderkey").alias("o_orderkey"))
    return rel.anti(orders(spark, sf), keys, ["o_orderkey"]).select("o_orderkey")


@query("mask_by_role", """
SELECT c_custkey, CAST(0 AS DOUBLE) AS c_acctbal, c_mktsegment FROM customer""")
def _(spark, sf):
    customer = b.table(spark, sf, "customer")
    hidden = c.masked("c_acctbal", "ANALYST", ["ADMIN", "FINANCE"], default=0.0)
    return customer.select("c_custkey", hidden, "c_mktsegment")


@query("drop_columns", "SELECT * EXCLUDE (o_orderpriority, o_totalprice, o_orderdate) FROM orders")
def _(spark, sf):
    return orders(spark, sf).drop("o_orderpriority", "o_totalprice", "o_orderdate")


@query("time_window_filter", """
SELECT event_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 36 HOUR""")
def _(spark, sf):
    since = c.instant(b.EVENTS_AS_OF) - F.expr("INTERVAL 36 HOURS")
    return b.table(spark, sf, "events").where(F.col("ts") >= since).select("event_id", "event_type")


@query("common_table_expression", """
WITH busy AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1), named AS (
  SELECT c_name, n FROM busy JOIN customer ON c_custkey = o_custkey)
SELECT n, count(*) AS customers FROM named GROUP BY 1""")
def _(spark, sf):
    busy = orders(spark, sf).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    named = busy.join(b.table(spark, sf, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    return named.groupBy("n").agg(F.count(F.lit(1)).alias("customers"))


# --- joins -------------------------------------------------------------------------

@query("inner_join", """
SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey""")
def _(spark, sf):
    customer = b.table(spark, sf, "customer")
    o = orders(spark, sf)
    return o.join(customer, o.o_custkey == customer.c_custkey).select("o_orderkey", "c_name")


@query("left_join_keeps_misses", """
SELECT o_orderkey, count(l_linenumber) AS lines FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1""")
def _(spark, sf):
    lines = lineitem(spark, sf).groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("l_linenumber").alias("lines"))
    return orders(spark, sf).select("o_orderkey").join(lines, "o_orderkey", "left").withColumn("lines", F.zeroifnull("lines"))


@query("left_join_not_null", """
SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON o_custkey = c_custkey WHERE o_orderkey IS NOT NULL""")
def _(spark, sf):
    customer, o = b.table(spark, sf, "customer"), orders(spark, sf)
    return customer.join(o, customer.c_custkey == o.o_custkey, "left").where(
        F.col("o_orderkey").isNotNull()).select("c_custkey", "o_orderkey")


@query("right_join", """
SELECT c_custkey, count(o_orderkey) AS orders FROM orders RIGHT JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def _(spark, sf):
    customer, o = b.table(spark, sf, "customer"), orders(spark, sf)
    return o.join(customer, o.o_custkey == customer.c_custkey, "right").groupBy("c_custkey").agg(
        F.count("o_orderkey").alias("orders"))


FULL = """
SELECT coalesce(a.k, b.k) AS k, a.spent, b.balance FROM
  (SELECT o_custkey AS k, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spent FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) a
  FULL JOIN (SELECT c_custkey AS k, c_acctbal AS balance FROM customer WHERE c_acctbal > 5000) b ON a.k = b.k"""


def _spent_and_balance(spark, sf):
    spent = orders(spark, sf).where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("k")).agg(
        F.sum(money("o_totalprice")).cast("double").alias("spent"))
    balance = b.table(spark, sf, "customer").where("c_acctbal > 5000").select(
        F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("balance"))
    return spent, balance


@query("full_outer_join", FULL)
def _(spark, sf):
    spent, balance = _spent_and_balance(spark, sf)
    return spent.join(balance, "k", "full")


@query("full_outer_as_union", FULL)
def _(spark, sf):
    return rel.full_outer_as_union(*_spent_and_balance(spark, sf), ["k"])


@query("natural_join", """
SELECT n_nationkey, n_name, suppliers FROM nation NATURAL JOIN
  (SELECT s_nationkey AS n_nationkey, count(*) AS suppliers FROM supplier GROUP BY 1)""")
def _(spark, sf):
    counted = b.table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(
        F.count(F.lit(1)).alias("suppliers"))
    return rel.natural_join(b.table(spark, sf, "nation"), counted).select("n_nationkey", "n_name", "suppliers")


@query("composite_key_join", """
SELECT a.l_orderkey, a.l_linenumber, a.l_partkey, p_name FROM lineitem a
JOIN (SELECT l_orderkey, l_linenumber, max(l_shipdate) AS last_ship FROM lineitem GROUP BY 1, 2) z
  ON a.l_orderkey = z.l_orderkey AND a.l_linenumber = z.l_linenumber AND a.l_shipdate = z.last_ship
JOIN part ON p_partkey = a.l_partkey""")
def _(spark, sf):
    items = lineitem(spark, sf)
    last = items.groupBy("l_orderkey", "l_linenumber").agg(F.max("l_shipdate").alias("l_shipdate"))
    part = b.table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    return items.join(last, ["l_orderkey", "l_linenumber", "l_shipdate"]).join(part, "l_partkey").select(
        "l_orderkey", "l_linenumber", "l_partkey", "p_name")


@query("window_from_newest_date", """
SELECT event_id, event_type FROM events WHERE CAST(ts AS DATE) >= (SELECT max(CAST(ts AS DATE)) - 7 FROM events)""")
def _(spark, sf):
    events = b.table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    return rel.recent(events, "day", 7).select("event_id", "event_type")


@query("outer_join_with_inequality", """
SELECT c_custkey, CAST(s.best AS DOUBLE) AS best_supplier_balance FROM customer LEFT JOIN
  (SELECT s_nationkey, max(CAST(s_acctbal AS DECIMAL(18,2))) AS best FROM supplier GROUP BY 1) s
  ON c_nationkey = s_nationkey AND CAST(c_acctbal AS DECIMAL(18,2)) > s.best""")
def _(spark, sf):
    best = b.table(spark, sf, "supplier").groupBy("s_nationkey").agg(F.max(money("s_acctbal")).alias("best"))
    customer = b.table(spark, sf, "customer")
    beats = (customer.c_nationkey == best.s_nationkey) & (money("c_acctbal") > best.best)
    return customer.join(best, beats, "left").select(
        "c_custkey", F.col("best").cast("double").alias("best_supplier_balance"))


@query("array_membership_semi_join", """
WITH wanted AS (SELECT DISTINCT unnest(string_split('1-URGENT,2-HIGH', ',')) AS p)
SELECT o_orderkey FROM orders WHERE o_orderpriority IN (SELECT p FROM wanted)""")
def _(spark, sf):
    # which names to look for arrives as an array column, one row per request
    request = b.table(spark, sf, "orders").select(
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.array("o_orderpriority")).alias("names"))
    names = request.select(F.explode("names").alias("o_orderpriority")).distinct()
    return orders(spark, sf).join(names, "o_orderpriority", "left_semi").select("o_orderkey")


# --- aggregates --------------------------------------------------------------------

@query("aggregate_overview", """
SELECT l_returnflag, l_linestatus, count(*) AS lines, count(DISTINCT l_orderkey) AS orders,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS average,
  min(l_extendedprice) AS low, max(l_extendedprice) AS high,
  CAST(sum(CASE WHEN l_discount > 0.05 THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS discounted,
  count(*) FILTER (WHERE l_quantity > 25) AS large_lines
FROM lineitem GROUP BY 1, 2""")
def _(spark, sf):
    price = money("l_extendedprice")
    return lineitem(spark, sf).groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("lines"), F.countDistinct("l_orderkey").alias("orders"),
        F.sum(price).cast("double").alias("total"),
        (F.sum(price).cast("double") / F.count(F.lit(1))).alias("average"),
        F.min("l_extendedprice").alias("low"), F.max("l_extendedprice").alias("high"),
        c.sum_where(F.col("l_discount") > 0.05, price).cast("double").alias("discounted"),
        F.count_if(F.col("l_quantity") > 25).alias("large_lines"))


@query("conditional_average_and_max", """
SELECT user_id, avg(CASE WHEN event_type = 'purchase' THEN CAST(floor(value) AS BIGINT) END) AS avg_purchase,
  max(CASE WHEN event_type <> 'error' THEN value END) AS max_good FROM events GROUP BY 1""")
def _(spark, sf):
    kind, value = F.col("event_type"), F.col("value")
    return b.table(spark, sf, "events").groupBy("user_id").agg(
        F.avg(F.when(kind == "purchase", F.floor(value))).alias("avg_purchase"),
        F.max(F.when(kind != "error", value)).alias("max_good"))


@query("percentile_ignoring_nulls", """
SELECT event_type, quantile_cont(CASE WHEN user_id > 10 THEN CAST(floor(value) AS BIGINT) END, 0.95) AS p95,
  quantile_cont(CASE WHEN user_id > 10 THEN CAST(floor(value) AS BIGINT) END, 0.5) AS p50
FROM events GROUP BY 1""")
def _(spark, sf):
    value = F.when(F.col("user_id") > 10, F.floor("value"))
    return agg.percentiles(b.table(spark, sf, "events"), ["event_type"], value, {"p95": 0.95, "p50": 0.5})


@query("array_agg_distinct", """
SELECT o_custkey, list_aggregate(list_sort(list(DISTINCT o_orderpriority)), 'string_agg', '|') AS priorities
FROM orders GROUP BY 1""")
def _(spark, sf):
    arrays = agg.distinct_values(orders(spark, sf), ["o_custkey"], "o_orderpriority", "priorities")
    return arrays.withColumn("priorities", F.array_join("priorities", "|"))


@query("array_union_size", """
SELECT user_id, count(DISTINCT event_type) AS kinds FROM events GROUP BY 1""")
def _(spark, sf):
    daily = b.table(spark, sf, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.collect_set("event_type").alias("kinds_of_day"))
    return agg.distinct_elements(daily, ["user_id"], "kinds_of_day", "kinds")


@query("listagg_names", """
SELECT n_regionkey, string_agg(n_name, ', ' ORDER BY n_name) AS nations FROM nation GROUP BY 1""")
def _(spark, sf):
    names = F.expr("listagg(n_name, ', ') WITHIN GROUP (ORDER BY n_name)")
    return b.table(spark, sf, "nation").groupBy("n_regionkey").agg(names.alias("nations"))


@query("first_names_text", """
SELECT string_agg(c_name, ', ' ORDER BY c_name) AS names FROM
  (SELECT c_name FROM customer ORDER BY c_name LIMIT 10)""")
def _(spark, sf):
    return agg.first_names(b.table(spark, sf, "customer"), "c_name", 10)


@query("having_and_aliases", """
SELECT o_custkey, year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY 1, 2 HAVING count(*) >= 4""")
def _(spark, sf):
    return orders(spark, sf).groupBy("o_custkey", F.year("o_orderdate").cast("bigint").alias("y")).agg(
        F.count(F.lit(1)).alias("n")).where("n >= 4")


@query("time_buckets", """
SELECT date_trunc('hour', ts) AS hour, CAST(date_trunc('month', ts) AS DATE) AS month, event_type, count(*) AS n
FROM events GROUP BY ALL""")
def _(spark, sf):
    return b.table(spark, sf, "events").groupBy(
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"),
        F.trunc(F.to_date("ts"), "MM").alias("month"), "event_type").agg(F.count(F.lit(1)).alias("n"))


@query("distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def _(spark, sf):
    return lineitem(spark, sf).select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


ROLLED = "CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total, count(*) AS n, grouping(o_orderstatus) AS all_status, grouping(o_orderpriority) AS all_priority"


def _rolled(grouped):
    return grouped.agg(
        F.sum(money("o_totalprice")).cast("double").alias("total"), F.count(F.lit(1)).alias("n"),
        F.grouping("o_orderstatus").cast("bigint").alias("all_status"),
        F.grouping("o_orderpriority").cast("bigint").alias("all_priority"))


@query("rollup_totals", f"""
SELECT o_orderstatus, o_orderpriority, {ROLLED} FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)""")
def _(spark, sf):
    return _rolled(orders(spark, sf).rollup("o_orderstatus", "o_orderpriority"))


@query("cube_totals", f"""
SELECT o_orderstatus, o_orderpriority, {ROLLED} FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)""")
def _(spark, sf):
    return _rolled(orders(spark, sf).cube("o_orderstatus", "o_orderpriority"))


@query("grouping_sets_totals", f"""
SELECT o_orderstatus, o_orderpriority, {ROLLED} FROM orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())""")
def _(spark, sf):
    sets = [[F.col("o_orderstatus")], [F.col("o_orderpriority")], []]
    return _rolled(orders(spark, sf).groupingSets(sets, "o_orderstatus", "o_orderpriority"))


@query("two_stage_rollup", """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS rows,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(o_totalprice) AS average,
  count(DISTINCT o_custkey) AS distinct_o_custkey FROM orders GROUP BY 1""")
def _(spark, sf):
    df = orders(spark, sf).select("o_custkey", F.to_date("o_orderdate").alias("day"), money("o_totalprice").alias("price"))
    _, monthly = agg.two_stage(df, {"day": F.col("day")}, {"month": F.trunc("day", "MM")}, "price", distinct="o_custkey")
    return amounts(monthly, "total")


@query("collapse_duplicates", """
SELECT l_orderkey, l_linenumber, CAST(max(l_shipdate) AS DATE) AS last_ship, sum(l_quantity) AS quantity
FROM lineitem GROUP BY 1, 2""")
def _(spark, sf):
    return lineitem(spark, sf).groupBy("l_orderkey", "l_linenumber").agg(
        F.to_date(F.max("l_shipdate")).alias("last_ship"), F.sum("l_quantity").alias("quantity"))


@query("zero_filled_daily_series", f"""
SELECT CAST(d AS DATE) AS day, coalesce(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE), 0) AS daily_total
FROM generate_series(DATE '1997-02-01', DATE '1997-02-28', INTERVAL 1 DAY) g(d)
LEFT JOIN (SELECT * FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_nationkey = 7) o ON {DAY} = d GROUP BY 1""")
def _(spark, sf):
    facts = orders(spark, sf).join(b.table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    facts = facts.select("o_orderdate", "c_nationkey", money("o_totalprice").alias("price"))
    df = agg.zero_filled_daily(facts, "o_orderdate", "price", dt.date(1997, 2, 1), dt.date(1997, 2, 28),
                               where=F.col("c_nationkey") == 7)
    return amounts(df, "daily_total")


# --- sets, sort, top-k ---------------------------------------------------------------

@query("union_distinct", """
SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier""")
def _(spark, sf):
    return b.table(spark, sf, "customer").select(F.col("c_nationkey").alias("nation")).union(
        b.table(spark, sf, "supplier").select("s_nationkey")).distinct()


@query("except_rows", """
SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem""")
def _(spark, sf):
    return orders(spark, sf).select("o_orderkey").subtract(lineitem(spark, sf).select("l_orderkey"))


@query("intersect_rows", """
SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'P' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'""")
def _(spark, sf):
    o = orders(spark, sf)
    return o.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("k")).intersect(
        o.where("o_orderstatus = 'F'").select("o_custkey"))


@query("table_difference", """
WITH a AS (SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag <> 'N'),
     z AS (SELECT l_partkey, l_suppkey FROM lineitem WHERE l_linestatus = 'F')
SELECT l_partkey, l_suppkey, CASE WHEN n > 0 THEN 'only_left' ELSE 'only_right' END AS side, CAST(abs(n) AS BIGINT) AS copies FROM (
  SELECT l_partkey, l_suppkey, sum(s) AS n FROM (SELECT *, 1 AS s FROM a UNION ALL SELECT *, -1 FROM z) GROUP BY 1, 2) WHERE n <> 0""")
def _(spark, sf):
    items = lineitem(spark, sf)
    return rel.table_diff(items.where("l_returnflag <> 'N'").select("l_partkey", "l_suppkey"),
                          items.where("l_linestatus = 'F'").select("l_partkey", "l_suppkey"))


@query("top_customers", """
SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spent FROM orders
GROUP BY 1 ORDER BY spent DESC, o_custkey LIMIT 20""")
def _(spark, sf):
    spent = orders(spark, sf).groupBy("o_custkey").agg(F.sum(money("o_totalprice")).alias("spent"))
    return amounts(spent.orderBy(F.col("spent").desc(), "o_custkey").limit(20), "spent")


@query("latest_single_row", """
SELECT event_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 1""")
def _(spark, sf):
    newest = F.max_by(F.struct("event_id", "event_type"), F.struct("ts", "event_id")).alias("r")
    return b.table(spark, sf, "events").agg(newest).select("r.event_id", "r.event_type")


@query("preview_limit", "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 10")
def _(spark, sf):
    return b.table(spark, sf, "customer").select("c_custkey", "c_name").orderBy("c_custkey").limit(10)


# --- scalar functions ------------------------------------------------------------------

@query("date_functions", """
SELECT event_id, CAST(ts AS DATE) AS day, CAST(date_trunc('month', ts) AS DATE) AS month_start,
  strftime(ts, '%Y-%m') AS yyyy_mm, year(ts) AS y, month(ts) AS m, CAST(ts AS DATE) + 30 AS due,
  CAST(date_diff('second', date_trunc('second', ts), TIMESTAMP '2024-01-31 00:00:00') AS BIGINT) AS age_seconds,
  CAST(ts AS DATE) - DATE '1970-01-01' AS epoch_day
FROM events""")
def _(spark, sf):
    ts = F.col("ts")
    day = F.to_date(ts)
    return b.table(spark, sf, "events").select(
        "event_id", F.date_from_unix_date(F.unix_date(day)).alias("day"), F.trunc(day, "MM").alias("month_start"),
        F.date_format(ts, "yyyy-MM").alias("yyyy_mm"), F.year(ts).cast("bigint").alias("y"),
        F.month(ts).cast("bigint").alias("m"), F.date_add(day, 30).alias("due"),
        c.seconds_between(ts, c.instant(b.EVENTS_AS_OF)).alias("age_seconds"),
        F.unix_date(day).cast("bigint").alias("epoch_day"))


@query("time_zone_conversion", """
SELECT event_id, (ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Amsterdam' AS local_ts FROM events""")
def _(spark, sf):
    return b.table(spark, sf, "events").select(
        "event_id", F.convert_timezone(F.lit("UTC"), F.lit("Europe/Amsterdam"), F.col("ts")).alias("local_ts"))


@query("text_functions", r"""
SELECT doc_id, regexp_matches(text, '[0-9]') AS has_digit, contains(lower(text), 'the') AS has_the,
  regexp_matches(lower(text), 'jan|feb|mar') AS has_month, regexp_extract(text, '[0-9]{4}-[0-9]{2}') AS first_month,
  length(replace(source, '''', '''''')) AS n, upper(lang) AS lang FROM documents""")
def _(spark, sf):
    text = F.col("text")
    return b.table(spark, sf, "documents").select(
        "doc_id", text.rlike("[0-9]").alias("has_digit"), F.lower(text).contains("the").alias("has_the"),
        F.lower(text).rlike("jan|feb|mar").alias("has_month"),
        F.regexp_extract(text, "[0-9]{4}-[0-9]{2}", 0).alias("first_month"),
        F.length(c.escape_quotes("source")).cast("bigint").alias("n"), F.upper("lang").alias("lang"))


@query("result_as_text", """
SELECT c_mktsegment || ', ' || CASE WHEN c_acctbal < 0 THEN 'None' ELSE CAST(c_nationkey AS VARCHAR) END AS line, count(*) AS n
FROM customer GROUP BY 1""")
def _(spark, sf):
    rows = b.table(spark, sf, "customer").withColumn("nation", F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey")))
    return rows.groupBy(c.row_text("c_mktsegment", "nation").alias("line")).agg(F.count(F.lit(1)).alias("n"))


@query("round_and_units", """
SELECT p_partkey, round(p_retailprice / 7, 2) AS seventh,
  CAST(CAST((CAST(p_size AS DECIMAL(20,4)) - 32) * 5 / 9 AS DECIMAL(35,4)) AS DOUBLE) AS celsius,
  CAST(CAST(CAST(p_size AS DECIMAL(20,4)) * 25.4 AS DECIMAL(35,4)) AS DOUBLE) AS millimeters FROM part""")
def _(spark, sf):
    return b.table(spark, sf, "part").select(
        "p_partkey", F.round(F.col("p_retailprice") / 7, 2).alias("seventh"),
        c.fahrenheit_to_celsius("p_size").cast("double").alias("celsius"),
        c.inch_to_millimeter("p_size").cast("double").alias("millimeters"))


# --- reshaping ---------------------------------------------------------------------------

@query("pivot_status", """
SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS F, count(*) FILTER (WHERE o_orderstatus = 'O') AS O,
  count(*) FILTER (WHERE o_orderstatus = 'P') AS P FROM orders GROUP BY 1""")
def _(spark, sf):
    return orders(spark, sf).groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).count()


@query("sample_rows", """
SELECT l_orderkey, l_linenumber FROM lineitem
WHERE substr(md5(CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)), 1, 3) < '19a'""")
def _(spark, sf):
    # a tenth of the rows, the same ones in every run: the first digits of a hash of the key
    key = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    return lineitem(spark, sf).where(F.substr(F.md5(key), F.lit(1), F.lit(3)) < "19a").select("l_orderkey", "l_linenumber")
