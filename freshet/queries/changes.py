"""Change sets, MERGE, incremental maintenance and maintained tables.  Each
maintenance query starts from the old state, applies the change set, and is
compared with the result computed from the new table alone."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import bindings as b
from ..operators import bitmaps as bm
from ..operators import changes as ch
from ..operators import incremental as inc
from ..operators import merge as mg
from ..operators import segments as sg
from ..plans.keyed_files import KeyedFiles
from ..plans.refresh import Maintained, MaintainedTables
from ..session import scratch_path
from ..streaming import versions as sv
from ..streaming.buckets import BucketedTable
from . import query
from .invoices import amounts

VERSIONS = """
base AS (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS day,
           CAST(o_totalprice AS DECIMAL(18,2)) AS price, o_orderpriority FROM orders),
before AS (SELECT * FROM base WHERE day < DATE '2001-01-01'),
after AS (SELECT o_orderkey, o_custkey,
            CASE WHEN o_orderstatus = 'P' AND year(day) = 2000 THEN 'F' ELSE o_orderstatus END AS o_orderstatus, day,
            CAST(price + CASE WHEN o_orderstatus = 'P' AND year(day) = 2000 THEN 100 ELSE 0 END AS DECIMAL(18,2)) AS price,
            o_orderpriority FROM base WHERE day >= DATE '1995-07-01'),
cust_after AS (SELECT c_custkey AS o_custkey, c_name, c_nationkey FROM customer WHERE c_acctbal > 0),
changed AS (
  SELECT a.*, 'INSERT' AS _action, z.o_orderkey IS NOT NULL AS _is_update FROM after a LEFT JOIN before z USING (o_orderkey)
  WHERE z.o_orderkey IS NULL OR z.price <> a.price OR z.o_orderstatus <> a.o_orderstatus
  UNION ALL
  SELECT z.*, 'DELETE', a.o_orderkey IS NOT NULL FROM before z LEFT JOIN after a USING (o_orderkey)
  WHERE a.o_orderkey IS NULL OR z.price <> a.price OR z.o_orderstatus <> a.o_orderstatus)"""
KEY = ["o_orderkey"]


def versions(body: str) -> str:
    return f"WITH {VERSIONS.strip()}\n{body.strip()}"


def before_after(spark, sf):
    return b.orders_before(spark, sf), b.orders_after(spark, sf)


def delta(spark, sf):
    return ch.changes(*before_after(spark, sf), KEY)


# --- change sets ---------------------------------------------------------------

@query("change_set", versions(
    "SELECT o_orderkey, o_orderstatus, day, CAST(price AS DOUBLE) AS price, _action, _is_update FROM changed"))
def _(spark, sf):
    return amounts(delta(spark, sf).select("o_orderkey", "o_orderstatus", "day", "price", "_action", "_is_update"), "price")


@query("change_set_without_keys", """
WITH o AS (SELECT l_partkey, l_returnflag, count(*) AS n FROM lineitem WHERE l_shipdate < TIMESTAMP '2000-01-01' GROUP BY 1, 2),
n AS (SELECT l_partkey, l_returnflag, count(*) AS n FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-01-01' GROUP BY 1, 2),
d AS (SELECT l_partkey, l_returnflag, coalesce(n.n, 0) - coalesce(o.n, 0) AS n FROM o FULL JOIN n USING (l_partkey, l_returnflag))
SELECT l_partkey, l_returnflag, CASE WHEN n > 0 THEN 'INSERT' ELSE 'DELETE' END AS _action, abs(n) AS _copies FROM d WHERE n <> 0""")
def _(spark, sf):
    items = b.table(spark, sf, "lineitem")
    old = items.where("l_shipdate < TIMESTAMP_NTZ '2000-01-01'").select("l_partkey", "l_returnflag")
    new = items.where("l_shipdate >= TIMESTAMP_NTZ '1996-01-01'").select("l_partkey", "l_returnflag")
    return ch.changes(old, new).drop("_is_update")


@query("change_set_append_only", versions(
    "SELECT o_orderkey, day FROM after WHERE o_orderkey NOT IN (SELECT o_orderkey FROM before)"))
def _(spark, sf):
    return ch.changes(*before_after(spark, sf), KEY, append_only=True).select("o_orderkey", "day")


@query("net_change_log", versions("SELECT o_orderkey, CAST(price AS DOUBLE) AS price, _action, _is_update FROM changed"))
def _(spark, sf):
    # every old row deleted, every new row inserted: unchanged rows cancel out
    old, new = before_after(spark, sf)
    log = old.withColumns({"_action": F.lit("DELETE"), "_is_update": F.lit(False), "_copies": F.lit(1)}).unionByName(
        new.withColumns({"_action": F.lit("INSERT"), "_is_update": F.lit(False), "_copies": F.lit(1)}))
    return amounts(ch.net_changes(log, KEY).select("o_orderkey", "price", "_action", "_is_update"), "price")


@query("deletions_log", versions("SELECT o_orderkey, o_custkey, day FROM changed WHERE _action = 'DELETE' AND NOT _is_update"))
def _(spark, sf):
    return ch.true_deletes(delta(spark, sf)).select("o_orderkey", "o_custkey", "day")


@query("audit_log", versions("""
SELECT o_orderkey, _action, 1 AS version FROM (SELECT *, 'INSERT' AS _action FROM before)
UNION ALL SELECT o_orderkey, _action, 2 FROM changed""").replace("1 AS version", "CAST(1 AS BIGINT) AS version"))
def _(spark, sf):
    old, _ = before_after(spark, sf)
    first = old.withColumns({"_action": F.lit("INSERT"), "_is_update": F.lit(False), "_copies": F.lit(1).cast("bigint")})
    log = ch.audit_rows(first, 1).unionByName(ch.audit_rows(delta(spark, sf), 2))
    return log.select("o_orderkey", "_action", F.col("_version").alias("version"))


@query("apply_change_set", versions("SELECT o_orderkey, o_orderstatus, CAST(price AS DOUBLE) AS price FROM after"))
def _(spark, sf):
    state = ch.apply_changes(b.orders_before(spark, sf), delta(spark, sf), KEY)
    return amounts(state.select("o_orderkey", "o_orderstatus", "price"), "price")


# --- MERGE ------------------------------------------------------------------------

@query("merge_clauses", versions("""
SELECT z.o_orderkey, CASE WHEN a.day < DATE '1998-01-01' THEN 'OLD' ELSE z.o_orderstatus END AS o_orderstatus,
  CAST(CASE WHEN a.day < DATE '1998-01-01' THEN z.price WHEN a.o_orderstatus = 'F' THEN a.price ELSE z.price END AS DOUBLE) AS price
FROM before z LEFT JOIN after a USING (o_orderkey)
WHERE NOT coalesce(a.day >= DATE '1998-01-01' AND a.o_orderstatus = 'O', false)
UNION ALL
SELECT o_orderkey, 'NEW', CAST(price AS DOUBLE) FROM after
WHERE o_orderkey NOT IN (SELECT o_orderkey FROM before) AND o_orderpriority <> '5-LOW'"""))
def _(spark, sf):
    old, new = before_after(spark, sf)
    result = mg.merge(old, new, KEY, [
        mg.Matched(condition="s.day < DATE '1998-01-01'", update={"o_orderstatus": "'OLD'"}),
        mg.Matched(condition="s.o_orderstatus = 'O'", delete=True),
        mg.Matched(condition="s.o_orderstatus = 'F'", update={"price": "s.price"}),
        mg.NotMatched(condition="s.o_orderpriority <> '5-LOW'", insert={
            "o_orderkey": "s.o_orderkey", "o_orderstatus": "'NEW'", "price": "s.price"}),
    ])
    return amounts(result.select("o_orderkey", "o_orderstatus", "price"), "price")


@query("merge_newest_wins", """
SELECT user_id, event_id, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def _(spark, sf):
    events = b.table(spark, sf, "events").select("user_id", "event_id", "event_type", "ts")
    order = [F.col("ts").desc(), F.col("event_id").desc()]
    from ..operators.windows import keep_latest

    target = keep_latest(events.where("ts < TIMESTAMP_NTZ '2024-01-15'"), ["user_id"], order)
    source = events.where("ts >= TIMESTAMP_NTZ '2024-01-10'")
    merged = mg.upsert_newest(target, source, ["user_id"], "ts", [F.col("event_id").desc()])
    return merged.select("user_id", "event_id", "event_type")


@query("insert_window_without_duplicates", """
SELECT event_id, event_type FROM events WHERE ts < TIMESTAMP '2024-01-10' OR ts >= TIMESTAMP '2024-01-09'""")
def _(spark, sf):
    events = b.table(spark, sf, "events").select("event_id", "event_type", "ts")
    state = events.where("ts < TIMESTAMP_NTZ '2024-01-10'")
    since = F.lit("2024-01-09").cast("timestamp_ntz")
    return mg.insert_new_window(state, events, "ts", since, ["event_id"]).drop("ts")


@query("add_column_without_rebuild", versions("""
SELECT o_orderkey, NULL::VARCHAR AS channel FROM before WHERE o_orderkey NOT IN (SELECT o_orderkey FROM after)
UNION ALL SELECT a.o_orderkey, CASE WHEN z.o_orderkey IS NULL THEN 'web' END FROM after a LEFT JOIN before z USING (o_orderkey)"""))
def _(spark, sf):
    old, new = before_after(spark, sf)
    state = mg.add_column(old.select("o_orderkey"), "channel", "string")
    source = new.select("o_orderkey", F.lit("web").alias("channel"))
    return mg.merge(state, source, KEY, [mg.NotMatched(insert={"o_orderkey": "s.o_orderkey", "channel": "s.channel"})])


# --- incremental maintenance ----------------------------------------------------------

@query("maintain_filter", versions(
    "SELECT o_orderkey, CAST(price AS DOUBLE) AS price FROM after WHERE o_orderstatus = 'F' AND price > 100000"))
def _(spark, sf):
    wanted = (F.col("o_orderstatus") == "F") & (F.col("price") > 100000)
    state = b.orders_before(spark, sf).where(wanted).select("o_orderkey", "price")
    moved = inc.delta_select(delta(spark, sf), wanted, ["o_orderkey", "price"])
    return amounts(ch.apply_changes(state, moved, KEY), "price")


@query("maintain_union", versions("""
SELECT o_orderkey, 'open' AS side FROM after WHERE o_orderstatus = 'O' UNION ALL SELECT o_orderkey, 'final' FROM after WHERE o_orderstatus = 'F'"""))
def _(spark, sf):
    old = b.orders_before(spark, sf)
    moved = delta(spark, sf)

    def side(df, status, name):
        return df.where(F.col("o_orderstatus") == status).withColumn("side", F.lit(name))

    state = side(old, "O", "open").unionByName(side(old, "F", "final")).select("o_orderkey", "side")
    parts = [inc.delta_select(side(moved, s, n), None, ["o_orderkey", "side"]) for s, n in [("O", "open"), ("F", "final")]]
    return ch.apply_to_bag(ch.as_bag(state), inc.delta_union(*parts)).drop("_copies")


@query("maintain_inner_join", versions("""
SELECT o_orderkey, o_custkey, c_name, CAST(price AS DOUBLE) AS price FROM after JOIN cust_after USING (o_custkey)"""))
def _(spark, sf):
    pick = ["o_orderkey", "o_custkey", "price"]
    old, new = (df.select(*pick) for df in before_after(spark, sf))
    a, z = b.customers_before(spark, sf).drop("c_nationkey"), b.customers_after(spark, sf).drop("c_nationkey")
    moved = inc.delta_join(old, a, ch.changes(old, new, KEY), ch.changes(a, z, ["o_custkey"]), ["o_custkey"])
    state = ch.as_bag(old.join(a, "o_custkey"))
    return amounts(ch.apply_to_bag(state, moved).drop("_copies"), "price")


@query("maintain_outer_join", versions("""
SELECT o_custkey, c_name, o_orderkey, CAST(price AS DOUBLE) AS price FROM cust_after LEFT JOIN after USING (o_custkey)"""))
def _(spark, sf):
    pick = ["o_custkey", "o_orderkey", "price"]
    old, new = (df.select(*pick) for df in before_after(spark, sf))
    a, z = b.customers_before(spark, sf).drop("c_nationkey"), b.customers_after(spark, sf).drop("c_nationkey")
    state = a.join(old, "o_custkey", "left")
    result = inc.delta_outer_join(state, z, new, ch.changes(a, z, ["o_custkey"]), ch.changes(old, new, KEY), ["o_custkey"])
    return amounts(result, "price")


@query("maintain_sum_count_avg", versions("""
SELECT o_custkey, count(*) AS row_count, CAST(sum(price) AS DOUBLE) AS sum_price,
  CAST(sum(price) AS DOUBLE) / count(price) AS avg_price FROM after GROUP BY 1"""))
def _(spark, sf):
    state = inc.agg_state(b.orders_before(spark, sf), ["o_custkey"], ["price"])
    state = inc.delta_agg(state, delta(spark, sf), ["o_custkey"], ["price"])
    return amounts(inc.agg_result(state, ["o_custkey"], ["price"]), "sum_price")


@query("maintain_min_max", versions("""
SELECT o_custkey, CAST(min(price) AS DOUBLE) AS low, CAST(max(price) AS DOUBLE) AS high FROM after GROUP BY 1"""))
def _(spark, sf):
    old, new = before_after(spark, sf)
    state = inc.minmax_state(old, ["o_custkey"], "price")
    return amounts(inc.delta_minmax(state, delta(spark, sf), new, ["o_custkey"], "price").drop("row_count"), "low", "high")


NULLED = "CASE WHEN price < 100000 THEN price END"


@query("maintain_min_max_with_nulls", versions(f"""
SELECT o_custkey, CAST(min({NULLED}) AS DOUBLE) AS low, CAST(max({NULLED}) AS DOUBLE) AS high
FROM after WHERE o_custkey % 5 <> 0 GROUP BY 1"""))
def _(spark, sf):
    def cheap(df):
        return df.withColumn("price", F.expr(NULLED))

    old, new = (cheap(df) for df in before_after(spark, sf))
    new = new.where("o_custkey % 5 <> 0")  # whole groups go
    gone = ch.changes(old, new, ["o_orderkey"])
    state = inc.delta_minmax(inc.minmax_state(old, ["o_custkey"], "price"), gone, new, ["o_custkey"], "price")
    return amounts(state.drop("row_count"), "low", "high")


@query("maintain_distinct", versions("SELECT DISTINCT o_custkey, o_orderstatus FROM after"))
def _(spark, sf):
    old, new = (df.select("o_custkey", "o_orderstatus") for df in before_after(spark, sf))
    return inc.delta_distinct(ch.as_bag(old), ch.changes(old, new)).drop("_copies")


@query("maintain_distinct_count", versions("""
SELECT o_orderstatus, year(day) AS year, count(DISTINCT o_custkey) AS customers FROM after GROUP BY 1, 2
UNION ALL SELECT o_orderstatus, NULL, count(DISTINCT o_custkey) FROM after GROUP BY 1""").replace("year(day) AS year", "CAST(year(day) AS INTEGER) AS year"))
def _(spark, sf):
    # years from the state, all years from the bitmaps of the years
    keys, whole = ["o_orderstatus", "year"], ["o_orderstatus"]
    old, new = (df.select("o_orderstatus", F.year("day").alias("year"), "o_custkey") for df in before_after(spark, sf))
    change_set = ch.changes(old, new)
    counts = bm.delta_row_counts(bm.row_counts(old, keys, "o_custkey"), change_set, keys, "o_custkey")
    state = bm.delta_bitmaps(bm.bitmaps(old, keys, "o_custkey"), change_set, keys, "o_custkey", counts)
    years = bm.distinct_counts(state, keys, "customers")
    both = bm.distinct_counts(bm.rolled_up(state, whole), whole, "customers").withColumn("year", F.lit(None).cast("int"))
    return years.unionByName(both)


@query("maintain_window", versions("""
SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY price DESC, o_orderkey) AS place FROM after"""))
def _(spark, sf):
    from ..operators.windows import row_numbers

    def place(df):
        return row_numbers(df.select("o_custkey", "o_orderkey", "price"), ["o_custkey"],
                           [F.col("price").desc(), F.col("o_orderkey")], "place").drop("price")

    old, new = before_after(spark, sf)
    return inc.delta_window(place(old), new, delta(spark, sf), ["o_custkey"], place)


@query("maintain_running_total", versions("""
SELECT o_orderstatus, o_orderkey, CAST(sum(price) OVER w AS DOUBLE) AS running, count(*) OVER w AS place
FROM after WINDOW w AS (PARTITION BY o_orderstatus ORDER BY day, o_orderkey ROWS UNBOUNDED PRECEDING)"""))
def _(spark, sf):
    # half of all orders share a status; months are its segments
    old, new = before_after(spark, sf)
    running = sg.RunningTotals(
        ["o_orderstatus"], ["day", "o_orderkey"], {"running": F.col("price"), "place": F.lit(1).cast("bigint")}, F.trunc("day", "month"))
    state = running.refresh(running.build(old), new, delta(spark, sf))
    return amounts(running.read(state).select("o_orderstatus", "o_orderkey", "running", "place"), "running")


def ranked(share: float) -> str:
    at = f"{share}::DOUBLE * (len(v) - 1)"
    low, high = f"v[floor({at})::BIGINT + 1]", f"v[ceil({at})::BIGINT + 1]"
    return f"{low}::DOUBLE + ({high}::DOUBLE - {low}::DOUBLE) * ({at} - floor({at}))"


# the interpolation is written out, since quantile_cont weighs both neighbours and differs in the last digit
@query("maintain_percentiles", versions(f"""
SELECT o_orderpriority, {ranked(0.5)} AS p50, {ranked(0.95)} AS p95
FROM (SELECT o_orderpriority, list_sort(list(floor(price)::BIGINT)) AS v FROM after GROUP BY 1)"""))
def _(spark, sf):
    old, new = (df.select("o_orderpriority", F.floor("price").alias("price")) for df in before_after(spark, sf))
    counted = sg.ValueCounts(["o_orderpriority"], "price", F.floor(F.col("price") / 10_000))
    state = counted.refresh(counted.build(old), ch.changes(old, new))
    return counted.percentiles(state, {"p50": 0.5, "p95": 0.95})


@query("top_board_exact", versions("""
SELECT o_orderkey, CAST(price AS DOUBLE) AS price, row_number() OVER (ORDER BY price DESC, o_orderkey) AS rank FROM after
QUALIFY rank <= 25""").replace("row_number()", "CAST(row_number()").replace("o_orderkey) AS rank", "o_orderkey) AS INTEGER) AS rank"))
def _(spark, sf):
    old, new = before_after(spark, sf)
    state = inc.topk_initial(old, "o_orderkey", "price", 25)
    return amounts(inc.topk(state, delta(spark, sf), "o_orderkey", "price", 25, source=new), "price")


@query("top_board_from_state", versions("""
, leaders AS (SELECT o_orderkey, price FROM before ORDER BY price DESC, o_orderkey LIMIT 25),
arrived AS (SELECT o_orderkey, price FROM changed WHERE _action = 'INSERT'),
pool AS (SELECT * FROM arrived UNION ALL SELECT * FROM leaders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM arrived))
SELECT o_orderkey, CAST(price AS DOUBLE) AS price, CAST(row_number() OVER (ORDER BY price DESC, o_orderkey) AS INTEGER) AS rank FROM pool QUALIFY rank <= 25""").replace("USING (o_orderkey)\n  WHERE a.o_orderkey IS NULL OR z.price <> a.price OR z.o_orderstatus <> a.o_orderstatus)\n, leaders", "USING (o_orderkey)\n  WHERE a.o_orderkey IS NULL OR z.price <> a.price OR z.o_orderstatus <> a.o_orderstatus),\nleaders"))
def _(spark, sf):
    state = inc.topk_initial(b.orders_before(spark, sf), "o_orderkey", "price", 25)
    return amounts(inc.topk(state, delta(spark, sf), "o_orderkey", "price", 25), "price")


@query("refresh_frozen_region", versions("""
SELECT day, count(*) AS n, CAST(sum(price) AS DOUBLE) AS total FROM before WHERE day < DATE '2000-01-01' GROUP BY 1
UNION ALL SELECT day, count(*), CAST(sum(price) AS DOUBLE) FROM after WHERE day >= DATE '2000-01-01' GROUP BY 1"""))
def _(spark, sf):
    def daily(df):
        return df.groupBy("day").agg(F.count(F.lit(1)).alias("n"), F.sum("price").alias("total"))

    old, new = before_after(spark, sf)
    closed = F.col("day") < F.lit("2000-01-01").cast("date")
    return amounts(inc.refresh_frozen(daily(old), new, daily, closed), "total")


@query("enrich_new_rows", versions("""
SELECT o_orderkey, c_name FROM after LEFT JOIN cust_after USING (o_custkey) WHERE o_orderkey NOT IN (SELECT o_orderkey FROM before)"""))
def _(spark, sf):
    fresh = ch.changes(*before_after(spark, sf), KEY, append_only=True)
    return inc.enrich_static(fresh, b.customers_after(spark, sf), ["o_custkey"]).select("o_orderkey", "c_name")


# --- maintained tables -------------------------------------------------------------------

def _tables(spark, sf):
    """Two rollups kept over the orders: per customer, and per nation on top."""
    tables = MaintainedTables(spark, scratch_path(spark, "maintained"), max_delta_ratio=0.5)
    tables.add_base("orders", KEY)
    tables.add(Maintained(
        "per_customer", ["orders"],
        compute=lambda t: inc.agg_state(t["orders"], ["o_custkey"], ["price"]),
        apply=lambda old, d, t: inc.delta_agg(old, d["orders"], ["o_custkey"], ["price"])), keys=["o_custkey"])
    tables.add(Maintained(
        "per_size", ["per_customer"],
        compute=lambda t: t["per_customer"].groupBy("row_count").agg(F.count(F.lit(1)).alias("customers"))))
    tables.publish("orders", b.orders_before(spark, sf))
    tables.refresh("per_size", trigger="SCHEDULED")
    tables.publish("orders", b.orders_after(spark, sf))
    tables.refresh("per_size")
    tables.refresh("per_size")
    return tables


@query("maintained_table_chain", versions("""
SELECT row_count, count(*) AS customers FROM (SELECT o_custkey, count(*) AS row_count FROM after GROUP BY 1) GROUP BY 1"""))
def _(spark, sf):
    return _tables(spark, sf).read("per_size")


@query("maintained_table_history", versions("""
SELECT * FROM (SELECT 'orders' AS name, 1 AS version, 'PUBLISH' AS refresh_action, (SELECT count(*) FROM before) AS row_count
UNION ALL SELECT 'orders', 2, 'PUBLISH', (SELECT count(*) FROM after)
UNION ALL SELECT 'per_customer', 1, 'FULL', (SELECT count(DISTINCT o_custkey) FROM before)
UNION ALL SELECT 'per_customer', 2, 'INCREMENTAL', (SELECT count(DISTINCT o_custkey) FROM after)
UNION ALL SELECT 'per_customer', 2, 'NO_DATA', (SELECT count(DISTINCT o_custkey) FROM after)
UNION ALL SELECT 'per_size', 1, 'FULL', (SELECT count(DISTINCT n) FROM (SELECT count(*) AS n FROM before GROUP BY o_custkey))
UNION ALL SELECT 'per_size', 2, 'FULL', (SELECT count(DISTINCT n) FROM (SELECT count(*) AS n FROM after GROUP BY o_custkey))
UNION ALL SELECT 'per_size', 2, 'NO_DATA', (SELECT count(DISTINCT n) FROM (SELECT count(*) AS n FROM after GROUP BY o_custkey)))""").replace("1 AS version", "CAST(1 AS BIGINT) AS version"))
def _(spark, sf):
    return _tables(spark, sf).history().select("name", "version", "refresh_action", "row_count")


@query("refresh_outcomes", versions("""
SELECT * FROM (SELECT 'held' AS name, 'SKIPPED' AS state, NULL AS refresh_action, (SELECT count(*) FROM changed) AS changed_rows, NULL::BIGINT AS row_count
UNION ALL SELECT 'broken', 'FAILED', NULL, NULL, NULL
UNION ALL SELECT 'reader', 'UPSTREAM_FAILED', NULL, NULL, NULL
UNION ALL SELECT 'wider', 'SUCCEEDED', 'REINITIALIZE', NULL, (SELECT count(*) FROM after)
UNION ALL SELECT 'late', 'FAILED', NULL, NULL, NULL)"""))
def _(spark, sf):
    """The last refresh of five tables: held back by its gate, failed, above a
    failed one, rebuilt for another layout, and without the history it needs."""
    def copied(old, d, t):
        return ch.apply_changes(old, d["orders"], KEY)

    def bad(t):
        return t["orders"].withColumn("price", F.when(F.col("price") >= 0, F.raise_error(F.lit("bad price"))).otherwise(F.col("price")).cast("decimal(18,2)"))

    tables = MaintainedTables(spark, scratch_path(spark, "outcomes"))
    tables.add_base("orders", KEY)
    kept = {"compute": lambda t: t["orders"], "apply": copied}
    tables.add(Maintained("held", ["orders"], gate=lambda n: n > 10**12, **kept), keys=KEY)
    tables.add(Maintained("broken", ["orders"], compute=lambda t: t["orders"], mode="FULL"), keys=KEY)
    tables.add(Maintained("reader", ["broken"], compute=lambda t: t["broken"].select("o_orderkey")), keys=KEY)
    tables.add(Maintained("wider", ["orders"], **kept), keys=KEY)
    tables.add(Maintained("late", ["orders"], **kept), keys=KEY)
    tables.publish("orders", b.orders_before(spark, sf))
    for name in ("held", "reader", "wider", "late"):
        tables.refresh(name)
    tables.definitions["broken"] = Maintained("broken", ["orders"], compute=bad, mode="FULL")
    tables.definitions["wider"] = Maintained("wider", ["orders"], compute=lambda t: t["orders"].withColumn("year", F.year("day")), apply=copied)
    tables.publish("orders", b.orders_after(spark, sf))
    for name in ("held", "reader", "wider"):
        tables.refresh(name)
    tables.expire("orders", 2)
    tables.refresh("late")
    last = tables.history().where("name <> 'orders'").groupBy("name").agg(
        F.max_by(F.struct("state", "refresh_action", "changed_rows", F.when(F.col("refresh_action") == "REINITIALIZE", F.col("row_count")).alias("row_count")),
                 "refresh_start_time").alias("r"))
    return last.select("name", "r.*")


def _parts_chain(spark, sf, target="per_size", after_each=lambda tables: None):
    """A copy of the orders, states per customer on it, and customers per size on those: each kept in buckets, each
    reading the change set that the one below stored."""
    tables = MaintainedTables(spark, scratch_path(spark, "parts"), max_delta_ratio=0.5)
    tables.add_base("orders", KEY)
    tables.add(Maintained(
        "recent", ["orders"], compute=lambda t: t["orders"].where("day >= DATE '1996-01-01'"), touched=lambda d: d["orders"],
        apply=lambda old, d, t: ch.apply_changes(old, inc.delta_select(d["orders"], F.expr("day >= DATE '1996-01-01'")), KEY)), keys=KEY, parts=16)
    tables.add(Maintained(
        "per_customer", ["recent"], compute=lambda t: inc.agg_state(t["recent"], ["o_custkey"], ["price"]), touched=lambda d: d["recent"],
        apply=lambda old, d, t: inc.delta_agg(old, d["recent"], ["o_custkey"], ["price"])), keys=["o_custkey"], parts=16)
    tables.add(Maintained(
        "per_size", ["per_customer"], compute=lambda t: t["per_customer"].groupBy("row_count").agg(F.count(F.lit(1)).alias("customers")),
        touched=lambda d: d["per_customer"],
        apply=lambda old, d, t: inc.recompute_touched(old, ["row_count"], [d["per_customer"]], [t["per_customer"]],
                                                      lambda x: x.groupBy("row_count").agg(F.count(F.lit(1)).alias("customers")))),
        keys=["row_count"], parts=4)
    for rows in (b.orders_before(spark, sf), b.orders_before(spark, sf).where("day < DATE '2000-12-01'"), b.orders_after(spark, sf)):
        tables.publish("orders", rows)
        tables.refresh(target)
        after_each(tables)
    return tables


@query("maintained_parts_chain", versions("""
SELECT row_count, count(*) AS customers FROM (SELECT o_custkey, count(*) AS row_count FROM after WHERE day >= DATE '1996-01-01' GROUP BY 1) GROUP BY 1"""))
def _(spark, sf):
    return _parts_chain(spark, sf).read("per_size")


@query("maintained_parts_state", versions("""
SELECT o_custkey, count(*) AS row_count, CAST(sum(price) AS DOUBLE) AS sum_price, count(price) AS n_price FROM after WHERE day >= DATE '1996-01-01' GROUP BY 1"""))
def _(spark, sf):
    return amounts(_parts_chain(spark, sf).read("per_customer"), "sum_price")


@query("maintained_parts_changes", versions("""
, recent_before AS (SELECT * FROM before WHERE day >= DATE '1996-01-01' AND day < DATE '2000-12-01'), recent_after AS (SELECT * FROM after WHERE day >= DATE '1996-01-01'),
a AS (SELECT o_custkey, count(*) AS row_count, CAST(sum(price) AS DOUBLE) AS sum_price, count(price) AS n_price FROM recent_before GROUP BY 1),
z AS (SELECT o_custkey, count(*) AS row_count, CAST(sum(price) AS DOUBLE) AS sum_price, count(price) AS n_price FROM recent_after GROUP BY 1),
diff AS (SELECT *, 'DELETE' AS _action FROM (SELECT * FROM a EXCEPT SELECT * FROM z) UNION ALL SELECT *, 'INSERT' FROM (SELECT * FROM z EXCEPT SELECT * FROM a))
SELECT *, o_custkey IN (SELECT o_custkey FROM a) AND o_custkey IN (SELECT o_custkey FROM z) AS _is_update, 1::BIGINT AS _copies FROM diff"""))
def _(spark, sf):
    """What the last refresh changed, as the table itself has stored it for its readers."""
    tables = _parts_chain(spark, sf)
    newest = tables.version("per_customer")
    return amounts(tables.changes_between("per_customer", newest - 1, newest), "sum_price")


@query("stream_change_sets", versions("""
SELECT o_custkey, count(*) AS row_count, CAST(sum(price) AS DOUBLE) AS sum_price, count(price) AS n_price FROM after WHERE day >= DATE '1996-01-01' GROUP BY 1"""))
def _(spark, sf):
    """A copy of the states per customer in another place, kept up by the change sets of three versions as a stream."""
    out = scratch_path(spark, "copy")
    copies = []

    def follow(tables):
        if not copies:
            layout = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in tables.read("per_customer").schema)
            copies.append(BucketedTable(spark, f"{out}/table", ["o_custkey"], layout, parts=16))
        sv.follow(tables, "per_customer", copies[0].copy(), f"{out}/offsets")

    _parts_chain(spark, sf, "per_customer", follow)
    return amounts(copies[0].read(), "sum_price")


@query("stream_change_audit", versions("""
, one AS (SELECT * FROM before WHERE day >= DATE '1996-01-01'), two AS (SELECT * FROM one WHERE day < DATE '2000-12-01'),
three AS (SELECT * FROM after WHERE day >= DATE '1996-01-01'),
diff AS (SELECT 0 AS batch, 'INSERT' AS _action, false AS _is_update FROM one
UNION ALL SELECT 1, 'DELETE', false FROM one WHERE day >= DATE '2000-12-01'
UNION ALL SELECT 2, 'DELETE', o_orderkey IN (SELECT o_orderkey FROM three) FROM (SELECT * FROM two EXCEPT SELECT * FROM three)
UNION ALL SELECT 2, 'INSERT', o_orderkey IN (SELECT o_orderkey FROM two) FROM (SELECT * FROM three EXCEPT SELECT * FROM two))
SELECT CAST(batch AS BIGINT) AS batch, _action, _is_update, count(*) AS row_count FROM diff GROUP BY ALL"""))
def _(spark, sf):
    """Every change of three versions as an audit log, counted."""
    out = scratch_path(spark, "audit")

    def log(change_set, name, batch_id):
        ch.audit_rows(change_set, batch_id).write.mode("overwrite").parquet(f"{out}/log/batch={name}")

    _parts_chain(spark, sf, "recent", lambda tables: sv.follow(tables, "recent", log, f"{out}/offsets"))
    logged = spark.read.parquet(f"{out}/log").groupBy(F.col("_version").alias("batch"), "_action", "_is_update")
    return logged.agg(F.sum("_copies").alias("row_count"))


@query("merge_into_files", versions("""
, source AS (SELECT * FROM after WHERE day >= DATE '2000-06-01'), merged AS (
SELECT * FROM source WHERE o_orderstatus <> 'O' OR o_orderkey NOT IN (SELECT o_orderkey FROM before)
UNION ALL SELECT * FROM before WHERE o_orderkey NOT IN (SELECT o_orderkey FROM source))
SELECT * REPLACE (CAST(price AS DOUBLE) AS price) FROM merged"""))
def _(spark, sf):
    """The orders as files of their keys; what is newer since June 2000 is merged in, open orders that were known go."""
    old, new = before_after(spark, sf)
    layout = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in old.schema)
    files = KeyedFiles(spark, scratch_path(spark, "files"), KEY, layout, rows_per_file=2000)
    files.replace(old)
    every = {c: f"s.{c}" for c in old.columns}
    files.merge(new.where("day >= DATE '2000-06-01'"), [
        mg.Matched(delete=True, condition="s.o_orderstatus = 'O'"), mg.Matched(update=every), mg.NotMatched(insert=every)])
    return amounts(files.read(), "price")
