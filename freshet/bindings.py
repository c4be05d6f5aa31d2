"""The given tables in the shapes the plans expect.

Every binding covers all rows of its tables; what decides a value is always an
attribute of the row, never a sample of ids.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = dt.date(2001, 1, 1)
EVENTS_AS_OF = dt.datetime(2024, 1, 31)

# Market segment -> source system.
SEGMENTS = {
    "SAP": ["AUTOMOBILE", "MACHINERY"],
    "ORACLE": ["BUILDING"],
    "BAAN": ["FURNITURE"],
    "WORKDAY": ["HOUSEHOLD"],
}
STATUS_WORDS = {
    "SAP": {"F": "APPROVED", "O": "APPROVED", "P": "PENDING"},
    "ORACLE": {"F": "VALIDATED", "O": "APPROVED", "P": "PENDING"},
    "BAAN": {"F": "POSTED", "O": "APPROVED", "P": "PENDING"},
    "WORKDAY": {"F": "Approved", "O": "Approved", "P": "In Review"},
}
PREFIX = {"SAP": "SAP", "ORACLE": "ORA", "BAAN": "BAN", "WORKDAY": "WD"}
TERMS = {"SAP": "NET", "ORACLE": "N", "BAAN": "N", "WORKDAY": "Net "}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _invoice_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))


def _native(rows: DataFrame, tag: str, names: list[str], extra: dict[str, str]) -> DataFrame:
    """One landing table: the common facts of an order under native names."""
    prefix, usd = PREFIX[tag], "EUR" if tag == "BAAN" else "USD"
    days = "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 30 ELSE 60 END"
    words = " ".join(f"WHEN '{status}' THEN '{word}'" for status, word in STATUS_WORDS[tag].items())
    segments = ", ".join(f"'{s}'" for s in SEGMENTS[tag])
    facts = [
        f"'{prefix}-' || o_orderkey",
        f"'{prefix}-INV-' || o_orderkey",
        "'V-' || c_custkey",
        "c_name",
        "CAST(o_orderdate AS DATE)",
        f"date_add(CAST(o_orderdate AS DATE), {days})",
        "CAST(o_totalprice AS DECIMAL(18,2))",
        f"CASE WHEN c_nationkey < 9 THEN '{usd}' WHEN c_nationkey < 17 THEN 'EUR' ELSE 'GBP' END",
        f"'{TERMS[tag]}' || {days}",
        "CASE WHEN o_orderpriority <> '5-LOW' THEN 'PO-' || o_orderkey END",
        "c_mktsegment || ' ' || o_orderpriority",
        f"'{prefix}-GL-' || lpad(CAST(c_nationkey AS STRING), 3, '0')",
        f"'{prefix}-CC-' || o_orderstatus",
        f"CASE o_orderstatus {words} END",
        "CAST(o_orderdate AS TIMESTAMP_NTZ)",
    ]
    columns = [f"{fact} AS {name}" for fact, name in zip(facts, names, strict=True)]
    columns += [f"{fact} AS {name}" for name, fact in extra.items()]
    return rows.where(f"c_mktsegment IN ({segments})").selectExpr(*columns)


def invoice_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Orders and customers as the landing tables of four source systems.

    Urgent orders of the BAAN source are delivered a second time, an hour later
    and under a new id, with a corrected amount.
    """
    from .plans.invoices import MAPPINGS

    rows = _invoice_rows(spark, sf_dir)
    extra = {
        "SAP": {"sap_company_code": "CAST(c_nationkey AS STRING)", "sap_document_type": "o_orderstatus"},
        "ORACLE": {"oracle_org_id": "CAST(c_nationkey AS STRING)", "oracle_source": "o_orderpriority"},
        "BAAN": {"ban_company": "CAST(c_nationkey AS STRING)"},
        "WORKDAY": {"wd_tenant_id": "CASE WHEN c_nationkey < 9 THEN 'WD-T1' ELSE 'WD-T2' END"},
    }
    sources = {tag: _native(rows, tag, list(MAPPINGS[tag].values()), extra[tag]) for tag in MAPPINGS}
    urgent = rows.where(F.col("o_orderpriority") == "1-URGENT")
    again = _native(urgent, "BAAN", list(MAPPINGS["BAAN"].values()), extra["BAAN"])
    again = again.withColumns({
        "ban_invoice_id": F.concat("ban_invoice_id", F.lit("-R")),
        "ban_amount": (F.col("ban_amount") + F.lit(10)).cast("decimal(18,2)"),
        "ban_created": F.col("ban_created") + F.expr("INTERVAL 1 HOUR"),
    })
    sources["BAAN"] = sources["BAAN"].unionByName(again)
    return sources


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .plans.invoices import conform

    return conform(invoice_sources(spark, sf_dir))


def json_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("custid"), F.col("c_name").alias("cname"),
        F.col("c_acctbal").cast("decimal(10,2)").alias("spendlimit"),
    )


def json_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as (custid, purchase JSON)."""
    purchase = F.struct(
        F.col("l_partkey").alias("prodid"), F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("purchase_amount"), F.to_date("o_orderdate").alias("purchase_date"),
    )
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return orders.join(items, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("custid"), F.to_json(purchase).alias("purchase")
    )


# --- two versions of a table -----------------------------------------------------

def _order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.to_date("o_orderdate").alias("day"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"), "o_orderpriority",
    )


def orders_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as known at the end of 2000."""
    return _order_rows(spark, sf_dir).where("day < DATE '2001-01-01'")


def orders_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders later on: the first half of 1995 is gone, 2001 has arrived, and
    pending orders of 2000 have become final with a surcharge."""
    settled = (F.col("o_orderstatus") == "P") & (F.year("day") == 2000)
    return _order_rows(spark, sf_dir).where("day >= DATE '1995-07-01'").withColumns({
        "price": F.when(settled, F.col("price") + 100).otherwise(F.col("price")).cast("decimal(18,2)"),
        "o_orderstatus": F.when(settled, "F").otherwise(F.col("o_orderstatus")),
    })


def customers_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").where("c_mktsegment <> 'MACHINERY'").select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey")


def customers_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").where("c_acctbal > 0").select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey")


# --- refresh operations --------------------------------------------------------------
#
# One event is one refresh of the table named after its user.

ROOTS, DIAMONDS = 16, 32  # tables below ROOTS read a base table only
HIGH_VALUE = 200.0  # events above this mark constructs, edges to tracked tables and the like


def _unit(column) -> Column:
    return F.concat(F.lit("T"), F.lpad(column.cast("string"), 6, "0"))


def _parent(n: Column, by: int) -> Column:
    return F.floor(n / by).cast("bigint")


def refresh_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value", F.get_json_object("props", "$.k").cast("bigint").alias("k"))
    kind, n = F.col("event_type"), F.col("user_id")
    second = F.date_trunc("second", F.col("ts")).cast("timestamp_ntz")
    statistics = F.to_json(F.struct(
        (F.col("k") * 10).alias("compilationTimeMs"), F.floor(F.col("value") * 100).alias("executionTimeMs"),
        (F.col("k") * 100).alias("numInsertedRows"), F.col("k").alias("numDeletedRows"),
        (F.col("k") + n).alias("numCopiedRows"), F.lit(1).alias("numAddedPartitions"), F.lit(0).alias("numRemovedPartitions"),
    ))
    parent = F.struct(_unit(_parent(n, 2)).alias("name"), F.col("k").alias("rows"))
    far = F.struct(_unit(_parent(n, 4)).alias("name"), (F.col("k") * 2).alias("rows"))
    inputs = F.when(n >= DIAMONDS, F.array(parent, far)).when(n >= ROOTS, F.array(parent))
    return events.select(
        _unit(n).alias("name"),
        F.when(kind == "error", "FAILED").when(kind == "signup", "SKIPPED").otherwise("SUCCEEDED").alias("state"),
        F.when(kind == "error", F.concat(F.lit("E"), F.col("k").cast("string"))).alias("state_code"),
        F.when(kind == "error", F.when(F.col("k") < 20, "change tracking is off").otherwise("query failed")).alias("state_message"),
        second.alias("refresh_start_time"),
        (second + F.make_dt_interval(secs=F.floor("value"))).cast("timestamp_ntz").alias("refresh_end_time"),
        F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz").alias("data_timestamp"),
        F.when(kind == "click", "FULL").when(kind == "purchase", F.when(F.col("k") < 10, "REINITIALIZE").otherwise("INCREMENTAL"))
        .when(kind == "signup", "NO_DATA").otherwise("INCREMENTAL").alias("refresh_action"),
        F.when((kind == "view") & (F.col("k") < 3), "CREATION").when(F.col("k") >= 90, "MANUAL").otherwise("SCHEDULED").alias("refresh_trigger"),
        F.concat(F.lit("Q"), F.lpad(F.col("event_id").cast("string"), 9, "0")).alias("query_id"),
        statistics.alias("statistics"),
        F.lit(36000).cast("bigint").alias("target_lag_sec"),
        F.date_trunc("week", F.col("ts")).cast("timestamp_ntz").alias("graph_history_valid_from"),
        inputs.alias("inputs_with_changed_data"),
        F.when((kind == "purchase") & (F.col("k") < 10), "input replaced").alias("reinit_reason"),
    )


def table_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per maintained table, with what its owner asked for."""
    per_user = table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.max("value").alias("top"), F.count_if(F.col("event_type") == "click").alias("clicks"),
        F.count_if(F.col("event_type") == "view").alias("views"))
    return per_user.select(
        _unit(F.col("user_id")).alias("name"),
        F.when(F.col("top") > 300, "SUSPENDED").otherwise("ACTIVE").alias("scheduling_state"),
        F.when(F.col("clicks") > F.col("views"), "FULL").otherwise("INCREMENTAL").alias("refresh_mode"),
        F.when(F.col("top") > 150, "INCREMENTAL").otherwise("FULL").alias("expected_mode"),
        F.lit(36000).cast("bigint").alias("target_lag"),
    )


def graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current dependency rows (name, inputs array of {name, kind})."""
    n = F.col("user_id")

    def entry(name: Column, kind: str) -> Column:
        return F.struct(name.alias("name"), F.lit(kind).alias("kind"))

    base = entry(F.concat(F.lit("BASE_"), n.cast("string")), "TABLE")
    near, far = entry(_unit(_parent(n, 2)), "MAINTAINED"), entry(_unit(_parent(n, 4)), "MAINTAINED")
    inputs = F.when(n >= DIAMONDS, F.array(near, far)).when(n >= ROOTS, F.array(near)).otherwise(F.array(base))
    return table(spark, sf_dir, "events").select("user_id").distinct().select(_unit(n).alias("name"), inputs.alias("inputs"))


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All maintained tables, including those only named as an input."""
    rows = graph(spark, sf_dir)
    named = rows.select(F.explode("inputs").alias("i")).where(F.col("i.kind") == "MAINTAINED").select(F.col("i.name").alias("node"))
    return rows.select(F.col("name").alias("node")).unionByName(named).distinct()


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One span per table and day; links point at the inputs' spans of that day."""
    n, day = F.col("user_id"), F.col("day")

    def span_of(node: Column) -> Column:
        return F.concat(F.lit("S"), node.cast("string"), F.lit("@"), day.cast("string"))

    def link(node: Column) -> Column:
        return F.struct(span_of(node).alias("span_id"), F.concat(F.lit("C@"), day.cast("string")).alias("trace_id"))

    per_day = table(spark, sf_dir, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("all"), F.count_if(F.col("event_type") == "error").alias("bad"),
        F.count_if(F.col("event_type") == "signup").alias("idle"), F.min("ts").alias("first"),
        F.sum(F.floor("value")).alias("work"))
    near, far = link(_parent(n, 2)), link(_parent(n, 4))
    state = F.when(F.col("bad") > F.col("idle"), "FAILED").when(F.col("idle") > 0, "SKIPPED").otherwise("SUCCEEDED")
    start = F.date_trunc("second", F.col("first")).cast("timestamp_ntz")
    reason = (F.when(state == "FAILED", "QUERY_FAILURE")
              .when((state == "SKIPPED") & (F.col("idle") > 1), "NOT_EFFECTIVE_TICK_TO_REFRESH")
              .when((state == "SKIPPED") & (F.col("bad") > 0), "UPSTREAM_FAILURE")
              .when(state == "SKIPPED", "UPSTREAM_SKIP"))
    return per_day.select(
        F.concat(F.lit("C@"), day.cast("string")).alias("trace_id"), span_of(n).alias("span_id"), _unit(n).alias("name"),
        day.cast("timestamp_ntz").alias("data_timestamp"), state.alias("state"), reason.alias("state_reason"),
        start.alias("start_timestamp"),
        (start + F.make_dt_interval(secs=F.when(state == "SKIPPED", 0).otherwise(F.col("work")))).cast("timestamp_ntz").alias("end_timestamp"),
        F.when(n >= DIAMONDS, F.array(near, far)).when(n >= ROOTS, F.array(near)).otherwise(F.array()).alias("links"),
    )


# --- definitions, tasks, grants ---------------------------------------------------------

def _per_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per user with measures that stand in for settings."""
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.max("value").alias("top"), F.count(F.lit(1)).alias("n"),
        *[F.count_if(kind == k).alias(k) for k in ("view", "click", "purchase", "signup", "error")])


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(name, kind) of everything in the catalog; quiet tables are hidden."""
    top = F.col("top")
    kind = F.when(top > 300, "MAINTAINED").when(top > 190, "VIEW").when(top > 180, "EXTERNAL TABLE").otherwise("TABLE")
    return _per_unit(spark, sf_dir).where(F.col("error") <= F.col("n") / 3).select(_unit(F.col("user_id")).alias("name"), kind.alias("kind"))


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .operators.graph import edges

    return edges(graph(spark, sf_dir), kinds=["MAINTAINED"]).select("child", "parent")


def definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, c, p, s, e = (F.col(k) for k in ("view", "click", "purchase", "signup", "error"))
    return _per_unit(spark, sf_dir).select(
        _unit(F.col("user_id")).alias("name"),
        F.when(v > c, "CUSTOM").otherwise("STANDARD").alias("kind"),
        F.when(c > v, "FULL").otherwise("INCREMENTAL").alias("refresh_mode"),
        F.floor(F.col("top")).alias("target_lag_sec"),
        (p > s).alias("start_at"), (e > s).alias("backfill"),
        F.when(v > e, "day < '2024-01-15'").alias("frozen_predicate"),
        F.when(s > v, 2).otherwise(1).alias("statements"), F.when(e > v, 2).otherwise(1).alias("targets"),
        (c >= p).alias("columns_declared"), (c < s).alias("reads_own_changes"), (p > v).alias("procedural"),
    )


def models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_unit(spark, sf_dir).select(
        _unit(F.col("user_id")).alias("name"),
        F.when(F.col("click") > F.col("view"), "FULL").otherwise("INCREMENTAL").alias("mode"),
        (F.col("purchase") > F.col("signup")).alias("has_key"), (F.col("top") > 300).alias("tracked"))


CONSTRUCT_OF = {"view": "GROUP BY", "click": "INNER JOIN", "purchase": "ROW_NUMBER", "signup": "PIVOT", "error": "ROLLUP"}


def constructs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(name, construct, key_columns): high-value events mark a construct."""
    kind = F.col("event_type")
    word = F.coalesce(*[F.when(kind == k, w) for k, w in CONSTRUCT_OF.items()])
    keys = F.when(kind == "purchase", F.array(F.lit("id"))).when(kind == "view", F.array(F.lit("day"), F.lit("region")))
    return table(spark, sf_dir, "events").where(F.col("value") > HIGH_VALUE).select(
        _unit(F.col("user_id")).alias("name"), word.alias("construct"), keys.alias("key_columns")).distinct()


def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, c, p, s, e = (F.col(k) for k in ("view", "click", "purchase", "signup", "error"))
    rows = _per_unit(spark, sf_dir).select(
        _unit(F.col("user_id")).alias("name"), F.floor("top").alias("schedule_sec"),
        F.concat(F.floor("top").cast("string"), F.lit(" seconds")).alias("schedule"),
        F.when(v > c, "EXTERNAL TABLE").otherwise("TABLE").alias("source_kind"),
        (p > s).alias("view_between"), F.when(e > c, 2).otherwise(1).alias("statements"),
        (s > c).alias("append_only"), (e > s).alias("static_join"))
    inputs = graph(spark, sf_dir).select(
        "name", F.expr("transform(filter(inputs, i -> i.kind = 'MAINTAINED'), i -> i.name)").alias("predecessors"))
    return rows.join(inputs, "name")


def role_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as users, nations as roles."""
    return table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_name").alias("user"), F.col("n_name").alias("role"))


def role_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A nation inherits from its region."""
    return table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("child"), F.col("r_name").alias("parent"))


def deep_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as roles: each inherits from the role of half its number."""
    n = F.col("user_id")
    return table(spark, sf_dir, "events").where("user_id >= 2").select(n).distinct().select(
        _unit(n).alias("child"), _unit(_parent(n, 2)).alias("parent"))


def deep_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers hold the role of their number."""
    return table(spark, sf_dir, "customer").select(F.col("c_name").alias("user"), _unit(F.col("c_custkey")).alias("role"))


def deep_grants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """High-value events grant their kind to a role; errors withdrew it."""
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").where(F.col("value") > HIGH_VALUE).select(
        _unit(F.col("user_id")).alias("role"), F.concat(kind, F.lit("_"), (F.col("user_id") % 7).cast("string")).alias("object"),
        F.lit("SELECT").alias("privilege"), F.when(kind == "error", F.lit("2024-01-01").cast("date")).alias("deleted_on"))


def projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns that definitions read: a table has a column per kind of its
    events, from the same column of its input, errors also from what its second
    input calls a view; high values mark a filter."""
    n, kind = F.col("user_id"), F.col("event_type")
    near = F.when(n < ROOTS, F.concat(F.lit("BASE_"), n.cast("string"))).otherwise(_unit(_parent(n, 2)))
    seen = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.max("value").alias("top"))
    far = (n >= DIAMONDS) & (kind == "error")
    rows = F.array_compact(F.array(
        F.struct(kind.alias("column"), near.alias("input"), kind.alias("input_column"), F.lit("OUTPUT").alias("role")),
        F.when(far, F.struct(kind.alias("column"), _unit(_parent(n, 4)).alias("input"), F.lit("view").alias("input_column"), F.lit("OUTPUT").alias("role"))),
        F.when(F.col("top") > HIGH_VALUE, F.struct(
            F.lit(None).cast("string").alias("column"), near.alias("input"), kind.alias("input_column"), F.lit("FILTER").alias("role")))))
    return seen.select(_unit(n).alias("name"), F.explode(rows).alias("r")).select("name", "r.*")


def dropped_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of views and clicks of the base tables."""
    return projections(spark, sf_dir).where("input LIKE 'BASE%' AND input_column IN ('view', 'click')").select(
        F.col("input").alias("name"), F.col("input_column").alias("column")).distinct()


def _shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag", "l_quantity")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return items.join(part, F.col("l_partkey") == F.col("p_partkey")).join(
        supplier, F.col("l_suppkey") == F.col("s_suppkey"))


def grants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles may read the brands their suppliers had returned in bulk; the
    largest returns withdrew the grant again."""
    rows = _shipments(spark, sf_dir).where("l_returnflag = 'R' AND l_quantity >= 45")
    named = rows.join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    role = F.when(F.col("l_quantity") == 49, F.col("r_name")).otherwise(F.col("n_name"))
    return named.select(role.alias("role"), F.col("p_brand").alias("object"), F.lit("SELECT").alias("privilege"),
                        F.when(F.col("l_quantity") == 50, F.lit("2024-01-01").cast("date")).alias("deleted_on"))


def required_grants(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _shipments(spark, sf_dir).where("l_returnflag = 'A'")
    return rows.select(F.col("s_name").alias("user"), F.col("p_brand").alias("object"), F.lit("SELECT").alias("privilege")).distinct()


def policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = F.when(F.col("s_acctbal") > 6000, "db.sec.").when(F.col("s_acctbal") > 3000, "sec.").otherwise("")
    body = F.concat(F.lit("CASE WHEN EXISTS (SELECT 1 FROM "), schema, F.lit("acl_"), F.col("s_nationkey").cast("string"), F.lit(") THEN val END"))
    return table(spark, sf_dir, "supplier").select(F.col("s_name").alias("policy"), body.alias("body"))


def policy_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shipments(spark, sf_dir).select(
        F.col("s_name").alias("policy"), F.col("p_brand").alias("table"), F.lit("price").alias("column")).distinct()


# --- food trucks ---------------------------------------------------------------------------

def trucks(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Lines, orders, parts, nations, regions and customers as the star tables;
    only customers in credit are loyalty members."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    customer = table(spark, sf_dir, "customer")
    orders = table(spark, sf_dir, "orders").join(
        customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    none = F.lit(None).cast("string")
    items = table(spark, sf_dir, "lineitem")
    return {
        "detail": items.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_detail_id"), F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("menu_item_id"), F.col("l_linenumber").cast("long").alias("line_number"),
            F.col("l_quantity").cast("decimal(5,0)").alias("quantity"), F.col("l_tax").cast("decimal(38,4)").alias("unit_price"),
            F.col("l_extendedprice").cast("decimal(18,4)").alias("price")),
        "header": orders.select(
            F.col("o_orderkey").alias("order_id"), F.col("c_nationkey").cast("long").alias("truck_id"),
            (F.col("c_nationkey") + 1000).cast("double").alias("location_id"), F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("order_ts"), F.col("o_totalprice").cast("decimal(18,4)").alias("order_amount"),
            none.alias("order_tax_amount"), none.alias("order_discount_amount"),
            F.col("o_totalprice").cast("decimal(18,4)").alias("order_total")),
        "truck": places.select(
            F.col("n_nationkey").cast("long").alias("truck_id"), F.col("n_name").alias("primary_city"), F.col("r_name").alias("region"),
            F.col("r_name").alias("country"), F.lit(1).cast("long").alias("franchise_flag"), F.col("n_regionkey").cast("long").alias("franchise_id")),
        "menu": table(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("menu_item_id"), F.col("p_brand").alias("truck_brand_name"), F.col("p_type").alias("menu_type"),
            F.col("p_name").alias("menu_item_name")),
        "franchise": region.select(
            F.col("r_regionkey").cast("long").alias("franchise_id"), F.col("r_name").alias("first_name"), F.upper("r_name").alias("last_name")),
        "location": nation.select((F.col("n_nationkey") + 1000).cast("long").alias("location_id"), F.col("n_name").alias("location")),
        "loyalty": customer.where("c_acctbal > 0").select(
            F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("first_name"), F.col("c_mktsegment").alias("last_name"),
            F.concat(F.lit("city"), F.col("c_nationkey").cast("string")).alias("city"), F.lit("X").alias("country"),
            F.concat("c_name", F.lit("@x.org")).alias("e_mail"), F.col("c_custkey").cast("string").alias("phone_number"),
            F.lit("0").alias("children_count"), none.alias("gender"), none.alias("marital_status")),
    }


def star(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .plans.trucks import orders_star

    return orders_star(**trucks(spark, sf_dir))


def weather_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A supplier is a postal code, and what it ships in a day is the weather."""
    supplier = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    day = F.to_date("l_shipdate")
    shipped = table(spark, sf_dir, "lineitem").groupBy(day.alias("date_valid_std"), "l_suppkey").agg(
        F.max("l_quantity").alias("q"), F.max("l_discount").alias("d"), F.max("l_tax").alias("t"))
    return shipped.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        "date_valid_std", F.col("s_suppkey").cast("string").alias("postal_code"),
        F.concat(F.lit("C"), F.col("n_regionkey").cast("string")).alias("country"), F.col("n_name").alias("city_name"),
        (F.col("q") + 30).cast("decimal(10,4)").alias("avg_temperature_air_2m_f"),
        F.col("d").cast("decimal(10,4)").alias("tot_precipitation_in"), (F.col("t") * 1000).cast("decimal(10,4)").alias("max_wind_speed_100m_mph"))


def postal_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").cast("string").alias("postal_code"), F.concat(F.lit("C"), F.col("n_regionkey").cast("string")).alias("country"),
        F.col("n_name").alias("city_name"))


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.concat(F.lit("C"), F.col("n_regionkey").cast("string")).alias("iso_country"), F.col("n_name").alias("city"), F.col("r_name").alias("country"))


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .plans.trucks import daily_weather

    return daily_weather(weather_history(spark, sf_dir), postal_codes(spark, sf_dir), countries(spark, sf_dir))


# --- marketing and support --------------------------------------------------------------------

def campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks of a day: events by user and kind of event."""
    return table(spark, sf_dir, "events").groupBy(
        F.to_date("ts").alias("date"), F.col("event_type").alias("campaign_name"),
        F.concat(F.lit("src"), (F.col("user_id") % 20).cast("string")).alias("category")).agg(
        F.count(F.lit(1)).alias("impressions"), F.sum(F.floor("value")).alias("clicks"))


def support_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id"), F.col("lang").alias("title"), F.col("source").alias("product"),
        F.col("text").alias("transcript"))
