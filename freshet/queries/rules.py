"""Rule checks over definitions and data."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import bindings as b
from ..operators import graph as g
from ..plans import rules as r
from ..plans.invoices import MAPPINGS
from ..sources.schemas import CONFORMED_COLUMNS
from . import query
from .fragments import with_invoices
from .lineage import EDGE, OBJECTS, PER, unit


def table_edges(spark, sf):
    return g.edges(b.graph(spark, sf), kinds=["MAINTAINED"])


@query("rule_incremental_reads_full", f"""
WITH {EDGE}, {PER} SELECT 'incremental_reads_full' AS rule, {unit('a.n')} AS name, {unit('z.n')} AS detail
FROM edge JOIN per a ON a.n = edge.n JOIN per z ON z.n = edge.p WHERE NOT a.c > a.v AND z.c > z.v""")
def _(spark, sf):
    return r.incremental_reads_full(b.definitions(spark, sf), table_edges(spark, sf))


@query("rule_tracking_missing", f"""
SELECT 'tracking_missing' AS rule, {unit('user_id')} AS name, 'BASE_' || user_id AS detail FROM events WHERE user_id < 16
GROUP BY user_id HAVING max(value) <= 200""")
def _(spark, sf):
    tracked = b.table(spark, sf, "events").where(F.col("value") > b.HIGH_VALUE).select(
        F.concat(F.lit("BASE_"), F.col("user_id").cast("string")).alias("name")).distinct()
    return r.tracking_missing(g.edges(b.graph(spark, sf)), tracked)


@query("rule_view_between", f"""
WITH {EDGE}, {OBJECTS} SELECT 'view_between' AS rule, {unit('lo.n')} AS name, {unit('hi.p')} || ' > ' || {unit('lo.p')} AS detail
FROM edge lo JOIN edge hi ON hi.n = lo.p JOIN obj m ON m.n = lo.n AND m.kind = 'MAINTAINED' JOIN obj v ON v.n = lo.p AND v.kind = 'VIEW'
JOIN obj x ON x.n = hi.p AND x.kind = 'MAINTAINED'""")
def _(spark, sf):
    return r.view_between(b.objects(spark, sf), b.reads(spark, sf))


@query("rule_start_and_backfill", f"""
WITH {PER} SELECT 'start_needs_backfill' AS rule, {unit('n')} AS name, CASE WHEN v > c THEN 'CUSTOM' ELSE 'STANDARD' END AS detail FROM per WHERE p > s AND NOT e > s
UNION ALL SELECT 'backfill_needs_frozen_region', {unit('n')}, 'STANDARD' FROM per WHERE e > s AND NOT v > c AND NOT v > e""")
def _(spark, sf):
    return r.start_and_backfill(b.definitions(spark, sf))


@query("rule_custom_limits", f"""
WITH {PER}, x AS (SELECT * FROM per WHERE v > c) SELECT 'one_statement' AS rule, {unit('n')} AS name, 'CUSTOM' AS detail FROM x WHERE s > v
UNION ALL SELECT 'one_target', {unit('n')}, 'CUSTOM' FROM x WHERE e > v UNION ALL SELECT 'columns_declared', {unit('n')}, 'CUSTOM' FROM x WHERE NOT c >= p
UNION ALL SELECT 'own_changes', {unit('n')}, 'CUSTOM' FROM x WHERE c < s UNION ALL SELECT 'procedural_code', {unit('n')}, 'CUSTOM' FROM x WHERE p > v""")
def _(spark, sf):
    return r.custom_limits(b.definitions(spark, sf))


@query("rule_lag_too_short", f"""
WITH {EDGE}, {PER}, l AS (SELECT n, CAST(floor(top) AS BIGINT) AS lag FROM per) SELECT 'lag_below_minimum' AS rule, {unit('n')} AS name, CAST(lag AS VARCHAR) AS detail FROM l WHERE lag < 60
UNION ALL SELECT 'lag_below_upstream', {unit('a.n')}, {unit('z.n')} FROM edge JOIN l a ON a.n = edge.n JOIN l z ON z.n = edge.p WHERE a.lag < z.lag""")
def _(spark, sf):
    return r.lag_too_short(b.definitions(spark, sf), table_edges(spark, sf))


@query("rule_migration_blockers", f"""
WITH {PER}, x AS (SELECT n, concat_ws(',', CASE WHEN v > c THEN 'UNSUPPORTED_SOURCE' END, CASE WHEN floor(top) < 60 THEN 'SUB_MINUTE' END,
  CASE WHEN p > s THEN 'VIEW_BETWEEN' END, CASE WHEN e > c THEN 'MULTI_STATEMENT' END) AS hard,
  concat_ws(',', CASE WHEN s > c THEN 'APPEND_ONLY_STREAM' END, CASE WHEN e > s THEN 'STATIC_JOIN' END) AS soft FROM per)
SELECT {unit('n')} AS name, CASE WHEN hard <> '' THEN 'DO_NOT_MIGRATE' WHEN soft <> '' THEN 'CUSTOM_INCREMENTAL' ELSE 'PROCEED' END AS recommendation,
  concat_ws(',', nullif(hard, ''), nullif(soft, '')) AS findings FROM x""")
def _(spark, sf):
    return r.migration_blockers(b.tasks(spark, sf))


@query("rule_mapping_gaps", """
WITH c AS (SELECT o_orderpriority AS source_system, count(*) FILTER (o_orderstatus = 'P') > count(*) FILTER (o_orderstatus = 'F') AS more FROM orders GROUP BY 1)
SELECT source_system, 'payment_terms' AS target_column, 'OPEN' AS finding FROM c UNION ALL SELECT source_system, 'po_number', 'UNMAPPED' FROM c WHERE more""")
def _(spark, sf):
    # one mapping sheet per order priority; sheets with more pending than final
    # orders leave out the purchase order
    sheets = b.table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("source_system")).agg(
        (F.count_if(F.col("o_orderstatus") == "P") > F.count_if(F.col("o_orderstatus") == "F")).alias("more"))
    columns = F.explode(F.array(*[F.lit(c.upper()) for c in MAPPINGS["BAAN"]])).alias("target_column")
    mapping = sheets.select("source_system", "more", columns).where("NOT (more AND target_column = 'PO_NUMBER')").withColumn(
        "status", F.when(F.col("target_column") == "PAYMENT_TERMS", "Open — needs decision").otherwise("Confirmed"))
    return r.mapping_gaps(mapping, CONFORMED_COLUMNS)


@query("rule_format_violations", with_invoices("""
SELECT * FROM (SELECT source_system, c AS column_name, count(*) AS violations FROM (
  SELECT source_system, unnest(['invoice_id', 'vendor_id', 'gl_account', 'cost_center', 'currency_code', 'po_number']) AS c,
    unnest([invoice_id, vendor_id, gl_account, cost_center, currency_code, po_number]) AS x FROM inv)
JOIN (VALUES ('SAP', 'invoice_id', '^SAP-[0-9]+$'), ('ORACLE', 'invoice_id', '^ORA-[0-9]+$'), ('BAAN', 'invoice_id', '^BAN-[0-9]+$'), ('WORKDAY', 'invoice_id', '^WD-[0-9]+$'),
  ('BAAN', 'vendor_id', '^BV-[0-9]+$'), ('WORKDAY', 'vendor_id', '^WS-[0-9]+$'), ('BAAN', 'gl_account', '^GL-[0-9]+$'), ('WORKDAY', 'gl_account', '^LA-[0-9]+$'),
  ('BAAN', 'cost_center', '^BC-[A-Z0-9]{2,3}$'), ('WORKDAY', 'cost_center', '^WCC-[A-Z0-9]+$'), ('BAAN', 'currency_code', '^(EUR|GBP)$'),
  ('WORKDAY', 'currency_code', '^(USD|EUR|GBP)$'), ('WORKDAY', 'po_number', '^WPO-[0-9]+$')) f(src, col, pat) ON src = source_system AND col = c
WHERE NOT coalesce(regexp_matches(x, pat), c = 'po_number') GROUP BY 1, 2)"""))
def _(spark, sf):
    return r.format_violations(b.invoices(spark, sf))


@query("rule_unqualified_policies", """
SELECT DISTINCT 'unqualified_name' AS rule, p_brand || '.price' AS name, s_name AS detail FROM lineitem JOIN part ON p_partkey = l_partkey
JOIN supplier ON s_suppkey = l_suppkey WHERE s_acctbal <= 6000""")
def _(spark, sf):
    return r.unqualified_policies(b.policies(spark, sf), b.policy_references(spark, sf))
