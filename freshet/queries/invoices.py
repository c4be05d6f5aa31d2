"""Conforming, vendor rollup, business questions, and the layer above."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import bindings as b
from ..operators.relational import join_back
from ..plans import gold
from ..plans import invoices as p
from . import query
from .fragments import with_invoices

ALL = "invoice_id, invoice_number, vendor_id, vendor_name, invoice_date, due_date, CAST(invoice_amount AS DOUBLE) AS invoice_amount, currency_code, payment_terms, po_number, line_description, gl_account, cost_center, approval_status, created_at, source_system"


def amounts(df, *columns):
    """Decimals leave as doubles, so that both engines hash the same type."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


@query("conform_invoices", with_invoices(f"SELECT {ALL} FROM inv"))
def _(spark, sf):
    return amounts(b.invoices(spark, sf), "invoice_amount")


@query("invoices_by_source_proof", with_invoices(
    "SELECT source_system, count(*) AS invoice_count FROM inv GROUP BY 1"))
def _(spark, sf):
    return p.invoices_by(b.invoices(spark, sf), "source_system")


@query("drop_resends", """
SELECT 'BAN-' || o_orderkey || CASE WHEN o_orderpriority = '1-URGENT' THEN '-R' ELSE '' END AS ban_invoice_id,
       'BAN-INV-' || o_orderkey AS ban_invoice_ref,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) + CASE WHEN o_orderpriority = '1-URGENT' THEN 10 ELSE 0 END AS DOUBLE) AS ban_amount
FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'FURNITURE'""")
def _(spark, sf):
    kept = p.drop_resends(b.invoice_sources(spark, sf)["BAAN"])
    return amounts(kept.select("ban_invoice_id", "ban_invoice_ref", "ban_amount"), "ban_amount")


SUMMARY = """count(*) AS invoice_count,
  CAST(sum(invoice_amount) AS DOUBLE) AS total_spend,
  CAST(sum(CASE WHEN approval_status = 'PENDING' THEN invoice_amount ELSE 0 END) AS DOUBLE) AS total_pending_amount,
  CAST(sum(CASE WHEN due_date < DATE '2001-01-01' THEN invoice_amount ELSE 0 END) AS DOUBLE) AS total_overdue_amount,
  min(invoice_date) AS first_invoice_date, max(invoice_date) AS last_invoice_date,
  count(DISTINCT source_system) AS source_system_count"""
MONEY = ("total_spend", "total_pending_amount", "total_overdue_amount")


@query("vendor_summary", with_invoices(f"SELECT vendor_name, {SUMMARY} FROM inv GROUP BY 1"))
def _(spark, sf):
    return amounts(p.vendor_summary(b.invoices(spark, sf), b.AS_OF), *MONEY)


@query("vendor_currency_summary", with_invoices(f"SELECT vendor_name, currency_code, {SUMMARY} FROM inv GROUP BY 1, 2"))
def _(spark, sf):
    return amounts(p.vendor_currency_summary(b.invoices(spark, sf), b.AS_OF), *MONEY)


@query("golden_q01_spend_by_vendor", with_invoices(
    "SELECT vendor_name, CAST(sum(invoice_amount) AS DOUBLE) AS total_spend FROM inv GROUP BY 1"))
def _(spark, sf):
    return amounts(p.golden(b.invoices(spark, sf), "q01"), "total_spend")


@query("golden_q02_invoices_per_month", with_invoices(
    "SELECT CAST(date_trunc('month', invoice_date) AS DATE) AS invoice_month, count(*) AS invoice_count FROM inv GROUP BY 1"))
def _(spark, sf):
    return p.golden(b.invoices(spark, sf), "q02")


@query("golden_q03_invoices_by_source", with_invoices(
    "SELECT source_system, count(*) AS invoice_count FROM inv GROUP BY 1"))
def _(spark, sf):
    return p.golden(b.invoices(spark, sf), "q03")


@query("golden_q04_average_by_currency", with_invoices("""
SELECT currency_code, CAST(CAST(sum(invoice_amount) AS DECIMAL(28,2)) / count(invoice_amount) AS DECIMAL(38,4))::DOUBLE AS avg_invoice_amount
FROM (SELECT currency_code, invoice_amount FROM inv) GROUP BY 1""").replace(
    "CAST(CAST(sum(invoice_amount) AS DECIMAL(28,2)) / count(invoice_amount) AS DECIMAL(38,4))::DOUBLE",
    "round(CAST(sum(invoice_amount) AS DOUBLE) / count(invoice_amount), 3)"))
def _(spark, sf):
    df = p.golden(b.invoices(spark, sf), "q04")
    return df.withColumn("avg_invoice_amount", F.round(F.col("avg_invoice_amount").cast("double"), 3))


@query("golden_q05_top_vendors", with_invoices("""
SELECT vendor_name, CAST(sum(invoice_amount) AS DOUBLE) AS total_spend FROM inv GROUP BY 1
ORDER BY total_spend DESC, vendor_name LIMIT 5"""))
def _(spark, sf):
    return amounts(p.golden(b.invoices(spark, sf), "q05"), "total_spend")


@query("golden_q06_invoices_by_status", with_invoices(
    "SELECT approval_status, count(*) AS invoice_count FROM inv GROUP BY 1"))
def _(spark, sf):
    return p.golden(b.invoices(spark, sf), "q06")


@query("golden_q07_vendor_spending", with_invoices(
    "SELECT vendor_name, CAST(sum(invoice_amount) AS DOUBLE) AS total_spend FROM inv GROUP BY 1"))
def _(spark, sf):
    return amounts(p.golden(b.invoices(spark, sf), "q07"), "total_spend")


@query("golden_q08_spend_with_one_vendor", with_invoices(
    "SELECT CAST(sum(invoice_amount) AS DOUBLE) AS total_spend FROM inv WHERE vendor_name = 'Customer#000000007'"))
def _(spark, sf):
    return amounts(p.spend_with(b.invoices(spark, sf), "Customer#000000007"), "total_spend")


@query("golden_q09_breakdown_by_system", with_invoices(
    "SELECT source_system, count(*) AS invoice_count FROM inv GROUP BY 1"))
def _(spark, sf):
    return p.golden(b.invoices(spark, sf), "q09")


@query("golden_q10_spend_trend", with_invoices("""
SELECT CAST(date_trunc('month', invoice_date) AS DATE) AS invoice_month, CAST(sum(invoice_amount) AS DOUBLE) AS total_spend
FROM inv WHERE invoice_date >= DATE '1998-01-01' AND invoice_date < DATE '1999-01-01' GROUP BY 1"""))
def _(spark, sf):
    return amounts(p.spend_trend(b.invoices(spark, sf), 1998), "total_spend")


@query("golden_q11_overdue_invoices", with_invoices(f"SELECT {ALL} FROM inv WHERE due_date < DATE '2001-01-01'"))
def _(spark, sf):
    return amounts(p.golden(b.invoices(spark, sf), "q11", b.AS_OF), "invoice_amount")


@query("golden_q12_invoices_over_amount", with_invoices(f"SELECT {ALL} FROM inv WHERE invoice_amount > 100000"))
def _(spark, sf):
    return amounts(p.golden(b.invoices(spark, sf), "q12"), "invoice_amount")


@query("golden_q13_recent_invoices", with_invoices(
    f"SELECT {ALL} FROM inv WHERE invoice_date >= (SELECT max(invoice_date) - 30 FROM inv)"))
def _(spark, sf):
    return amounts(p.golden(b.invoices(spark, sf), "q13"), "invoice_amount")


@query("golden_q15_total_spend", with_invoices("SELECT CAST(sum(invoice_amount) AS DOUBLE) AS total_spend FROM inv"))
def _(spark, sf):
    return amounts(p.golden(b.invoices(spark, sf), "q15"), "total_spend")


@query("overdue_ranking_by_vendor", with_invoices("""
SELECT vendor_name, CAST(sum(CASE WHEN due_date < DATE '2001-01-01' THEN invoice_amount ELSE 0 END) AS DOUBLE) AS vendor_total_overdue_amount
FROM inv GROUP BY 1"""))
def _(spark, sf):
    return amounts(p.overdue_by_vendor(b.invoices(spark, sf), b.AS_OF), "vendor_total_overdue_amount")


@query("join_back_source_columns", with_invoices("""
SELECT invoice_id, source_system,
  CASE WHEN source_system = 'SAP' THEN CAST(c_nationkey AS VARCHAR) END AS sap_company_code,
  CASE WHEN source_system = 'ORACLE' THEN o_orderpriority END AS oracle_source,
  CASE WHEN source_system = 'BAAN' THEN CAST(c_nationkey AS VARCHAR) END AS ban_company,
  CASE WHEN source_system = 'WORKDAY' THEN CASE WHEN c_nationkey < 9 THEN 'WD-T1' ELSE 'WD-T2' END END AS wd_tenant_id
FROM inv JOIN tagged ON invoice_number = pre || '-INV-' || o_orderkey"""))
def _(spark, sf):
    sources = b.invoice_sources(spark, sf)
    landing = {tag: (df, p.MAPPINGS[tag]["invoice_id"], p.SOURCE_ONLY[tag]) for tag, df in sources.items()}
    back = join_back(p.conform(sources), landing)
    return back.select("invoice_id", "source_system", "sap_company_code", "oracle_source", "ban_company", "wd_tenant_id")


# --- layer above ---------------------------------------------------------------

def _rates(spark):
    return spark.createDataFrame([("EUR", "1.10"), ("GBP", "1.25")], "currency_code string, rate string")


USD = """CAST(round(invoice_amount * CASE currency_code WHEN 'EUR' THEN 1.10 WHEN 'GBP' THEN 1.25 ELSE 1.00 END, 2) AS DOUBLE)"""


@query("gold_currency_conversion", with_invoices(
    f"SELECT invoice_id, currency_code, {USD} AS amount_usd FROM inv"))
def _(spark, sf):
    df = gold.convert_currency(b.invoices(spark, sf), _rates(spark))
    return amounts(df.select("invoice_id", "currency_code", "amount_usd"), "amount_usd")


@query("gold_payment_terms", with_invoices("""
SELECT payment_terms, 'NET' || regexp_extract(payment_terms, '[0-9]+') AS normal_terms,
  CAST(regexp_extract(payment_terms, '[0-9]+') AS INTEGER) AS payment_days, count(*) AS invoice_count
FROM inv GROUP BY ALL"""))
def _(spark, sf):
    df = b.invoices(spark, sf).groupBy("payment_terms").agg(F.count(F.lit(1)).alias("invoice_count"))
    return df.select("payment_terms", gold.normal_terms("payment_terms").alias("normal_terms"),
                     gold.payment_days("payment_terms").alias("payment_days"), "invoice_count")


@query("gold_chart_of_accounts", with_invoices("""
SELECT source_system, account_group, count(*) AS invoice_count, CAST(sum(invoice_amount) AS DOUBLE) AS total_spend
FROM inv LEFT JOIN (SELECT n_nationkey, r_name AS account_group FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA')
  ON CAST(right(gl_account, 3) AS INTEGER) = n_nationkey GROUP BY 1, 2"""))
def _(spark, sf):
    groups = b.table(spark, sf, "nation").join(
        b.table(spark, sf, "region").where("r_name <> 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey"))
    codes = F.concat(F.col("prefix"), F.lit("-GL-"), F.lpad(F.col("n_nationkey").cast("string"), 3, "0"))
    tags = F.explode(F.create_map(*[F.lit(x) for pair in b.PREFIX.items() for x in pair])).alias("source_system", "prefix")
    chart = groups.select("n_nationkey", "r_name", tags).select(
        "source_system", codes.alias("gl_account"), F.col("r_name").alias("account_group"))
    df = gold.map_accounts(b.invoices(spark, sf), chart).groupBy("source_system", "account_group").agg(
        F.count(F.lit(1)).alias("invoice_count"), F.sum("invoice_amount").alias("total_spend"))
    return amounts(df, "total_spend")


@query("guardrail_high_value", with_invoices(f"""
SELECT source_system, count(*) AS invoice_count,
  count(*) FILTER (WHERE {USD} > 500000) AS high_value_count,
  count(*) FILTER (WHERE {USD} > 500000) > 20 AS alert
FROM inv GROUP BY 1"""))
def _(spark, sf):
    usd = gold.convert_currency(b.invoices(spark, sf), _rates(spark))
    return gold.high_value_alert(gold.flag_high_value(usd), expected=20)
