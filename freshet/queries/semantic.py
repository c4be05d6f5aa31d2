"""Metric queries through the semantic model."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import bindings as b
from ..plans import invoices as p
from ..plans.semantic import INVOICE_MODEL, LogicalTable, ManyToOne, SemanticModel
from . import query
from .fragments import with_invoices
from .invoices import amounts


def frames(spark, sf):
    invoices = b.invoices(spark, sf)
    return {"invoices": invoices, "vendor_summary": p.vendor_summary(invoices, b.AS_OF)}


@query("metrics_by_source_and_status", with_invoices("""
SELECT source_system, approval_status, CAST(sum(invoice_amount) AS DOUBLE) AS total_spend, count(invoice_id) AS invoice_count FROM inv GROUP BY 1, 2"""))
def _(spark, sf):
    df = INVOICE_MODEL.query(frames(spark, sf), ["total_spend", "invoice_count"], ["source_system", "approval_status"])
    return amounts(df, "total_spend")


@query("metrics_filtered_ordered_limited", with_invoices("""
SELECT vendor_name, CAST(sum(invoice_amount) AS DOUBLE) AS total_spend FROM inv WHERE currency_code = 'EUR' GROUP BY 1 ORDER BY total_spend DESC, vendor_name LIMIT 10"""))
def _(spark, sf):
    df = INVOICE_MODEL.query(frames(spark, sf), ["total_spend"], ["supplier name"], where="currency_code = 'EUR'",
                             order=[F.col("total_spend").desc(), "vendor_name"], limit=10)
    return amounts(df, "total_spend")


@query("metrics_of_two_tables", with_invoices("""
SELECT vendor_name, count(invoice_id) AS invoice_count, CAST(sum(invoice_amount) AS DOUBLE) AS spend_by_vendor,
  CAST(sum(CASE WHEN due_date < DATE '2001-01-01' THEN invoice_amount ELSE 0 END) AS DOUBLE) AS overdue_by_vendor FROM inv GROUP BY 1"""))
def _(spark, sf):
    df = INVOICE_MODEL.query(frames(spark, sf), ["invoice_count", "spend_by_vendor", "overdue_by_vendor"], ["vendor_name"])
    return amounts(df, "spend_by_vendor", "overdue_by_vendor")


@query("metrics_filtered_by_unselected_month", with_invoices("""
SELECT vendor_name, CAST(sum(invoice_amount) AS DOUBLE) AS total_spend FROM inv
WHERE date_trunc('month', invoice_date) >= DATE '1996-01-01' AND invoice_amount > 1000 GROUP BY 1"""))
def _(spark, sf):
    df = INVOICE_MODEL.query(frames(spark, sf), ["total_spend"], ["vendor_name"],
                             where="invoice_month >= DATE '1996-01-01' AND invoice_amount > 1000")
    return amounts(df, "total_spend")


@query("metrics_of_two_tables_filtered", with_invoices("""
SELECT a.vendor_name, invoice_count, spend_by_vendor FROM
  (SELECT vendor_name, CAST(sum(invoice_amount) AS DOUBLE) AS spend_by_vendor FROM inv GROUP BY 1) a
  LEFT JOIN (SELECT vendor_name, count(invoice_id) AS invoice_count FROM inv WHERE currency_code = 'EUR' GROUP BY 1) b USING (vendor_name)"""))
def _(spark, sf):
    df = INVOICE_MODEL.query(frames(spark, sf), ["invoice_count", "spend_by_vendor"], ["vendor_name"], where={"currency_code": "currency_code = 'EUR'"})
    return amounts(df, "spend_by_vendor")


@query("metrics_by_month", with_invoices("""
SELECT CAST(date_trunc('month', invoice_date) AS DATE) AS invoice_month, count(*) AS invoice_count FROM inv GROUP BY 1"""))
def _(spark, sf):
    return INVOICE_MODEL.query(frames(spark, sf), ["invoice_count"], ["invoice_month"])


@query("metrics_total", with_invoices("SELECT CAST(sum(invoice_amount) AS DOUBLE) AS total_spend, count(*) AS invoice_count FROM inv"))
def _(spark, sf):
    return amounts(INVOICE_MODEL.query(frames(spark, sf), ["total_spend", "invoice_count"]), "total_spend")


ORDER_MODEL = SemanticModel(
    tables={
        "orders": LogicalTable(
            primary_key=["o_orderkey"], facts={"amount": "cast(o_totalprice as decimal(18,2))"},
            dimensions={"status": "o_orderstatus"}, metrics={"revenue": "sum(amount)", "orders": "count(o_orderkey)"}),
        "customer": LogicalTable(primary_key=["c_custkey"], dimensions={"segment": "c_mktsegment"}, metrics={"customers": "count(c_custkey)"}),
    },
    relations=[ManyToOne("orders", ["o_custkey"], "customer", ["c_custkey"])],
    synonyms={"turnover": "revenue"},
)


@query("metrics_over_relationship", """
SELECT c_mktsegment AS segment, o_orderstatus AS status, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue, count(*) AS orders
FROM orders LEFT JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2""")
def _(spark, sf):
    tables = {"orders": b.table(spark, sf, "orders"), "customer": b.table(spark, sf, "customer")}
    ORDER_MODEL.check_keys(tables)
    return amounts(ORDER_MODEL.query(tables, ["turnover", "orders"], ["segment", "status"]), "revenue")


@query("metrics_filtered_over_relationship", """
SELECT o_orderstatus AS status, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue, count(*) AS orders
FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment = 'BUILDING' GROUP BY 1""")
def _(spark, sf):
    tables = {"orders": b.table(spark, sf, "orders"), "customer": b.table(spark, sf, "customer")}
    return amounts(ORDER_MODEL.query(tables, ["turnover", "orders"], ["status"], where="segment = 'BUILDING'"), "revenue")
