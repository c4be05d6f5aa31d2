"""Accounts payable: four landing tables to one conformed invoice table, the
vendor rollup on top of it, and the business questions asked of both."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import overdue, sum_where, value_map
from ..operators.relational import recent
from ..operators.windows import keep_latest
from ..sources.schemas import CONFORMED_COLUMNS

# Conformed column -> native column, per source system.
MAPPINGS: dict[str, dict[str, str]] = {
    "SAP": {name: name for name in CONFORMED_COLUMNS if name != "source_system"},
    "ORACLE": {
        "invoice_id": "inv_id",
        "invoice_number": "inv_num",
        "vendor_id": "supplier_id",
        "vendor_name": "supplier_name",
        "invoice_date": "inv_date",
        "due_date": "payment_due_date",
        "invoice_amount": "total_amount",
        "currency_code": "currency",
        "payment_terms": "terms_code",
        "po_number": "purchase_order",
        "line_description": "description",
        "gl_account": "account_code",
        "cost_center": "dept_code",
        "approval_status": "status",
        "created_at": "creation_date",
    },
    "BAAN": {
        "invoice_id": "ban_invoice_id",
        "invoice_number": "ban_invoice_ref",
        "vendor_id": "ban_vendor_code",
        "vendor_name": "ban_vendor_desc",
        "invoice_date": "ban_inv_date",
        "due_date": "ban_pay_date",
        "invoice_amount": "ban_amount",
        "currency_code": "ban_curr",
        "payment_terms": "ban_pay_terms",
        "po_number": "ban_po_ref",
        "line_description": "ban_line_desc",
        "gl_account": "ban_gl_code",
        "cost_center": "ban_cost_ctr",
        "approval_status": "ban_status",
        "created_at": "ban_created",
    },
    "WORKDAY": {
        "invoice_id": "wd_invoice_id",
        "invoice_number": "wd_invoice_num",
        "vendor_id": "wd_supplier_id",
        "vendor_name": "wd_supplier_name",
        "invoice_date": "wd_invoice_date",
        "due_date": "wd_due_date",
        "invoice_amount": "wd_amount",
        "currency_code": "wd_currency",
        "payment_terms": "wd_pay_terms",
        "po_number": "wd_po_number",
        "line_description": "wd_memo",
        "gl_account": "wd_ledger_account",
        "cost_center": "wd_cost_center",
        "approval_status": "wd_approval_status",
        "created_at": "wd_created_date",
    },
}

# Native status -> APPROVED or PENDING.  Statuses not listed are
# PENDING; SAP already uses the conformed words and passes through unmapped.
STATUS_MAPS: dict[str, dict[str, str]] = {
    "ORACLE": {"VALIDATED": "APPROVED", "APPROVED": "APPROVED"},
    "BAAN": {"POSTED": "APPROVED", "APPROVED": "APPROVED"},
    "WORKDAY": {"Approved": "APPROVED", "In Review": "PENDING"},
}

# Columns that stay in the landing tables (fixed values).
SOURCE_ONLY = {
    "SAP": ["sap_company_code", "sap_document_type"],
    "ORACLE": ["oracle_org_id", "oracle_source"],
    "BAAN": ["ban_company"],
    "WORKDAY": ["wd_tenant_id"],
}


def conform_one(df: DataFrame, tag: str, mapping: Mapping[str, str], statuses: Mapping[str, str] | None) -> DataFrame:
    """One source in the conformed shape: renamed, status mapped, tagged."""
    columns = []
    for name in CONFORMED_COLUMNS:
        if name == "source_system":
            columns.append(F.lit(tag).alias(name))
        elif name == "approval_status" and statuses is not None:
            columns.append(value_map(mapping[name], statuses, "PENDING").alias(name))
        else:
            columns.append(F.col(mapping[name]).alias(name))
    return df.select(*columns)


def drop_resends(baan: DataFrame) -> DataFrame:
    """Invoices sent again under a new id: the latest row per reference wins,
    and rows without a reference count as one reference."""
    return keep_latest(baan, ["ban_invoice_ref"], [F.col("ban_created").desc(), F.col("ban_invoice_id").desc()])


def conform(sources: Mapping[str, DataFrame], mappings=MAPPINGS, status_maps=STATUS_MAPS, dedup=None) -> DataFrame:
    """UNION ALL of all sources in the conformed shape.

    ``dedup`` maps a source tag to a function over its landing table; by
    default resends are dropped for BAAN and for no other source.
    """
    dedup = {"BAAN": drop_resends} if dedup is None else dedup
    branches = [
        conform_one(dedup.get(tag, lambda df: df)(df), tag, mappings[tag], status_maps.get(tag))
        for tag, df in sources.items()
    ]
    return reduce(DataFrame.unionByName, branches)


def vendor_summary(invoices: DataFrame, as_of=None) -> DataFrame:
    """One row per vendor name.  Amounts of different currencies are added up
    as they are; ``vendor_currency_summary`` keeps them apart."""
    return _summary(invoices, ["vendor_name"], as_of)


def vendor_currency_summary(invoices: DataFrame, as_of=None) -> DataFrame:
    """The vendor rollup with one row per vendor and currency."""
    return _summary(invoices, ["vendor_name", "currency_code"], as_of)


def _summary(invoices: DataFrame, keys: list[str], as_of) -> DataFrame:
    """Aggregated per (keys, source) first: that makes the distinct count of
    sources a plain count, spreads a large vendor over its sources, and leaves
    the second shuffle a handful of rows per vendor."""
    money = {
        "total_spend": F.sum("invoice_amount"),
        "total_pending_amount": sum_where(F.col("approval_status") == "PENDING", "invoice_amount"),
        "total_overdue_amount": sum_where(overdue("due_date", as_of), "invoice_amount"),
    }
    per_source = invoices.groupBy(*keys, "source_system").agg(
        F.count(F.lit(1)).alias("invoice_count"), *[total.alias(name) for name, total in money.items()],
        F.min("invoice_date").alias("first_invoice_date"), F.max("invoice_date").alias("last_invoice_date"),
    )
    return per_source.groupBy(*keys).agg(
        F.sum("invoice_count").alias("invoice_count"),
        *[F.sum(name).cast("decimal(28,2)").alias(name) for name in money],
        F.min("first_invoice_date").alias("first_invoice_date"), F.max("last_invoice_date").alias("last_invoice_date"),
        F.count("source_system").alias("source_system_count"),
    )


# --- business questions ------------------------------------------------------

def spend_by_vendor(invoices: DataFrame) -> DataFrame:
    return invoices.groupBy("vendor_name").agg(F.sum("invoice_amount").alias("total_spend")).orderBy(
        F.col("total_spend").desc(), "vendor_name"
    )


def invoices_per_month(invoices: DataFrame) -> DataFrame:
    return invoices.groupBy(F.trunc("invoice_date", "MM").alias("invoice_month")).agg(
        F.count(F.lit(1)).alias("invoice_count")
    ).orderBy("invoice_month")


def invoices_by(invoices: DataFrame, column: str) -> DataFrame:
    return invoices.groupBy(column).agg(F.count(F.lit(1)).alias("invoice_count")).orderBy(
        F.col("invoice_count").desc(), column
    )


def average_by_currency(invoices: DataFrame) -> DataFrame:
    return invoices.groupBy("currency_code").agg(F.avg("invoice_amount").alias("avg_invoice_amount")).orderBy("currency_code")


def top_vendors(invoices: DataFrame, k: int = 5) -> DataFrame:
    return spend_by_vendor(invoices).limit(k)


def spend_with(invoices: DataFrame, vendor: str) -> DataFrame:
    return invoices.where(F.col("vendor_name") == vendor).agg(F.sum("invoice_amount").alias("total_spend"))


def spend_trend(invoices: DataFrame, year: int) -> DataFrame:
    inside = (F.col("invoice_date") >= F.make_date(F.lit(year), F.lit(1), F.lit(1))) & (
        F.col("invoice_date") < F.make_date(F.lit(year + 1), F.lit(1), F.lit(1))
    )
    return invoices.where(inside).groupBy(F.trunc("invoice_date", "MM").alias("invoice_month")).agg(
        F.sum("invoice_amount").alias("total_spend")
    ).orderBy("invoice_month")


def overdue_invoices(invoices: DataFrame, as_of=None) -> DataFrame:
    return invoices.where(overdue("due_date", as_of)).orderBy("due_date", "invoice_date")


def invoices_over(invoices: DataFrame, amount) -> DataFrame:
    return invoices.where(F.col("invoice_amount") > amount).orderBy(F.col("invoice_amount").desc())


def recent_invoices(invoices: DataFrame, days: int = 30) -> DataFrame:
    return recent(invoices, "invoice_date", days).orderBy(F.col("invoice_date").desc())


def total_spend(invoices: DataFrame) -> DataFrame:
    return invoices.agg(F.sum("invoice_amount").alias("total_spend"))


def overdue_by_vendor(invoices: DataFrame, as_of=None) -> DataFrame:
    """Vendors by overdue amount, highest first."""
    return invoices.groupBy("vendor_name").agg(
        sum_where(overdue("due_date", as_of), "invoice_amount").alias("vendor_total_overdue_amount")
    ).orderBy(F.col("vendor_total_overdue_amount").desc(), "vendor_name")


# Golden question id -> plan over (invoices, reporting day).  q14 ("which
# vendors are problematic?") has no agreed meaning and therefore no plan.
GOLDEN = {
    "q01": lambda inv, as_of: spend_by_vendor(inv),
    "q02": lambda inv, as_of: invoices_per_month(inv),
    "q03": lambda inv, as_of: invoices_by(inv, "source_system"),
    "q04": lambda inv, as_of: average_by_currency(inv),
    "q05": lambda inv, as_of: top_vendors(inv, 5),
    "q06": lambda inv, as_of: invoices_by(inv, "approval_status"),
    "q07": lambda inv, as_of: spend_by_vendor(inv),
    "q08": lambda inv, as_of: spend_with(inv, "Acme Industrial Supply"),
    "q09": lambda inv, as_of: invoices_by(inv, "source_system"),
    "q10": lambda inv, as_of: spend_trend(inv, 2025),
    "q11": lambda inv, as_of: overdue_invoices(inv, as_of),
    "q12": lambda inv, as_of: invoices_over(inv, 100000),
    "q13": lambda inv, as_of: recent_invoices(inv),
    "q15": lambda inv, as_of: total_spend(inv),
}


def golden(invoices: DataFrame, question: str, as_of=None) -> DataFrame:
    return GOLDEN[question](invoices, as_of)
