"""Invoices of four source systems for the tests: ordinary rows and the edge
cases the rules speak of."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from freshet.sources import schemas


def day(text):
    return dt.date.fromisoformat(text)


def at(text):
    return dt.datetime.fromisoformat(text)


SAP = [
    ("SAP-001", "INV-1", "V-1", "Acme Industrial Supply", day("2025-01-10"), day("2025-02-09"), Decimal("12500.00"), "USD", "NET30",
     "PO-1", "hydraulic pump", "400100", "CC-1", "APPROVED", at("2025-01-10 08:00:00"), "1000", "RE"),
    ("SAP-002", "INV-2", "V-1", "Acme Industrial Supply", day("2025-03-01"), day("2025-04-30"), Decimal("28200.00"), "USD", "NET60",
     "PO-2", "hydraulic hose and pump", "400100", "CC-1", "BLOCKED", at("2025-03-01 08:00:00"), "1000", "RE"),
    ("SAP-003", "INV-3", "V-2", "Müller GmbH", day("2025-05-20"), day("2025-06-19"), Decimal("100000.00"), "EUR", "NET30",
     None, "safety gloves", "400200", "CC-2", None, at("2025-05-20 08:00:00"), "2000", "RE"),
]
ORACLE = [
    ("ORA-001", "O-1", "S-1", "Summit Energy Corp", day("2025-02-01"), day("2025-03-03"), Decimal("600000.00"), "USD", "N30",
     "PO-9", "power contract", "5-100", "D-1", "VALIDATED", at("2025-02-01 08:00:00"), "81", "MANUAL"),
    ("ORA-002", "O-2", "S-1", "Summit Energy Corp", day("2025-02-10"), day("2025-07-01"), Decimal("-500.00"), "USD", "N30",
     "PO-9", "credit memo", "5-100", "D-1", "REJECTED", at("2025-02-10 08:00:00"), "81", "MANUAL"),
    ("ORA-003", "O-3", "S-2", "Apex Staffing", day("2025-04-01"), day("2025-05-01"), Decimal("900.50"), "GBP", "N60",
     "PO-8", None, "5-200", "D-2", None, at("2025-04-01 08:00:00"), "82", "EDI"),
]
BAAN = [
    ("BAN-001", "BN-1", "BV-1", "Nordic Metals AB", day("2025-02-01"), day("2025-03-03"), Decimal("27500.00"), "EUR", "N30",
     "BP-1", "aluminium", "GL-510", "BC-MF", "POSTED", at("2025-02-01 06:00:00"), "BN-100"),
    ("BAN-002", "BN-1", "BV-1", "Nordic Metals AB", day("2025-02-01"), day("2025-03-03"), Decimal("27600.00"), "EUR", "N30",
     "BP-1", "aluminium", "GL-510", "BC-MFG", "POSTED", at("2025-02-02 06:00:00"), "BN-100"),
    ("BAN-003", "BN-2", "BV-2", "Zürich Consulting", day("2025-04-01"), day("2025-05-01"), Decimal("55000.00"), "EUR", "N30",
     None, "consulting", "GL-620", "BC-IT", "PENDING", at("2025-04-01 08:00:00"), "BN-100"),
    ("BAN-004", "BN-2", "BV-2", "Zürich Consulting", day("2025-04-01"), day("2025-05-01"), Decimal("55001.00"), "EUR", "N30",
     None, "consulting", "GL-620", "BC-IT", "OPEN", at("2025-04-01 08:00:00"), "BN-100"),
    ("BAN-005", None, "BV-3", "Nameless", day("2025-04-01"), day("2025-05-01"), Decimal("1.00"), "EUR", "N30",
     None, "x", "GL-620", "BC-IT", None, at("2025-04-01 08:00:00"), "BN-100"),
    ("BAN-006", None, "BV-3", "Nameless", day("2025-04-02"), day("2025-05-01"), Decimal("2.00"), "EUR", "N30",
     None, "x", "GL-620", "BC-IT", "APPROVED", at("2025-04-02 08:00:00"), "BN-100"),
]
WORKDAY = [
    ("WD-001", "WD-AP-1", "WS-1", "National Insurance", day("2025-05-01"), day("2025-06-01"), Decimal("133500.00"), "USD", "Net 30",
     "WPO-1", "insurance", "LA-1000", "WCC-0001", "Approved", at("2025-05-01 08:00:00"), "WD-T1"),
    ("WD-002", "WD-AP-2", "WS-2", "TechServ", day("2025-05-02"), day("2025-06-02"), Decimal("10.00"), "GBP", "Net 60",
     None, "laptops", "LA-1000", "WCC-0001", "In Review", at("2025-05-02 08:00:00"), "WD-T2"),
    ("WD-003", "WD-AP-3", "WS-2", "TechServ", day("2025-05-03"), day("2025-06-03"), Decimal("20.00"), "GBP", "Net 60",
     None, "laptops", "LA-1000", "WCC-0001", "Canceled", at("2025-05-03 08:00:00"), "WD-T2"),
]


def sources(spark):
    return {
        "SAP": spark.createDataFrame(SAP, schemas.SAP_INVOICES),
        "ORACLE": spark.createDataFrame(ORACLE, schemas.ORACLE_INVOICES),
        "BAAN": spark.createDataFrame(BAAN, schemas.BAAN_INVOICES),
        "WORKDAY": spark.createDataFrame(WORKDAY, schemas.WORKDAY_INVOICES),
    }
