import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from freshet.operators.relational import join_back
from freshet.plans import gold, rules
from freshet.plans import invoices as p
from freshet.sources.schemas import CONFORMED_COLUMNS

from . import invoice_rows as data

AS_OF = dt.date(2025, 6, 2)


def conformed(spark):
    return p.conform(data.sources(spark))


def test_shape_and_tags(spark):
    df = conformed(spark)
    assert df.columns == CONFORMED_COLUMNS
    counts = {r.source_system: r.invoice_count for r in p.invoices_by(df, "source_system").collect()}
    assert counts == {"SAP": 3, "ORACLE": 3, "BAAN": 3, "WORKDAY": 3}


def test_statuses(spark):
    status = {r.invoice_id: r.approval_status for r in conformed(spark).collect()}
    # SAP passes through unmapped, also when unknown or missing
    assert status["SAP-002"] == "BLOCKED" and status["SAP-003"] is None
    assert status["ORA-001"] == "APPROVED" and status["ORA-002"] == "PENDING" and status["ORA-003"] == "PENDING"
    assert status["BAN-002"] == "APPROVED"
    assert status["WD-001"] == "APPROVED" and status["WD-002"] == "PENDING" and status["WD-003"] == "PENDING"


def test_resends_keep_latest_with_tiebreak_and_null_reference(spark):
    kept = {r.ban_invoice_id for r in p.drop_resends(data.sources(spark)["BAAN"]).collect()}
    # newest wins; equal times fall to the higher id; all NULL references are one
    assert kept == {"BAN-002", "BAN-004", "BAN-006"}


def test_resends_are_trimmed_before_the_shuffle(spark):
    plan = p.drop_resends(data.sources(spark)["BAAN"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_vendor_summary(spark):
    summary = {r.vendor_name: r for r in p.vendor_summary(conformed(spark), AS_OF).collect()}
    acme = summary["Acme Industrial Supply"]
    assert (acme.invoice_count, acme.total_spend, acme.total_pending_amount) == (2, Decimal("40700.00"), Decimal("0.00"))
    # an invoice due on the reporting day is not overdue yet
    tech = summary["TechServ"]
    assert tech.total_overdue_amount == Decimal("0.00") and tech.total_pending_amount == Decimal("30.00")
    assert summary["National Insurance"].total_overdue_amount == Decimal("133500.00")
    assert all(r.source_system_count == 1 for r in summary.values())


def test_golden_questions(spark):
    df = conformed(spark)
    assert p.golden(df, "q08").first().total_spend == Decimal("40700.00")
    over = {r.invoice_id for r in p.golden(df, "q12").collect()}
    assert over == {"ORA-001", "WD-001"}  # exactly 100,000 is not over
    assert {r.invoice_id for r in p.golden(df, "q13").collect()} == {"SAP-003", "WD-001", "WD-002", "WD-003"}
    assert [r.vendor_name for r in p.golden(df, "q05").collect()][0] == "Summit Energy Corp"
    assert p.golden(df, "q15").first().total_spend == sum(r.invoice_amount for r in df.collect())
    for question in p.GOLDEN:
        p.golden(df, question, AS_OF).count()


def test_join_back(spark):
    sources = data.sources(spark)
    landing = {t: (df, p.MAPPINGS[t]["invoice_id"], p.SOURCE_ONLY[t]) for t, df in sources.items()}
    back = {r.invoice_id: r for r in join_back(p.conform(sources), landing).collect()}
    assert back["SAP-001"].sap_company_code == "1000" and back["WD-002"].wd_tenant_id == "WD-T2"
    assert back["WD-002"].sap_company_code is None and len(back) == 12


def test_gold_layer(spark):
    rates = spark.createDataFrame([("EUR", "1.10")], "currency_code string, rate string")
    usd = gold.flag_high_value(gold.convert_currency(conformed(spark), rates))
    rows = {r.invoice_id: r for r in usd.collect()}
    assert rows["SAP-003"].amount_usd == Decimal("110000.00")
    assert rows["WD-002"].amount_usd is None and rows["WD-002"].high_value is False  # no GBP rate
    assert [i for i, r in rows.items() if r.high_value] == ["ORA-001"]
    alerts = {r.source_system: r.alert for r in gold.high_value_alert(usd, expected=0).collect()}
    assert alerts == {"SAP": False, "ORACLE": True, "BAAN": False, "WORKDAY": False}
    terms = spark.createDataFrame([("NET30",), ("N60",), ("Net 45",), ("cash",), (None,)], "t string")
    assert [r[0] for r in terms.select(gold.normal_terms("t")).collect()] == ["NET30", "NET60", "NET45", None, None]


def test_formats(spark):
    found = {(r.source_system, r.column_name): r.violations for r in rules.format_violations(conformed(spark)).collect()}
    assert found == {}
    odd = conformed(spark).withColumn("currency_code", F.lit("USD")).withColumn("cost_center", F.lit("BC-MFGX"))
    found = {(r.source_system, r.column_name): r.violations for r in rules.format_violations(odd).collect()}
    assert found == {("BAAN", "currency_code"): 3, ("BAAN", "cost_center"): 3, ("WORKDAY", "cost_center"): 3}
