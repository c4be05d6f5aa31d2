"""Rules specified for the layer above the conformed table: currency
conversion, payment terms, chart of accounts, and the amount guardrail.  Rates
and mappings are input tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: invoices above this amount (in USD) are flagged for review.
HIGH_VALUE_USD = 500000


def convert_currency(invoices: DataFrame, rates: DataFrame, target: str = "USD") -> DataFrame:
    """Add the amount in ``target`` currency; a currency without a rate gives
    NULL, never a guess.  ``rates``: (currency_code, rate)."""
    known = rates.select("currency_code", F.col("rate").cast("decimal(18,8)").alias("_rate"))
    rate = F.when(F.col("currency_code") == target, F.lit(1).cast("decimal(18,8)")).otherwise(F.col("_rate"))
    return (
        invoices.join(known, "currency_code", "left")
        .withColumn(f"amount_{target.lower()}", (F.col("invoice_amount") * rate).cast("decimal(18,2)"))
        .drop("_rate")
    )


def payment_days(terms: Column | str) -> Column:
    """NET30, N30 and Net 30 all give 30; anything else NULL."""
    terms = F.col(terms) if isinstance(terms, str) else terms
    days = F.regexp_extract(F.upper(F.trim(terms)), r"^N(?:ET)?\s*([0-9]+)$", 1)
    return F.nullif(days, F.lit("")).cast("int")


def normal_terms(terms: Column | str) -> Column:
    """One spelling for all sources: NET30."""
    return F.concat(F.lit("NET"), payment_days(terms).cast("string"))


def map_accounts(invoices: DataFrame, chart: DataFrame) -> DataFrame:
    """Join the chart of accounts on (source_system, gl_account); codes without
    an entry keep a NULL group."""
    return invoices.join(
        chart.select("source_system", "gl_account", "account_group"), ["source_system", "gl_account"], "left"
    )


def flag_high_value(invoices: DataFrame, amount: str = "amount_usd", threshold=HIGH_VALUE_USD) -> DataFrame:
    """Mark rows for review; no row is dropped."""
    return invoices.withColumn("high_value", F.coalesce(F.col(amount) > threshold, F.lit(False)))


def high_value_alert(flagged: DataFrame, expected: int) -> DataFrame:
    """One row per source: how many flagged, and whether that is too many."""
    return flagged.groupBy("source_system").agg(
        F.count(F.lit(1)).alias("invoice_count"), F.count_if("high_value").alias("high_value_count")
    ).withColumn("alert", F.col("high_value_count") > expected)
