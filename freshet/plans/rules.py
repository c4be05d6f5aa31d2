"""Checks on definition rows and on data formats.  Every check returns its
violations as rows (rule, name, detail)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.schemas import CONFORMED_COLUMNS
from ..streaming.files import SHORTEST_LAG_SECONDS

# Formats agreed for the conformed columns, per source system.
FORMATS = {
    ("SAP", "invoice_id"): r"^SAP-[0-9]+$",
    ("ORACLE", "invoice_id"): r"^ORA-[0-9]+$",
    ("BAAN", "invoice_id"): r"^BAN-[0-9]+$",
    ("WORKDAY", "invoice_id"): r"^WD-[0-9]+$",
    ("BAAN", "vendor_id"): r"^BV-[0-9]+$",
    ("WORKDAY", "vendor_id"): r"^WS-[0-9]+$",
    ("BAAN", "gl_account"): r"^GL-[0-9]+$",
    ("WORKDAY", "gl_account"): r"^LA-[0-9]+$",
    ("BAAN", "cost_center"): r"^BC-[A-Z0-9]{2,3}$",
    ("WORKDAY", "cost_center"): r"^WCC-[A-Z0-9]+$",
    ("BAAN", "currency_code"): r"^(EUR|GBP)$",
    ("WORKDAY", "currency_code"): r"^(USD|EUR|GBP)$",
    ("WORKDAY", "po_number"): r"^WPO-[0-9]+$",
}
# Columns a source may leave empty.
OPTIONAL = {"po_number", "line_description"}


def _violations(rows: DataFrame, rule: str, bad: Column, detail: Column) -> DataFrame:
    return rows.where(bad).select(F.lit(rule).alias("rule"), "name", detail.alias("detail"))


def incremental_reads_full(definitions: DataFrame, edges: DataFrame) -> DataFrame:
    """An INCREMENTAL table must not read a FULL one."""
    mode = definitions.select("name", "refresh_mode")
    pairs = (
        edges.select(F.col("child").alias("name"), "parent")
        .join(mode.where("refresh_mode = 'INCREMENTAL'"), "name")
        .join(mode.where("refresh_mode = 'FULL'").select(F.col("name").alias("parent")), "parent", "left_semi")
    )
    return _violations(pairs, "incremental_reads_full", F.lit(True), F.col("parent"))


def tracking_missing(edges: DataFrame, tracked: DataFrame) -> DataFrame:
    """Base tables that are read need change tracking."""
    base = edges.where("kind = 'TABLE'").select(F.col("child").alias("name"), "parent")
    untracked = base.join(tracked.select(F.col("name").alias("parent")), "parent", "left_anti")
    return _violations(untracked, "tracking_missing", F.lit(True), F.col("parent"))


def view_between(objects: DataFrame, reads: DataFrame) -> DataFrame:
    """A view must not stand between two maintained tables."""
    maintained = objects.where("kind = 'MAINTAINED'").select("name")
    views = objects.where("kind = 'VIEW'").select("name")
    upper = reads.select(F.col("child").alias("view"), F.col("parent").alias("source"))
    lower = reads.select(F.col("child").alias("name"), F.col("parent").alias("view"))
    hops = (
        lower.join(maintained, "name", "left_semi")
        .join(views.withColumnRenamed("name", "view"), "view", "left_semi")
        .join(upper, "view")
        .join(maintained.withColumnRenamed("name", "source"), "source", "left_semi")
    )
    return _violations(hops, "view_between", F.lit(True), F.concat_ws(" > ", "source", "view"))


def start_and_backfill(definitions: DataFrame) -> DataFrame:
    """A start offset needs a backfill; a backfill of a standard table needs a
    frozen region."""
    no_backfill = F.col("start_at") & ~F.col("backfill")
    no_region = F.col("backfill") & (F.col("kind") == "STANDARD") & F.col("frozen_predicate").isNull()
    return _violations(definitions, "start_needs_backfill", no_backfill, F.col("kind")).unionByName(
        _violations(definitions, "backfill_needs_frozen_region", no_region, F.col("kind")))


def custom_limits(definitions: DataFrame) -> DataFrame:
    """Limits of custom-incremental tables: one statement, one target, declared
    columns, no reading of their own changes, no procedural code."""
    custom = definitions.where("kind = 'CUSTOM'")
    checks = {
        "one_statement": F.col("statements") != 1,
        "one_target": F.col("targets") != 1,
        "columns_declared": ~F.col("columns_declared"),
        "own_changes": F.col("reads_own_changes"),
        "procedural_code": F.col("procedural"),
    }
    failed = F.array_compact(F.array(*[F.when(bad, F.lit(rule)) for rule, bad in checks.items()]))
    return custom.select(F.explode(failed).alias("rule"), "name", F.lit("CUSTOM").alias("detail"))


def lag_too_short(definitions: DataFrame, edges: DataFrame) -> DataFrame:
    """A target lag below one minute, or below the lag of an input."""
    lag = definitions.select("name", "target_lag_sec")
    floor = _violations(lag, "lag_below_minimum", F.col("target_lag_sec") < SHORTEST_LAG_SECONDS,
                        F.col("target_lag_sec").cast("string"))
    pairs = (
        edges.select(F.col("child").alias("name"), "parent").join(lag, "name")
        .join(lag.select(F.col("name").alias("parent"), F.col("target_lag_sec").alias("_upstream")), "parent")
    )
    return floor.unionByName(
        _violations(pairs, "lag_below_upstream", F.col("target_lag_sec") < F.col("_upstream"), F.col("parent")))


def migration_blockers(tasks: DataFrame) -> DataFrame:
    """Checklist for turning a task into a maintained table: what blocks, and
    whether a custom-incremental table would do."""
    blockers = {
        "UNSUPPORTED_SOURCE": F.col("source_kind").isin("DIRECTORY TABLE", "EXTERNAL TABLE", "MATERIALIZED VIEW"),
        "SUB_MINUTE": F.col("schedule_sec") < SHORTEST_LAG_SECONDS,
        "VIEW_BETWEEN": F.col("view_between"),
        "MULTI_STATEMENT": F.col("statements") > 1,
    }
    custom = {"APPEND_ONLY_STREAM": F.col("append_only"), "STATIC_JOIN": F.col("static_join")}

    def found(checks: dict[str, Column]) -> Column:
        return F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in checks.items()]))

    rows = tasks.withColumn("_blocked", found(blockers)).withColumn("_custom", found(custom))
    verdict = (
        F.when(F.size("_blocked") > 0, "DO_NOT_MIGRATE")
        .when(F.size("_custom") > 0, "CUSTOM_INCREMENTAL").otherwise("PROCEED")
    )
    return rows.select("name", verdict.alias("recommendation"),
                       F.array_join(F.concat("_blocked", "_custom"), ",").alias("findings"))


def mapping_gaps(mapping: DataFrame, required: list[str] = CONFORMED_COLUMNS) -> DataFrame:
    """Conformed columns a source does not map, and mapping rows still open.
    ``mapping``: (source_system, target_column, status)."""
    wanted = mapping.select("source_system").distinct().select(
        "source_system", F.explode(F.array(*[F.lit(c) for c in required if c != "source_system"])).alias("target_column"))
    unmapped = wanted.join(mapping.select("source_system", F.lower("target_column").alias("target_column")),
                           ["source_system", "target_column"], "left_anti")
    still_open = mapping.where(F.col("status").like("Open%")).select("source_system", F.lower("target_column").alias("target_column"))
    return unmapped.withColumn("finding", F.lit("UNMAPPED")).unionByName(still_open.withColumn("finding", F.lit("OPEN")))


def format_violations(invoices: DataFrame, formats=FORMATS, optional=OPTIONAL) -> DataFrame:
    """How many values break the agreed format, per source and column.

    All rules are counted in one pass over the invoices; an empty value counts
    unless the column is optional.
    """
    counters = []
    for (source, column), pattern in formats.items():
        value = F.col(column)
        ok = value.rlike(pattern) | (value.isNull() & F.lit(column in optional))
        bad = (F.col("source_system") == source) & ~F.coalesce(ok, F.lit(False))
        counters.append(F.struct(F.lit(source).alias("source_system"), F.lit(column).alias("column_name"),
                                 F.count_if(bad).alias("violations")))
    return invoices.agg(F.array(*counters).alias("c")).select(F.inline("c")).where("violations > 0")


def unqualified_policies(policies: DataFrame, references: DataFrame) -> DataFrame:
    """Masking policies in use whose body names a table without its schema or
    database.  ``policies``: (policy, body); ``references``: (policy, table,
    column)."""
    plain = F.col("body").rlike(r"(?i)\b(?:from|join)\s+(?!\w+\.\w+\.\w+)\w+")
    return references.join(policies.where(plain).select("policy", "body"), "policy").select(
        F.lit("unqualified_name").alias("rule"), F.concat_ws(".", "table", "column").alias("name"), F.col("policy").alias("detail"))


def all_violations(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)
