"""Metric queries over named tables: metrics by dimensions, with synonyms and
declared many-to-one relationships."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class KeyViolation(ValueError):
    """A declared key is not unique."""


@dataclass(frozen=True)
class LogicalTable:
    """``facts``, ``dimensions`` and ``metrics`` map names to SQL expressions;
    facts and dimensions are per row, metrics are aggregates over them."""

    primary_key: Sequence[str]
    facts: Mapping[str, str] = field(default_factory=dict)
    dimensions: Mapping[str, str] = field(default_factory=dict)
    metrics: Mapping[str, str] = field(default_factory=dict)
    synonyms: Sequence[str] = ()


@dataclass(frozen=True)
class ManyToOne:
    """Rows of ``many`` point at one row of ``one``."""

    many: str
    many_columns: Sequence[str]
    one: str
    one_columns: Sequence[str]


@dataclass(frozen=True)
class SemanticModel:
    tables: Mapping[str, LogicalTable]
    relations: Sequence[ManyToOne] = ()
    synonyms: Mapping[str, str] = field(default_factory=dict)

    # --- names ---------------------------------------------------------------

    def resolve(self, name: str) -> str:
        """A table, dimension or metric by its name or one of its synonyms."""
        for table, spec in self.tables.items():
            if name.lower() in (table.lower(), *[s.lower() for s in spec.synonyms]):
                return table
        return {s.lower(): target for s, target in self.synonyms.items()}.get(name.lower(), name)

    def _owner(self, kind: str, name: str) -> str:
        for table, spec in self.tables.items():
            if name in getattr(spec, kind):
                return table
        raise KeyError(f"no {kind[:-1]} is called {name!r}")

    def _relation(self, many: str, one: str) -> ManyToOne:
        for relation in self.relations:
            if relation.many == many and relation.one == one:
                return relation
        raise KeyError(f"no relationship leads from {many} to {one}")

    # --- checks ----------------------------------------------------------------

    def check_keys(self, frames: Mapping[str, DataFrame]) -> None:
        """Refuse tables whose primary key or relationship target is not
        unique: a metric over the join would count rows twice."""
        wanted = [(name, tuple(spec.primary_key)) for name, spec in self.tables.items()]
        wanted += [(r.one, tuple(r.one_columns)) for r in self.relations]
        for name, key in dict.fromkeys(wanted):
            repeated = frames[name].groupBy(*key).count().where(F.col("count") > 1).limit(1)
            if not repeated.isEmpty():
                raise KeyViolation(f"{key} is not unique in {name}")

    # --- queries -----------------------------------------------------------------

    def _home(self, table: str, name: str) -> str | None:
        """The table that gives ``table`` a dimension or fact: itself, or the
        one side of a relationship; None if it is out of reach."""
        for other in (table, *(r.one for r in self.relations if r.many == table)):
            if name in self.tables[other].dimensions or name in self.tables[other].facts:
                return other
        return None

    def _predicates(self, where: str | Mapping[str, str] | None) -> list[tuple[list[str], str]]:
        """Filters as (names they need, SQL).  In a text, names of dimensions
        and facts are recognised as whole words."""
        known = {n for spec in self.tables.values() for n in (*spec.dimensions, *spec.facts)}
        if where is None:
            return []
        if not isinstance(where, str):
            return [([self.resolve(n)], sql) for n, sql in where.items()]
        return [([n for n in sorted(known) if re.search(rf"\b{re.escape(n)}\b", where)], where)]

    def _rows(self, table: str, dimensions: Sequence[str], frames: Mapping[str, DataFrame]) -> DataFrame:
        """The table with its facts and the wanted dimensions (or foreign
        facts) as columns, joining the one side where one lives there."""
        spec = self.tables[table]
        named = {**spec.facts, **{d: spec.dimensions[d] for d in dimensions if d in spec.dimensions}}
        rows = frames[table].withColumns({n: F.expr(e) for n, e in named.items()})
        foreign: dict[str, list[str]] = {}
        for d in dimensions:
            if d not in named:
                foreign.setdefault(self._home(table, d) or self._owner("dimensions", d), []).append(d)
        for other, names in foreign.items():
            formulas = {**self.tables[other].facts, **self.tables[other].dimensions}
            relation = self._relation(table, other)
            keys = [F.col(c).alias(f"_k{i}") for i, c in enumerate(relation.one_columns)]
            looked_up = frames[other].select(*keys, *[F.expr(formulas[n]).alias(n) for n in names])
            equal = [rows[c] == looked_up[f"_k{i}"] for i, c in enumerate(relation.many_columns)]
            rows = rows.join(looked_up, equal, "left").drop(*[f"_k{i}" for i in range(len(keys))])
        return rows

    def query(
        self, frames: Mapping[str, DataFrame], metrics: Sequence[str], dimensions: Sequence[str] = (),
        where: str | Mapping[str, str] | None = None, order: Sequence[Column | str] = (), limit: int | None = None,
    ) -> DataFrame:
        """Metrics grouped by dimensions.

        Metrics of different tables are aggregated apart and put together on
        the dimensions afterwards, so no table multiplies another.

        ``where`` is a condition over dimensions and facts, selected or not and
        on either side of a relationship, or a mapping of names to conditions.
        Each condition holds for every table that reaches its names; one that
        no table reaches is refused.
        """
        metrics = [self.resolve(m) for m in metrics]
        dimensions = [self.resolve(d) for d in dimensions]
        by_table: dict[str, list[str]] = {}
        for m in metrics:
            by_table.setdefault(self._owner("metrics", m), []).append(m)
        conditions = self._predicates(where)
        for needed, sql in conditions:
            if not any(all(self._home(t, n) for n in needed) for t in by_table):
                raise KeyError(f"no table of {list(metrics)} reaches the names in {sql!r}")
        parts = []
        for table, names in by_table.items():
            own = [(needed, sql) for needed, sql in conditions if all(self._home(table, n) for n in needed)]
            wanted = list(dict.fromkeys([*dimensions, *(n for needed, _ in own for n in needed)]))
            rows = self._rows(table, wanted, frames)
            for _, sql in own:
                rows = rows.where(sql)
            parts.append(rows.groupBy(*dimensions).agg(*[F.expr(self.tables[table].metrics[n]).alias(n) for n in names]))
        result = parts[0]
        for part in parts[1:]:
            result = result.unionByName(part, allowMissingColumns=True)
        if len(parts) > 1:
            # each metric is set in one part only, so MAX picks that value; this
            # matches NULL dimension values, which a join would not
            result = result.groupBy(*dimensions).agg(*[F.max(m).alias(m) for m in metrics])
        result = result.select(*dimensions, *metrics)
        if order:
            result = result.orderBy(*order)
        return result if limit is None else result.limit(limit)


# The accounts-payable model, its names and formulas.
INVOICE_MODEL = SemanticModel(
    tables={
        "invoices": LogicalTable(
            primary_key=["invoice_id"],
            facts={"invoice_amount": "invoice_amount"},
            dimensions={
                "vendor_name": "vendor_name",
                "source_system": "source_system",
                "approval_status": "approval_status",
                "currency_code": "currency_code",
                "invoice_date": "invoice_date",
                "due_date": "due_date",
                "invoice_month": "trunc(invoice_date, 'MM')",
            },
            metrics={
                "total_spend": "sum(invoice_amount)",
                "invoice_count": "count(invoice_id)",
                "avg_invoice_amount": "avg(invoice_amount)",
            },
            synonyms=["invoice", "AP invoice", "bill"],
        ),
        "vendor_summary": LogicalTable(
            primary_key=["vendor_name"],
            facts={"vendor_total_spend": "total_spend", "vendor_total_overdue_amount": "total_overdue_amount"},
            dimensions={"vendor_name": "vendor_name"},
            metrics={
                "spend_by_vendor": "sum(vendor_total_spend)",
                "overdue_by_vendor": "sum(vendor_total_overdue_amount)",
            },
            synonyms=["vendor", "supplier"],
        ),
    },
    synonyms={"supplier name": "vendor_name"},
)
