"""Maintained tables: stored results that are refreshed from their inputs.

Each version of a table is a Parquet folder of its own, and one row in the
history table says that it is complete.  A version without a successful history
row does not exist for readers, so a refresh is all or nothing; rows are added
by Spark's commit protocol and never changed.  Deciding when to call
``refresh`` is left to whatever schedules Spark jobs.

A table with declared keys may be kept in parts: its rows are dealt to a fixed
number of buckets by the hash of the key, and a version is a manifest, a list
that names for every bucket the version whose folder holds it.  Where the
definition says which keys a change touches, an incremental refresh reads and
writes the buckets of those keys only; all other folders are shared with the
version before.  It also stores the change set of its own result, found by
comparing the touched rows before and after, so that tables above read that
and nobody compares two whole versions.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from graphlib import TopologicalSorter

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.changes import as_bag, changes, data_columns, from_weights, net_changes, weight
from ..operators.relational import semi_null_safe
from ..session import cut_lineage

HISTORY = """name string, version long, state string, state_message string, refresh_action string,
    refresh_trigger string, refresh_start_time timestamp_ntz, refresh_end_time timestamp_ntz,
    changed_rows long, row_count long, schema string, input_versions map<string,long>, floor_version long, has_changes boolean"""

Frames = Mapping[str, DataFrame]


class RetentionError(RuntimeError):
    """The change history a refresh needs has been given up."""


@dataclass(frozen=True)
class Maintained:
    """A table definition.

    ``compute`` builds the result from the input tables.  ``apply`` (optional)
    builds the new result from the old one, the change sets of the inputs and
    the new input tables.  ``gate`` may hold a refresh back by the number of
    changed input rows.  The result of a ``stateful`` table depends on what was
    stored before (enrichment as of then, a board that forgets, a frozen
    region): it is never rebuilt because much has changed, and after a change of
    layout only by ``rebuild``.

    ``touched`` (for tables in parts) gives the keys of the result that the
    change sets of the inputs may concern.  ``apply`` then gets those rows of
    the old result that share a bucket with such a key, and has to return what
    becomes of them: rows of other keys unchanged.
    """

    name: str
    inputs: Sequence[str]
    compute: Callable[[Frames], DataFrame]
    apply: Callable[[DataFrame, Frames, Frames], DataFrame] | None = None
    mode: str = "AUTO"
    gate: Callable[[int], bool] | None = None
    stateful: bool = False
    touched: Callable[[Frames], DataFrame] | None = None


@dataclass
class MaintainedTables:
    """A set of base tables and maintained tables below one folder."""

    spark: SparkSession
    root: str
    max_delta_ratio: float = 0.05
    keys: dict[str, Sequence[str] | None] = field(default_factory=dict)
    definitions: dict[str, Maintained] = field(default_factory=dict)
    parts: dict[str, int] = field(default_factory=dict)
    _summary: dict | None = field(default=None, repr=False)
    _checked: dict = field(default_factory=dict, repr=False)

    # --- definitions and data ---------------------------------------------

    def add_base(self, name: str, keys: Sequence[str] | None = None) -> None:
        self.keys[name] = keys

    def add(self, definition: Maintained, keys: Sequence[str] | None = None, parts: int | None = None) -> None:
        """Declares a table; with ``parts`` it is kept in so many buckets of its keys."""
        unknown = [i for i in definition.inputs if i not in self.keys]
        if unknown:
            raise ValueError(f"{definition.name} reads unknown tables {unknown}")
        if parts and not keys:
            raise ValueError(f"{definition.name} needs keys to be kept in parts")
        self.definitions[definition.name] = definition
        self.keys[definition.name] = keys
        if parts:
            self.parts[definition.name] = parts

    def publish(self, name: str, df: DataFrame, change_set: DataFrame | None = None) -> int:
        """Store the next version of a base table.

        A producer that knows what it changed hands over the change set too;
        refreshes then read that instead of comparing two whole versions.
        """
        if change_set is not None:
            change_set.write.mode("overwrite").parquet(self._delta_path(name, self.version(name) + 1))
        return self._store(name, df, "PUBLISH", "MANUAL", {}, None, _now(), change_set is not None)

    def seed(self, name: str, df: DataFrame, input_versions: Mapping[str, int]) -> int:
        """Start a maintained table from existing contents, and go on from the
        given input versions at the next refresh."""
        return self._store(name, df, "BACKFILL", "CREATION", dict(input_versions), None, _now())

    def expire(self, name: str, floor: int) -> None:
        """Give up the versions below ``floor``."""
        self._record(name, self.version(name), "SUCCEEDED", "EXPIRE", "MANUAL", _now(), floor=floor)

    def read(self, name: str, version: int | None = None) -> DataFrame:
        version = self.version(name) if version is None else version
        if version < self._floor(name):
            raise RetentionError(f"version {version} of {name} is no longer kept")
        if name in self.parts:
            return self._read_buckets(name, version)
        return self.spark.read.parquet(self._path(name, version))

    # --- versions as lists of buckets ------------------------------------------

    def manifest(self, name: str, version: int | None = None) -> dict[int, int]:
        """Bucket -> version whose folder holds it; buckets without rows are not listed."""
        version = self.version(name) if version is None else version
        rows = self.spark.read.schema("bucket int, version long, layout string").parquet(self._manifest_path(name, version))
        return {r["bucket"]: r["version"] for r in rows.where("bucket IS NOT NULL").collect()}  # at most one row per bucket

    def vacuum(self, name: str) -> list[str]:
        """Deletes the bucket folders and change sets that only versions below the floor use, and names them."""
        floor, newest = max(1, self._floor(name)), self.version(name)
        kept = {(b, v) for version in range(floor, newest + 1) for b, v in self.manifest(name, version).items()}
        gone = []
        for version in range(1, floor):
            if self._exists(self._manifest_path(name, version)):
                gone += [self._bucket_path(name, v, b) for b, v in self.manifest(name, version).items() if (b, v) not in kept]
                gone += [self._manifest_path(name, version), self._delta_path(name, version)]
        gone = [path for path in dict.fromkeys(gone) if self._exists(path)]
        for path in gone:
            where = self._hadoop(path)
            self._files(where).delete(where, True)
        return gone

    def _hadoop(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def _files(self, path):
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _exists(self, path: str) -> bool:
        where = self._hadoop(path)
        return self._files(where).exists(where)

    def _manifest_path(self, name: str, version: int) -> str:
        return f"{self.root}/{name}/manifest{version:08d}"

    def _bucket_path(self, name: str, version: int, bucket: int) -> str:
        return f"{self._path(name, version)}/_bucket={bucket}"

    def _bucket(self, name: str) -> Column:
        return F.pmod(F.xxhash64(*self.keys[name]), F.lit(self.parts[name])).cast("int")

    def _read_buckets(self, name: str, version: int, only: Sequence[int] | None = None) -> DataFrame:
        listed = self.manifest(name, version)
        paths = [self._bucket_path(name, v, b) for b, v in sorted(listed.items()) if only is None or b in set(only)]
        layout = self.spark.read.parquet(self._manifest_path(name, version)).first()["layout"]
        # the folders are named one by one, so what other versions left beside them is never listed
        return self.spark.read.schema(layout).parquet(*paths) if paths else self.spark.createDataFrame([], layout)

    def _write_buckets(self, name: str, version: int, df: DataFrame) -> list[int]:
        """Writes the rows of ``df`` into bucket folders of ``version``; the buckets that have rows."""
        path = self._path(name, version)
        dealt = df.withColumn("_bucket", self._bucket(name))
        # some tasks per bucket, so that few large buckets still spread
        spread = dealt.repartition("_bucket", F.pmod(F.xxhash64(*df.columns), F.lit(4)))
        spread.write.mode("overwrite").partitionBy("_bucket").parquet(path)
        where = self._hadoop(path)
        names = [f.getPath().getName() for f in self._files(where).listStatus(where)]
        return sorted(int(n.split("=")[1]) for n in names if n.startswith("_bucket="))

    def _list(self, name: str, version: int, listed: Mapping[int, int], layout: str) -> None:
        rows = [(b, v, layout) for b, v in sorted(listed.items())] or [(None, None, layout)]
        self.spark.createDataFrame(rows, "bucket int, version long, layout string").coalesce(1).write.mode("overwrite").parquet(
            self._manifest_path(name, version))

    def _refresh_parts(self, table: Maintained, deltas: Frames, current: Frames, now: Mapping[str, int], changed: int,
                       trigger: str, start: dt.datetime) -> None:
        """Writes the buckets of the touched keys anew and stores what changed in them."""
        name, keys = table.name, list(self.keys[table.name])
        last, version = self._last(name), self.version(name) + 1
        touched = cut_lineage(table.touched(deltas).select(*keys).distinct())
        buckets = [r[0] for r in touched.select(self._bucket(name).alias("b")).distinct().collect()]  # at most all of them
        old = self._read_buckets(name, version - 1, buckets)
        wrote = self._write_buckets(name, version, table.apply(old, deltas, current).select(*old.columns))
        if not set(wrote) <= set(buckets):
            raise ValueError(f"the refresh of {name} has changed rows of keys that it does not name as touched")
        layout = _ddl(old)
        paths = [self._bucket_path(name, version, b) for b in wrote]
        new = self.spark.read.schema(layout).parquet(*paths) if paths else old.limit(0)
        log = changes(semi_null_safe(old, touched, keys), semi_null_safe(new, touched, keys), keys)
        log.write.mode("overwrite").parquet(self._delta_path(name, version))
        moved = self.spark.read.parquet(self._delta_path(name, version)).agg(F.coalesce(F.sum(weight()), F.lit(0))).first()[0]
        listed = {b: v for b, v in self.manifest(name, version - 1).items() if b not in set(buckets)} | {b: version for b in wrote}
        self._list(name, version, listed, layout)
        self._record(name, version, "SUCCEEDED", "INCREMENTAL", trigger, start, changed=changed, rows=last["row_count"] + moved,
                     schema=last["schema"], inputs=now, has_changes=True)

    # --- history -------------------------------------------------------------

    def history(self) -> DataFrame:
        try:
            return self.spark.read.schema(HISTORY).parquet(f"{self.root}/_history")
        except AnalysisException:
            return self.spark.createDataFrame([], HISTORY)

    def _known(self) -> dict:
        """Newest version, floor and last successful row of every table.

        One row per table, read once: a folder has one writer, and that writer
        keeps the summary current as it adds rows.
        """
        if self._summary is None:
            done = F.col("state") == "SUCCEEDED"
            built = F.when(done & (F.col("refresh_action") != "EXPIRE"), F.struct("*"))
            rows = self.history().groupBy("name").agg(
                F.max(F.when(done, F.col("version"))).alias("version"), F.max("floor_version").alias("floor"),
                F.max_by(built, F.when(built.isNotNull(), F.col("refresh_end_time"))).alias("last"))
            self._summary = {r["name"]: r.asDict(recursive=True) for r in rows.collect()}
        return self._summary

    def version(self, name: str) -> int:
        """Newest complete version, 0 when there is none."""
        return self._known().get(name, {}).get("version") or 0

    def _last(self, name: str) -> dict | None:
        return self._known().get(name, {}).get("last")

    def _floor(self, name: str) -> int:
        return self._known().get(name, {}).get("floor") or 0

    def _path(self, name: str, version: int) -> str:
        return f"{self.root}/{name}/v{version:08d}"

    def _delta_path(self, name: str, version: int) -> str:
        return f"{self.root}/{name}/changes{version:08d}"

    def _record(self, name, version, state, action, trigger, start, message=None, changed=None, rows=None,
                schema=None, inputs=None, floor=None, has_changes=False) -> None:
        row = (name, version, state, message, action, trigger, start, _now(), changed, rows, schema, inputs or {},
               floor, has_changes)
        known = self._known()
        self.spark.createDataFrame([row], HISTORY).coalesce(1).write.mode("append").parquet(f"{self.root}/_history")
        entry = known.setdefault(name, {"version": None, "floor": None, "last": None})
        entry["floor"] = max(entry["floor"] or 0, floor or 0)
        if state == "SUCCEEDED":
            entry["version"] = version
            if action != "EXPIRE":
                entry["last"] = {"version": version, "row_count": rows, "schema": schema, "input_versions": inputs or {}}

    def _store(self, name, df, action, trigger, inputs, changed, start, has_changes=False) -> int:
        version = self.version(name) + 1
        path = self._path(name, version)
        if name in self.parts:
            wrote = self._write_buckets(name, version, df)
            self._list(name, version, {b: version for b in wrote}, _ddl(df))
            rows = self._read_buckets(name, version).count()
        else:
            df.write.mode("overwrite").parquet(path)
            rows = self.spark.read.parquet(path).count()
        self._record(name, version, "SUCCEEDED", action, trigger, start, changed=changed, rows=rows,
                     schema=_layout(df), inputs=inputs, has_changes=has_changes)
        return version

    def changes_between(self, name: str, old: int, new: int) -> DataFrame:
        """The change set from one version to another: the stored change sets
        where every step has one, else a comparison of the two versions."""
        if old < self._floor(name):
            raise RetentionError(f"changes of {name} since version {old} are no longer kept")
        done = (F.col("name") == name) & F.col("has_changes") & F.col("version").between(old + 1, new)
        steps = sorted(r["version"] for r in self.history().where(done).select("version").distinct().collect())
        if steps != list(range(old + 1, new + 1)):
            return changes(self.read(name, old), self.read(name, new), self.keys[name])
        log = self.spark.read.parquet(*[self._delta_path(name, v) for v in steps])
        if len(steps) == 1:
            return log
        if self.keys[name]:
            return net_changes(log, self.keys[name])
        return from_weights(log.select(*data_columns(log), weight().alias("_w")))

    def changes_since(self, name: str, old: int, new: int) -> DataFrame:
        """``changes_between``, where version 0 is the empty table."""
        if old:
            return self.changes_between(name, old, new)
        rows = self.read(name, new)
        counted = rows.withColumn("_w", F.lit(1)) if self.keys[name] else as_bag(rows, "_w")
        return counted.select(*rows.columns, F.lit("INSERT").alias("_action"), F.lit(False).alias("_is_update"),
                              F.col("_w").cast("bigint").alias("_copies"))

    def reload(self) -> None:
        """Forget what is known of the history; another process may have added to it."""
        self._summary = None

    # --- refresh ---------------------------------------------------------------

    def order(self, target: str) -> list[str]:
        """The maintained tables ``target`` rests on, inputs before readers."""
        wanted, open_names = {}, [target]
        while open_names:
            name = open_names.pop()
            if name in self.definitions and name not in wanted:
                wanted[name] = [i for i in self.definitions[name].inputs if i in self.definitions]
                open_names += wanted[name]
        return list(TopologicalSorter(wanted).static_order())

    def refresh(self, target: str, trigger: str = "MANUAL") -> DataFrame:
        """Bring ``target`` and everything below it up to date.

        A failure leaves the old version in place and marks the tables that
        read it as UPSTREAM_FAILED.  Returns the history.
        """
        broken: set[str] = set()
        for name in self.order(target):
            start = _now()
            if broken & set(self.definitions[name].inputs):
                broken.add(name)
                self._record(name, self.version(name), "UPSTREAM_FAILED", None, trigger, start)
                continue
            try:
                self._refresh_one(self.definitions[name], trigger, start)
            except Exception as error:  # noqa: BLE001 - becomes a history row
                broken.add(name)
                self._record(name, self.version(name), "FAILED", None, trigger, start, message=str(error))
        return self.history()

    def _refresh_one(self, table: Maintained, trigger: str, start: dt.datetime) -> None:
        now = {name: self.version(name) for name in table.inputs}
        last = self._last(table.name)
        current = {name: self.read(name) for name in table.inputs}
        if last is None:
            self._store(table.name, table.compute(current), "FULL", "CREATION", now, None, start)
            return
        seen = dict(last["input_versions"])
        if seen == now:
            self._record(table.name, last["version"], "SUCCEEDED", "NO_DATA", trigger, start, changed=0,
                         rows=last["row_count"], schema=last["schema"], inputs=now)
            return
        if self._other_layout(table, current, seen, last["schema"]):
            if table.stateful:
                raise ValueError(f"{table.name} depends on its history and its layout has changed; rebuild it explicitly")
            self._store(table.name, table.compute(current), "REINITIALIZE", trigger, now, None, start)
            return
        if table.apply is None or table.mode == "FULL":
            self._store(table.name, table.compute(current), "FULL", trigger, now, None, start)
            return
        deltas = {name: self.changes_between(name, seen[name], now[name]) for name in table.inputs}
        path = f"{self.root}/{table.name}/input_changes{last['version'] + 1:08d}"
        kept, changed, total = {}, 0, 0
        for name, delta in deltas.items():
            # written once: counted here and read again by the refresh itself
            delta.write.mode("overwrite").parquet(f"{path}/{name}")
            kept[name] = self.spark.read.parquet(f"{path}/{name}")
            changed += kept[name].agg(F.coalesce(F.sum("_copies"), F.lit(0))).first()[0]
            total += self._last(name)["row_count"]  # as it was stored; the input itself is not read for that
        if table.gate is not None and not table.gate(changed):
            self._record(table.name, last["version"], "SKIPPED", None, trigger, start, changed=changed,
                         message="held back by the gate", inputs=seen)
            return
        if table.mode == "AUTO" and not table.stateful and changed > self.max_delta_ratio * max(total, 1):
            self._store(table.name, table.compute(current), "FULL", trigger, now, changed, start)
            return
        if table.touched is not None and table.name in self.parts:
            self._refresh_parts(table, kept, current, now, changed, trigger, start)
            return
        result = table.apply(self.read(table.name), kept, current)
        self._store(table.name, result, "INCREMENTAL", trigger, now, changed, start)


    def _other_layout(self, table: Maintained, current: Frames, seen: Mapping[str, int], stored: str) -> bool:
        """Whether the result would have other columns than the stored one.
        ``compute`` may run jobs while it is planned, so it is only built where
        the definition or the layout of an input is new."""
        known = self._checked.get(table.name) is table
        if known and all(_layout(current[n]) == _layout(self.read(n, max(seen[n], self._floor(n)))) for n in table.inputs):
            return False
        self._checked[table.name] = table
        return _layout(table.compute(current)) != stored

    def rebuild(self, name: str, trigger: str = "MANUAL") -> int:
        """Compute a table anew from its inputs, whatever it held."""
        table = self.definitions[name]
        now = {n: self.version(n) for n in table.inputs}
        return self._store(name, table.compute({n: self.read(n) for n in table.inputs}), "REINITIALIZE", trigger, now, None, _now())


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def _layout(df: DataFrame) -> str:
    """Column names and types, without nullability, which files do not keep."""
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
