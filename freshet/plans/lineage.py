"""Lineage of definitions: types behind views, effective grants, refresh modes
along the model graph, and task graphs turned into table graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import graph as g
from ..operators import tree
from ..operators.windows import ordered_windows
from ..session import cut_lineage

# Kinds a maintained table cannot read, directly or through views.
UNSUPPORTED_KINDS = ["MAINTAINED", "EXTERNAL TABLE", "MATERIALIZED VIEW", "DIRECTORY TABLE"]

# What a construct does to a model's refresh mode.
CONSTRUCTS = {
    "INNER JOIN": "INCREMENTAL",
    "LEFT OUTER JOIN": "INCREMENTAL",
    "RIGHT OUTER JOIN": "INCREMENTAL",
    "FULL OUTER JOIN": "INCREMENTAL",
    "CROSS JOIN": "INCREMENTAL",
    "NATURAL JOIN": "INCREMENTAL",
    "UNION ALL": "INCREMENTAL",
    "SUM": "INCREMENTAL",
    "COUNT": "INCREMENTAL",
    "AVG": "INCREMENTAL",
    "MIN": "INCREMENTAL",
    "MAX": "INCREMENTAL",
    "GROUP BY": "INCREMENTAL",
    "WHERE": "INCREMENTAL",
    "HAVING": "INCREMENTAL",
    "CASE WHEN": "INCREMENTAL",
    "COALESCE": "INCREMENTAL",
    "SCALAR SUBQUERY": "INCREMENTAL",
    "LATERAL FLATTEN": "INCREMENTAL",
    "CURRENT TIME IN FILTER": "INCREMENTAL",
    "UNION": "FULL",
    "DISTINCT": "FULL",
    "ROW_NUMBER": "FULL",
    "RANK": "FULL",
    "LEAD": "FULL",
    "LAG": "FULL",
    "EXCEPT": "FULL",
    "INTERSECT": "FULL",
    "MINUS": "FULL",
    "OUTER JOIN WITH INEQUALITY": "FULL",
    "LATERAL": "FULL",
    "TABLE FUNCTION": "FULL",
    "CURRENT TIME IN PROJECTION": "FULL",
    "VOLATILE FUNCTION": "FULL",
    "RANDOM": "SKIP",
    "UUID_STRING": "SKIP",
    "SEQUENCE": "SKIP",
    "RECURSIVE CTE": "SKIP",
    "PIVOT": "SKIP",
    "UNPIVOT": "SKIP",
    "SAMPLE": "SKIP",
}
MODE_RANK = {"INCREMENTAL": 1, "FULL": 2, "SKIP": 3}


def trace_types(objects: DataFrame, reads: DataFrame) -> DataFrame:
    """What every view finally reads, and whether that blocks a maintained
    table: BLOCKER, UNKNOWN (an object nobody can see) or OK.

    ``objects``: (name, kind); ``reads``: (child, parent).  The walk goes on
    through views only.  It starts at the blocking and at the unseen objects
    and marks the views above them, so it keeps one mark per view however many
    objects a view rests on.  ``levels`` is the longest chain below the view.
    """
    views = objects.where("kind = 'VIEW'").select("name")
    through = cut_lineage(reads.join(views.withColumnRenamed("name", "child"), "child", "left_semi"))

    def above(start: DataFrame, mark: str) -> DataFrame:
        reached = g.closure(through, start.select(F.col("name").alias("node")), "downstream")
        return reached.where("depth > 0").select(F.col("node").alias("name"), F.lit(True).alias(mark))

    blocking = objects.where(F.col("kind").isin(UNSUPPORTED_KINDS))
    unseen = through.select(F.col("parent").alias("name")).distinct().join(objects, "name", "left_anti")
    nodes = through.select(F.col("child").alias("node")).unionByName(through.select(F.col("parent").alias("node"))).distinct()
    levels = g.depths(through, nodes).select(F.col("node").alias("name"), F.col("depth").alias("levels"))
    marked = (
        views.join(through.select(F.col("child").alias("name")).distinct(), "name", "left_semi")
        .join(above(blocking, "_blocked"), "name", "left").join(above(unseen, "_unseen"), "name", "left").join(levels, "name")
    )
    verdict = F.when(F.col("_blocked"), "BLOCKER").when(F.col("_unseen"), "UNKNOWN").otherwise("OK")
    return marked.select(F.col("name").alias("view"), "levels", verdict.alias("verdict"))


def effective_roles(members: DataFrame, hierarchy: DataFrame) -> DataFrame:
    """(user, role): the roles given to a user and all roles those inherit.

    ``members``: (user, role); ``hierarchy``: (child, parent) between roles.
    The hierarchy is closed once over the roles, not once per user.
    """
    roles = members.select("role").distinct()
    start = roles.select(F.col("role").alias("direct"), F.col("role").alias("node"))
    inherited = g.closure(hierarchy, start).select(F.col("direct").alias("role"), F.col("node").alias("effective"))
    return members.join(inherited, "role").select("user", F.col("effective").alias("role")).distinct()


def effective_grants(members: DataFrame, hierarchy: DataFrame, grants: DataFrame) -> DataFrame:
    """(user, object, privilege) over all effective roles; withdrawn grants
    (``deleted_on`` set) do not count."""
    valid = grants.where(F.col("deleted_on").isNull()).select("role", "object", "privilege").distinct()
    return effective_roles(members, hierarchy).join(valid, "role").select("user", "object", "privilege").distinct()


def effective_grants_of_tree(members: DataFrame, hierarchy: DataFrame, grants: DataFrame) -> DataFrame:
    """``effective_grants`` for a deep hierarchy in which a role inherits from
    one role at most: the roles above a user's role are those whose interval
    holds its number, and only roles that were granted something are looked at.
    """
    valid = grants.where(F.col("deleted_on").isNull()).select("role", "object", "privilege").distinct()
    numbered = tree.intervals(hierarchy, members.select(F.col("role").alias("node")))
    inherited = tree.ancestors(
        numbered, members.select(F.col("role").alias("node")), valid.select(F.col("role").alias("above")))
    given = inherited.join(valid.withColumnRenamed("role", "above"), "above").select(F.col("node").alias("role"), "object", "privilege").distinct()
    return members.join(given, "role").select("user", "object", "privilege").distinct()


def missing_grants(required: DataFrame, effective: DataFrame) -> DataFrame:
    """Privileges a user needs and does not have."""
    return required.select("user", "object", "privilege").distinct().join(
        effective, ["user", "object", "privilege"], "left_anti")


def classify_models(constructs: DataFrame) -> DataFrame:
    """Mode per model from the constructs it uses: the worst one decides, and
    the reason names it.  A construct without a rule means FULL."""
    mapping = F.create_map(*[F.lit(x) for pair in CONSTRUCTS.items() for x in pair])
    ranks = F.create_map(*[F.lit(x) for pair in MODE_RANK.items() for x in pair])
    known = F.try_element_at(mapping, F.col("construct"))
    rows = constructs.select("name", "construct", F.coalesce(known, F.lit("FULL")).alias("mode"))
    rows = rows.withColumn("_rank", F.element_at(ranks, F.col("mode")))
    worst = F.max(F.struct("_rank", "mode", "construct")).alias("w")
    return rows.groupBy("name").agg(worst).select(
        "name", F.col("w.mode").alias("mode"),
        F.when(F.col("w.mode") != "INCREMENTAL", F.col("w.construct")).alias("reason"))


def derived_keys(constructs: DataFrame) -> DataFrame:
    """Key a model's shape guarantees: its GROUP BY columns, or the partition
    columns of a keep-one-row window.  Grouping sets add subtotal rows and
    guarantee none.  ``constructs`` also has ``key_columns`` (array)."""
    usable = constructs.where(F.col("construct").isin("GROUP BY", "ROW_NUMBER"))
    spoiled = constructs.where(F.col("construct").isin("ROLLUP", "CUBE", "GROUPING SETS")).select("name").distinct()
    # ROW_NUMBER sorts last: it is applied on top of the grouping
    last = F.max_by("key_columns", F.struct("construct", "key_columns"))
    return usable.join(spoiled, "name", "left_anti").groupBy("name").agg(last.alias("key_columns"))


def propagate_mode(models: DataFrame, edges: DataFrame) -> DataFrame:
    """Final refresh mode per model.

    ``models``: (name, mode, has_key, tracked).  A FULL model without a key
    makes everything that reads it FULL, and so on downstream; a key, or a
    plain table with change tracking, stops that.
    """
    open_models = models.where(~F.col("has_key") & ~F.col("tracked"))
    passing = edges.join(open_models.select(F.col("name").alias("parent")), "parent", "left_semi")
    start = open_models.where("mode = 'FULL'").select(F.col("name").alias("node"))
    hit = g.closure(passing, start, "downstream").where("depth > 0").select(F.col("node").alias("name"), F.lit(True).alias("_hit"))
    final = F.when((F.col("mode") == "INCREMENTAL") & F.col("_hit"), "FULL").otherwise(F.col("mode"))
    reason = F.when((F.col("mode") == "INCREMENTAL") & F.col("_hit"), "UPSTREAM_USES_FULL_REFRESH")
    return models.join(hit, "name", "left").select("name", "mode", final.alias("final_mode"), reason.alias("reason"))


def definition_changes(versions: DataFrame) -> DataFrame:
    """Versions whose inputs or query differ from the version before; refreshes
    on the two sides are not comparable.  ``versions``: (name, valid_from,
    inputs_text, query_text)."""
    rows = ordered_windows(
        versions, ["name"], ["valid_from"],
        previous={"_inputs": "inputs_text", "_query": "query_text", "_from": "valid_from"})
    changed_inputs = ~F.col("_inputs").eqNullSafe(F.col("inputs_text"))
    changed_query = ~F.col("_query").eqNullSafe(F.col("query_text"))
    return rows.where(F.col("_from").isNotNull() & (changed_inputs | changed_query)).select(
        "name", "valid_from", changed_inputs.alias("inputs_changed"), changed_query.alias("query_changed"))


#: Stands for the definition of an object among its columns.
WHOLE = "*"


def column_edges(projections: DataFrame) -> DataFrame:
    """Edges (child, parent) between {name, column} from the columns that
    definitions read.

    ``projections``: (name, column, input, input_column, role).  Rows of role
    OUTPUT feed one column.  All other roles (FILTER, JOIN, ...) feed the
    definition as a whole, which stands between them and all its columns, so
    there is one edge per row and one per column, not their product.  Rows
    without one of their names are left out.
    """
    rows = projections.where("name IS NOT NULL AND input IS NOT NULL AND input_column IS NOT NULL")
    output = F.col("role") == "OUTPUT"
    rows = rows.where(F.coalesce(~output, F.lit(True)) | F.col("column").isNotNull())
    name = F.col("name")
    target = F.when(output, F.col("column")).otherwise(WHOLE)
    read = rows.select(
        F.struct(name, target.alias("column")).alias("child"),
        F.struct(F.col("input").alias("name"), F.col("input_column").alias("column")).alias("parent"))
    filtered = rows.where(F.coalesce(~output, F.lit(True))).select("name").distinct()
    columns = rows.where(output).select("name", "column").distinct().join(filtered, "name", "left_semi")
    inside = columns.select(
        F.struct(name, F.col("column")).alias("child"), F.struct(name, F.lit(WHOLE).alias("column")).alias("parent"))
    return read.unionByName(inside).distinct()


def columns_affected(projections: DataFrame, dropped: DataFrame) -> DataFrame:
    """What breaks when a column goes: (dropped_name, dropped_column, name,
    column) over any number of definitions in between.

    ``dropped``: (name, column).  A row without ``column`` means that the
    definition itself, by a filter or join, rests on the dropped column; then
    all its columns are listed too.
    """
    gone = F.struct("name", "column")
    start = dropped.select(gone.alias("gone"), gone.alias("node"))
    reached = g.closure(column_edges(projections), start, "downstream").where("depth > 0")
    return reached.select(
        F.col("gone.name").alias("dropped_name"), F.col("gone.column").alias("dropped_column"), F.col("node.name").alias("name"),
        F.nullif(F.col("node.column"), F.lit(WHOLE)).alias("column"))


def tasks_to_tables(tasks: DataFrame) -> DataFrame:
    """One maintained table per task: inner ones follow their consumer, leaves
    keep the task's schedule, roots read the base tables.  ``tasks``: (name,
    predecessors array, schedule)."""
    used = tasks.select(F.explode("predecessors").alias("name")).distinct().withColumn("_used", F.lit(True))
    rows = tasks.join(used, "name", "left")
    inner = F.coalesce("_used", F.lit(False))
    return rows.select(
        "name", (F.size("predecessors") == 0).alias("is_root"),
        F.when(inner, "DOWNSTREAM").otherwise(F.col("schedule")).alias("target_lag"))


def connected_to(edges: DataFrame, nodes: DataFrame, name: str) -> DataFrame:
    """All tables in the same connected group as ``name``."""
    members = g.components(edges, nodes)
    mine = members.where(F.col("node") == name).select("component")
    return members.join(mine, "component", "left_semi").select("node")
