"""Graph work as joins over edge tables (columns ``child`` and ``parent``).

Every loop writes its state to the shared folder once per round and stops when
nothing changes.  Rounds follow the depth of the graph, or its logarithm for
components; state is one row per node, never a list of paths.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .relational import anti


#: Levels after which a search for longest paths makes sure that it will end.
CYCLE_CHECK_AFTER = 8


class CycleError(ValueError):
    """The edges form a cycle where a tree or DAG is needed."""


def edges(graph: DataFrame, name: str = "name", inputs: str = "inputs", kinds: Sequence[str] | None = None) -> DataFrame:
    """Edge rows from a table with an array of {name, kind} inputs."""
    rows = graph.select(F.col(name).alias("child"), F.explode(inputs).alias("_in"))
    if kinds:
        rows = rows.where(F.col("_in.kind").isin(list(kinds)))
    return rows.select("child", F.col("_in.name").alias("parent"), F.col("_in.kind").alias("kind")).distinct()


def neighbours(edge_rows: DataFrame, node: str, direction: str = "upstream") -> DataFrame:
    """Direct parents or children of one node."""
    here, there = ("child", "parent") if direction == "upstream" else ("parent", "child")
    return edge_rows.where(F.col(here) == node).select(F.col(there).alias("node")).distinct()


def closure(edge_rows: DataFrame, start: DataFrame, direction: str = "upstream", max_depth: int | None = None) -> DataFrame:
    """Everything reachable from the nodes in ``start``, with its distance.

    ``start`` has the column ``node`` and may have further columns; reachability
    is then worked out per combination of them.  A node met before is not
    followed again, so cycles end the search instead of looping.
    """
    here, there = ("child", "parent") if direction == "upstream" else ("parent", "child")
    tags = start.columns
    step = edge_rows.select(F.col(here).alias("node"), F.col(there).alias("_next")).distinct()
    seen = cut_lineage(start.distinct().withColumn("depth", F.lit(0)))
    frontier, depth = seen, 0
    while max_depth is None or depth < max_depth:
        depth += 1
        reached = (
            frontier.join(step, "node")
            .select(*[F.col("_next").alias(c) if c == "node" else F.col(c) for c in tags])
            .distinct()
        )
        fresh = reached.join(seen.select(*tags), tags, "left_anti")
        frontier = cut_lineage(fresh.withColumn("depth", F.lit(depth)))
        if frontier.isEmpty():
            break
        seen = seen.unionByName(frontier)
        if depth % 10 == 0:
            seen = cut_lineage(seen)
    return seen


def components(edge_rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, component): the component is named by its smallest node.

    Alternating large-star and small-star steps (Kiveris et al., 2014): every
    node hands the smallest neighbour it knows to its larger, then its smaller
    neighbours.  Rounds grow with the logarithm of the graph, and a hub only
    ever takes part in a MIN, which is combined in the map tasks.
    """
    links = cut_lineage(
        edge_rows.select(F.greatest("child", "parent").alias("a"), F.least("child", "parent").alias("b"))
        .where(F.col("a") != F.col("b")).distinct()
    )
    before = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = (
            both.where(F.col("b") > F.col("a")).join(lowest, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).where(F.col("a") != F.col("b")).distinct()
        )
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b")))
            .where(F.col("a") != F.col("b")).distinct()
        )
        links = cut_lineage(small)
        after = links.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if after == before:
            break
        before = after
    return (
        nodes.select("node").distinct()
        .join(links.select(F.col("a").alias("node"), F.col("b").alias("component")), "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )


def has_cycle(edge_rows: DataFrame) -> bool:
    """Whether the edges form a cycle: edges out of nodes without parents are
    taken away until none is left, or until a round takes none."""
    left = cut_lineage(edge_rows.select("parent", "child").distinct())
    count = left.count()
    while count:
        left = cut_lineage(left.join(left.select(F.col("child").alias("parent")).distinct(), "parent", "left_semi"))
        before, count = count, left.count()
        if count == before:
            return True
    return False


def longest_paths(edge_rows: DataFrame, weights: DataFrame) -> DataFrame:
    """Per node the heaviest path from a root down to it: (node, total, via).

    ``weights`` has (node, weight), not negative.  Round k holds, per node, the
    heaviest path of exactly k edges ending there, so diamonds do not multiply
    paths and the rounds follow the depth of the graph, however deep it is.
    ``via`` is the parent on the best path; a node whose parents add nothing is a
    root of its own.  Graphs deeper than a few levels are
    looked through for a cycle once, which is reported.
    """
    node_type = dict(edge_rows.dtypes)["parent"]
    step = cut_lineage(
        edge_rows.select("parent", "child").distinct().join(weights.select(F.col("node").alias("child"), "weight"), "child"))
    level = weights.select("node", F.col("weight").alias("total"), F.lit(None).cast(node_type).alias("via"))
    levels, rounds = level, 0
    while True:
        level = cut_lineage(
            level.select(F.col("node").alias("parent"), "total").join(step, "parent")
            .groupBy(F.col("child").alias("node"))
            .agg(F.max(F.col("total") + F.col("weight")).alias("total"),
                 F.min_by("parent", F.struct(-F.col("total"), F.col("parent"))).alias("via")))
        if level.isEmpty():
            # the heaviest wins; among equals the parent that sorts first
            best = F.min_by(F.struct("total", "via"), F.struct(-F.col("total"), F.col("via")))
            return levels.groupBy("node").agg(best.alias("b")).select("node", "b.total", "b.via")
        levels, rounds = levels.unionByName(level), rounds + 1
        if rounds == CYCLE_CHECK_AFTER and has_cycle(step):
            raise CycleError("the edges form a cycle")
        if rounds % 50 == 0:  # the union of many levels is a long plan
            levels = cut_lineage(levels)


def depths(edge_rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges on the longest way from a root to each node."""
    ones = nodes.select("node", F.lit(1).cast("bigint").alias("weight"))
    return longest_paths(edge_rows, ones).select("node", (F.col("total") - 1).alias("depth"))


def paths_to(best: DataFrame, ends: DataFrame) -> DataFrame:
    """The nodes on the heaviest paths to ``ends``: (end, node, total, step),
    step 0 being the root.

    ``best`` is the result of ``longest_paths``, ``ends`` has a column ``end``.
    Jumps of 1, 2, 4, ... pointers are made from jumps half as long, one row per
    node each; then the longest jumps are taken first, and a path doubles in
    every round.  So the rounds follow the logarithm of the depth, all ends share
    them, and a path exists as rows only.  An end that is not in ``best`` has no
    path.
    """
    best = cut_lineage(best.select("node", "total", "via"))
    jumps = []
    far = best.where(F.col("via").isNotNull()).select("node", F.col("via").alias("far"))
    while True:
        far = cut_lineage(far)
        if far.isEmpty():
            break
        jumps.append(far)
        onward = far.select(F.col("node").alias("far"), F.col("far").alias("_far"))
        far = far.join(onward, "far").select("node", F.col("_far").alias("far"))
    found = ends.select("end").distinct().join(best.select(F.col("node").alias("end")), "end", "left_semi")
    found = found.select("end", F.col("end").alias("node"), F.lit(0).cast("bigint").alias("back"))
    for k in reversed(range(len(jumps))):
        found = cut_lineage(found)
        moved = found.join(jumps[k], "node").select("end", F.col("far").alias("node"), (F.col("back") + (1 << k)).alias("back"))
        found = found.unionByName(moved)
    found = cut_lineage(found)
    length = found.groupBy("end").agg(F.max("back").alias("_root"))
    return found.join(length, "end").join(best, "node").select("end", "node", "total", (F.col("_root") - F.col("back")).alias("step"))


def spread_least(edge_rows: DataFrame, labels: DataFrame, open_nodes: DataFrame) -> DataFrame:
    """Hand the smallest label down from parents to children among
    ``open_nodes``: (node, label), for nodes that got one.

    ``labels`` holds the nodes that start with a label.  One label is kept per
    node, so the result does not grow with the number of paths.
    """
    step = cut_lineage(edge_rows.select("parent", "child").distinct().join(
        open_nodes.select(F.col("node").alias("child")), "child", "left_semi"))
    known = cut_lineage(labels.select("node", "label"))
    frontier = known
    while True:
        offered = (
            frontier.join(step, frontier.node == step.parent)
            .groupBy(F.col("child").alias("node")).agg(F.min("label").alias("_l"))
        )
        better = offered.join(known, "node", "left").where(F.col("label").isNull() | (F.col("_l") < F.col("label")))
        frontier = cut_lineage(better.select("node", F.col("_l").alias("label")))
        if frontier.isEmpty():
            return known
        known = cut_lineage(anti(known, frontier, ["node"]).unionByName(frontier))


def spread_flag(edge_rows: DataFrame, start: DataFrame, passes: Column | None = None) -> DataFrame:
    """Nodes reached downstream from ``start``; edges failing ``passes`` (over
    the edge columns) hold the spread up."""
    open_edges = edge_rows if passes is None else edge_rows.where(passes)
    return closure(open_edges, start.select("node"), "downstream")
