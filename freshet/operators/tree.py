"""Trees as intervals: who stands above whom, without walking the edges again.

One walk over a forest (edges ``child``, ``parent``) gives every node the
interval of the numbers of its subtree.  A node is above another, or the same,
if its interval holds the other's number, so ancestors are a range join instead
of one join per level, and nothing is stored per pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .graph import CycleError
from .windows import ordered_windows


class ManyParentsError(ValueError):
    """A node has two parents; ``graph.closure`` works for such graphs."""


def intervals(edge_rows: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """(node, low, high) of a forest, numbered from 0 in depth-first order,
    siblings and roots by name.

    ``nodes`` (column ``node``) may add nodes without edges.  Subtree sizes and
    first numbers are summed over jumps of 1, 2, 4, ... parents, so the rounds
    follow the logarithm of the depth; a parent of very many children is summed up
    in the map tasks, and its children are placed by ranges.  Edges without child
    or parent are left out.
    """
    tree = cut_lineage(edge_rows.select("child", "parent").where("child IS NOT NULL AND parent IS NOT NULL").distinct())
    if not tree.groupBy("child").count().where("count > 1").isEmpty():
        raise ManyParentsError("a node has more than one parent")
    named = tree.select(F.col("child").alias("node")).unionByName(tree.select(F.col("parent").alias("node")))
    if nodes is not None:
        named = named.unionByName(nodes.select("node").where("node IS NOT NULL"))
    size = cut_lineage(named.distinct().withColumn("size", F.lit(1).cast("bigint")))
    limit, jumps = size.count(), []
    jump = tree.select(F.col("child").alias("node"), F.col("parent").alias("far"))
    while True:
        jump = cut_lineage(jump)
        if jump.isEmpty():
            break
        if 1 << len(jumps) >= limit:  # a way of more edges than there are nodes
            raise CycleError("the edges form a cycle")
        below = jump.join(size, "node").groupBy(F.col("far").alias("node")).agg(F.sum("size").alias("size"))
        size = cut_lineage(size.unionByName(below).groupBy("node").agg(F.sum("size").alias("size")))
        jumps.append(jump)
        onward = jump.select(F.col("node").alias("far"), F.col("far").alias("_far"))
        jump = jump.join(onward, "far").select("node", F.col("_far").alias("far"))

    beside = size.join(tree.withColumnRenamed("child", "node"), "node", "left")
    placed = ordered_windows(beside, ["parent"], ["node"], totals={"_upto": "size"})
    under = F.when(F.col("parent").isNull(), 0).otherwise(1)
    numbers = cut_lineage(placed.select("node", "size", (F.col("_upto") - F.col("size") + under).alias("low")))
    for jump in jumps:
        above = numbers.select(F.col("node").alias("far"), F.col("low").alias("_above"))
        more = jump.join(above, "far").select("node", "_above")
        numbers = cut_lineage(numbers.join(more, "node", "left").select(
            "node", "size", (F.col("low") + F.coalesce("_above", F.lit(0))).alias("low")))
    return numbers.select("node", "low", (F.col("low") + F.col("size") - 1).alias("high"))


def _cell(number: Column, level: Column) -> Column:
    return F.call_function("shiftright", number, level)


def holding(points: DataFrame, spans: DataFrame) -> DataFrame:
    """Points (columns ``point``, ...) with every row of ``spans`` (``low``,
    ``high``, ...) whose interval holds them.

    An interval lies in cells about as wide as itself, two at most, and a point
    looks into one cell per width, of which there are as many as the widest
    interval has binary digits.  So the range join is an equi-join on (width,
    cell), and both sides grow by small factors only.
    """
    wide = F.length(F.bin(F.col("high") - F.col("low")))
    placed = spans.withColumn("_level", wide).withColumn(
        "_cell", F.explode(F.sequence(_cell(F.col("low"), F.col("_level")), _cell(F.col("high"), F.col("_level")))))
    widest = spans.agg(F.max(wide)).first()[0]
    levels = F.array().cast("array<int>") if widest is None else F.sequence(F.lit(1), F.lit(widest))
    probes = points.withColumn("_level", F.explode(levels)).withColumn("_cell", _cell(F.col("point"), F.col("_level")))
    return probes.join(placed, ["_level", "_cell"]).where("point BETWEEN low AND high").drop("_level", "_cell", "point", "low", "high")


def ancestors(numbered: DataFrame, nodes: DataFrame, among: DataFrame | None = None) -> DataFrame:
    """(node, above): ``nodes`` with all nodes above them and themselves; with
    ``among`` only those of its column ``above``.  ``numbered`` is the result of
    ``intervals``."""
    points = nodes.select("node").distinct().join(numbered.select("node", F.col("low").alias("point")), "node")
    spans = numbered.withColumnRenamed("node", "above")
    if among is not None:
        spans = spans.join(among.select("above").distinct(), "above", "left_semi")
    return holding(points, spans).select("node", "above")
