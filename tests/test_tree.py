import random

import pytest
from pyspark.sql import functions as F

from freshet.operators import graph as g
from freshet.operators import tree as tr
from freshet.plans import lineage as li


def frame(spark, pairs):
    return spark.createDataFrame(pairs, "child string, parent string")


def pairs_of(df, *columns):
    return {tuple(r) for r in df.select(*columns).collect()}


def test_intervals_equal_closure(spark):
    rng = random.Random(5)
    # a parent with a third of all children, a chain of 30, a random rest, a second root and a node without edges
    pairs = [(f"h{i:02}", "root") for i in range(25)] + [("c00", "root")] + [(f"c{i + 1:02}", f"c{i:02}") for i in range(30)]
    names = [n for n, _ in pairs] + ["other"]
    for i in range(25):
        pairs.append((f"r{i:02}", rng.choice(names)))
        names.append(f"r{i:02}")
    edges = frame(spark, pairs + pairs[:3] + [(None, "root"), ("x", None)])
    alone = spark.createDataFrame([("alone",)], "node string")
    numbered = tr.intervals(edges, alone)
    rows = {r.node: (r.low, r.high) for r in numbered.collect()}
    assert sorted(low for low, _ in rows.values()) == list(range(len(rows))) and rows["alone"][0] == rows["alone"][1]
    nodes = numbered.select("node")
    walked = g.closure(frame(spark, pairs), nodes.select(F.col("node").alias("start"), "node"))
    assert pairs_of(tr.ancestors(numbered, nodes), "node", "above") == pairs_of(walked, "start", "node")
    among = spark.createDataFrame([("c05",), ("c05",), ("nobody",)], "above string")
    assert pairs_of(tr.ancestors(numbered, nodes, among), "node", "above") == {
        p for p in pairs_of(walked, "start", "node") if p[1] == "c05"}


def test_what_is_no_forest(spark):
    with pytest.raises(tr.ManyParentsError):
        tr.intervals(frame(spark, [("a", "b"), ("a", "c")]))
    with pytest.raises(g.CycleError):
        tr.intervals(frame(spark, [("a", "b"), ("b", "c"), ("c", "a"), ("d", "c")]))
    none = tr.intervals(frame(spark, []))
    assert none.isEmpty() and tr.ancestors(none, none.select("node")).isEmpty()


def test_deep_grants_equal_flat_ones(spark):
    hierarchy = frame(spark, [("d", "c"), ("c", "b"), ("b", "a"), ("e", "b")])
    members = spark.createDataFrame([("ann", "d"), ("bob", "e"), ("cy", "a"), ("dee", "free"), ("ann", "e")], "user string, role string")
    grants = spark.createDataFrame(
        [("a", "t1", "SELECT", None), ("b", "t2", "SELECT", None), ("c", "t3", "SELECT", None), ("d", "t4", "SELECT", "2025-01-01"), ("free", "t5", "USAGE", None)],
        "role string, object string, privilege string, deleted_on string")
    deep = li.effective_grants_of_tree(members, hierarchy, grants)
    columns = ("user", "object", "privilege")
    assert pairs_of(deep, *columns) == pairs_of(li.effective_grants(members, hierarchy, grants), *columns)
    assert ("bob", "t3", "SELECT") not in pairs_of(deep, *columns) and ("dee", "t5", "USAGE") in pairs_of(deep, *columns)


# --- columns -------------------------------------------------------------------------

def test_columns_behind_columns(spark):
    rows = [("v", "x", "t", "a", "OUTPUT"), ("v", "y", "t", "b", "OUTPUT"), ("w", "z", "v", "x", "OUTPUT"), ("w", "k", "v", "y", "OUTPUT"),
            ("w", None, "v", "y", "FILTER"), ("u", "m", "w", "k", "OUTPUT"), ("u", "m", "w", "z", "OUTPUT"), ("only", None, "t", "a", "JOIN"),
            ("v", "x", "t", "a", "OUTPUT"), (None, "q", "t", "a", "OUTPUT")]
    projections = spark.createDataFrame(rows, "name string, column string, input string, input_column string, role string")
    dropped = spark.createDataFrame([("t", "a"), ("t", "b"), ("t", "unused")], "name string, column string")
    got = pairs_of(li.columns_affected(projections, dropped), "dropped_name", "dropped_column", "name", "column")
    assert got == {("t", "a", "v", "x"), ("t", "a", "w", "z"), ("t", "a", "u", "m"), ("t", "a", "only", None),
                   ("t", "b", "v", "y"), ("t", "b", "w", "k"), ("t", "b", "w", None), ("t", "b", "w", "z"), ("t", "b", "u", "m")}
