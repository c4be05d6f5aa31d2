import random

import pytest
from pyspark.sql import functions as F

from freshet.operators import graph as g
from freshet.plans import lineage as li
from freshet.plans import traces as t
from freshet.sources import schemas


def edge_frame(spark, pairs):
    return spark.createDataFrame(pairs, "child string, parent string")


def node_frame(spark, names):
    return spark.createDataFrame([(n,) for n in names], "node string")


def test_components_match_union_find(spark):
    rng = random.Random(7)
    names = [f"n{i:02d}" for i in range(40)]
    # a hub with a third of all edges, chains, and nodes without edges
    pairs = [(n, "n00") for n in names[1:14]] + [(names[i], names[i + 1]) for i in range(15, 28)] + [
        (rng.choice(names[30:36]), rng.choice(names[30:36])) for _ in range(6)]
    label = {n: n for n in names}
    changed = True
    while changed:
        changed = False
        for a, z in pairs:
            low = min(label[a], label[z])
            for n in (a, z):
                if label[n] != low:
                    label[n], changed = low, True
    got = {r.node: r.component for r in g.components(edge_frame(spark, pairs), node_frame(spark, names)).collect()}
    assert got == label


def test_closure_ends_on_a_cycle(spark, rows):
    edges = edge_frame(spark, [("b", "a"), ("c", "b"), ("a", "c"), ("d", "c")])
    assert rows(g.closure(edges, node_frame(spark, ["d"]))) == [("a", 3), ("b", 2), ("c", 1), ("d", 0)]
    assert rows(g.closure(edges, node_frame(spark, ["d"]), max_depth=1)) == [("c", 1), ("d", 0)]


def test_longest_path_through_diamonds(spark):
    edges = edge_frame(spark, [("b", "a"), ("c", "a"), ("d", "b"), ("d", "c"), ("e", "d"), ("e", "a")])
    weights = spark.createDataFrame([("a", 1), ("b", 5), ("c", 2), ("d", 1), ("e", 1), ("x", 9)], "node string, weight long")
    best = g.longest_paths(edges, weights)
    got = {r.node: (r.total, r.via) for r in best.collect()}
    assert got == {"a": (1, None), "b": (6, "a"), "c": (3, "a"), "d": (7, "b"), "e": (8, "d"), "x": (9, None)}
    ends = spark.createDataFrame([("e",), ("x",), ("c",), ("nobody",), ("c",)], "end string")
    paths = sorted((r.end, r.step, r.node, r.total) for r in g.paths_to(best, ends).collect())
    assert paths == [("c", 0, "a", 1), ("c", 1, "c", 3), ("e", 0, "a", 1), ("e", 1, "b", 6), ("e", 2, "d", 7), ("e", 3, "e", 8), ("x", 0, "x", 9)]
    assert {r.node: r.depth for r in g.depths(edges, weights.select("node")).collect()}["e"] == 3


def test_cycles_are_reported(spark):
    edges = edge_frame(spark, [("a", "b"), ("b", "a")])
    weights = spark.createDataFrame([("a", 1), ("b", 1)], "node string, weight long")
    with pytest.raises(g.CycleError):
        g.longest_paths(edges, weights)
    assert not g.has_cycle(edge_frame(spark, [("a", "b"), ("a", "c"), ("b", "c")]))
    assert g.has_cycle(edge_frame(spark, [("a", "b"), ("b", "c"), ("c", "b")]))


def test_deep_chains_are_no_cycles(spark):
    chain = [(f"n{i:02}", f"n{i + 1:02}") for i in range(14)]  # (child, parent)
    nodes = spark.createDataFrame([(n,) for n in sorted({x for e in chain for x in e})], "node string")
    assert {r.node: r.depth for r in g.depths(edge_frame(spark, chain), nodes).collect()}["n00"] == 14


def test_paths_double_on_a_deep_chain(spark, rows):
    # 37 nodes and a hub that many nodes point at
    best = spark.createDataFrame(
        [(f"n{i:02}", i, f"n{i - 1:02}" if i else None) for i in range(37)] + [(f"leaf{i}", 99, "n05") for i in range(20)],
        "node string, total long, via string")
    ends = spark.createDataFrame([("n36",), ("leaf3",)], "end string")
    assert rows(g.paths_to(best, ends), "end", "step", "node", "total") == sorted(
        [("n36", i, f"n{i:02}", i) for i in range(37)] + [("leaf3", i, f"n{i:02}", i) for i in range(6)] + [("leaf3", 6, "leaf3", 99)],
        key=lambda t: tuple((v is None, str(v)) for v in t))
    assert g.paths_to(best, ends.limit(0)).isEmpty() and g.paths_to(best.limit(0), ends).isEmpty()


# --- spans -----------------------------------------------------------------------

@pytest.fixture
def spans(spark):
    import datetime as dt

    now = dt.datetime(2026, 1, 1, 10)

    def span(name, state, reason, seconds, *parents):
        return ("t", name, name.upper(), now, state, reason, now, now + dt.timedelta(seconds=seconds), [(p, "t") for p in parents])

    # r failed, q was skipped for another reason, d has both as inputs
    return spark.createDataFrame([
        span("a", "SUCCEEDED", None, 30), span("r", "FAILED", "QUERY_FAILURE", 20, "a"),
        span("q", "SKIPPED", "UPSTREAM_SKIP", 0, "a"), span("d", "SKIPPED", "UPSTREAM_FAILURE", 0, "r", "q"),
        span("e", "SKIPPED", "UPSTREAM_FAILURE", 0, "d", "gone"), span("s", "SUCCEEDED", None, 5, "a"),
    ], schemas.SPANS)


def test_root_cause_and_impact(spans, rows):
    assert rows(t.root_causes(spans), "span_id", "root_cause") == [("d", "r"), ("e", "r"), ("q", None), ("r", "r")]
    assert rows(t.affected(spans, spans.where("span_id = 'r'")), "span_id", "depth") == [("d", 1), ("e", 2)]


def test_highest_skip_reason_wins(spans, rows):
    assert rows(t.skip_reason(spans)) == [("d", "UPSTREAM_FAILURE"), ("e", "UPSTREAM_FAILURE")]


def test_unresolved_links_and_critical_path(spans, rows):
    assert rows(t.unresolved(spans)) == [("e", "gone")]
    assert rows(t.critical_ends(spans)) == [("t", "d", 50)]
    assert rows(t.critical_paths(spans)) == [("t", 0, "a", 30), ("t", 1, "r", 50), ("t", 2, "d", 50)]


def test_timeline_gives_empty_spans_a_second(spans):
    bars = {r.span_id: r for r in t.timeline(spans).collect()}
    assert (bars["q"].bar_end - bars["q"].bar_start).seconds == 1
    assert bars["q"].label == "Q [SKIPPED — UPSTREAM_SKIP]" and bars["r"].style == "crit" and bars["a"].label == "A [SUCCEEDED]"


# --- lineage --------------------------------------------------------------------------

def test_types_behind_nested_views(spark, rows):
    objects = spark.createDataFrame(
        [("v1", "VIEW"), ("v2", "VIEW"), ("v3", "VIEW"), ("v4", "VIEW"), ("base", "TABLE"), ("m", "MAINTAINED")], "name string, kind string")
    reads = edge_frame(spark, [("v1", "v2"), ("v2", "base"), ("v3", "v4"), ("v4", "m"), ("v4", "base"), ("m", "base"), ("v2", "base")])
    got = {r.view: (r.levels, r.verdict) for r in li.trace_types(objects, reads).collect()}
    # the maintained table ends the walk: what it reads does not count
    assert got == {"v1": (2, "OK"), "v2": (1, "OK"), "v3": (2, "BLOCKER"), "v4": (1, "BLOCKER")}
    hidden = edge_frame(spark, [("v1", "nobody knows")])
    assert li.trace_types(objects, hidden).first().verdict == "UNKNOWN"


def test_grants_over_the_hierarchy(spark, rows):
    members = spark.createDataFrame([("ann", "r1"), ("bob", "r3")], "user string, role string")
    hierarchy = edge_frame(spark, [("r1", "r2"), ("r2", "r3")])
    grants = spark.createDataFrame(
        [("r3", "t", "SELECT", None), ("r2", "w", "USAGE", None), ("r1", "x", "SELECT", "2025-01-01")],
        "role string, object string, privilege string, deleted_on string")
    effective = li.effective_grants(members, hierarchy, grants)
    assert rows(effective) == [("ann", "t", "SELECT"), ("ann", "w", "USAGE"), ("bob", "t", "SELECT")]
    required = spark.createDataFrame([("bob", "w", "USAGE"), ("ann", "x", "SELECT"), ("ann", "t", "SELECT")], "user string, object string, privilege string")
    assert rows(li.missing_grants(required, effective)) == [("ann", "x", "SELECT"), ("bob", "w", "USAGE")]


def test_mode_propagation_stops_at_keys_and_tracked_tables(spark):
    models = spark.createDataFrame([
        ("full", "FULL", False, False), ("keyed", "FULL", True, False), ("table", "FULL", False, True),
        ("a", "INCREMENTAL", False, False), ("b", "INCREMENTAL", False, False), ("c", "INCREMENTAL", False, False), ("d", "INCREMENTAL", False, False)],
        "name string, mode string, has_key boolean, tracked boolean")
    edges = edge_frame(spark, [("a", "full"), ("b", "a"), ("c", "keyed"), ("d", "table")])
    got = {r.name: r.final_mode for r in li.propagate_mode(models, edges).collect()}
    assert {n: got[n] for n in "abcd"} == {"a": "FULL", "b": "FULL", "c": "INCREMENTAL", "d": "INCREMENTAL"}


def test_classification_and_keys(spark, rows):
    rows_in = [("m1", "GROUP BY", ["k"]), ("m1", "SUM", None), ("m2", "EXCEPT", None), ("m3", "SAMPLE", None), ("m3", "EXCEPT", None),
               ("m4", "SOMETHING NEW", None), ("m5", "GROUP BY", ["k"]), ("m5", "ROLLUP", None)]
    df = spark.createDataFrame(rows_in, "name string, construct string, key_columns array<string>")
    got = {r.name: (r.mode, r.reason) for r in li.classify_models(df).collect()}
    assert got == {"m1": ("INCREMENTAL", None), "m2": ("FULL", "EXCEPT"), "m3": ("SKIP", "SAMPLE"),
                   "m4": ("FULL", "SOMETHING NEW"), "m5": ("FULL", "ROLLUP")}
    assert rows(li.derived_keys(df)) == [("m1", ["k"])]


def test_task_graph(spark):
    tasks = spark.createDataFrame([("root", [], "5 MINUTE"), ("mid", ["root"], None), ("leaf", ["mid"], "1 HOUR")],
                                  "name string, predecessors array<string>, schedule string")
    got = {r.name: (r.is_root, r.target_lag) for r in li.tasks_to_tables(tasks).collect()}
    assert got == {"root": (True, "DOWNSTREAM"), "mid": (False, "DOWNSTREAM"), "leaf": (False, "1 HOUR")}
