import random

import pytest
from pyspark.sql import functions as F

from freshet.operators import changes as ch
from freshet.operators import incremental as inc
from freshet.operators import merge as mg
from freshet.operators.relational import anti, full_outer_as_union, table_diff

SCHEMA = "id int, g string, v int"
OLD = [(1, "a", 10), (2, "a", 20), (3, "b", 30), (4, None, 40), (5, "b", None)]
NEW = [(1, "a", 10), (2, "b", 20), (4, None, 41), (5, "b", None), (6, "c", 60), (7, None, 1)]


@pytest.fixture
def tables(spark):
    return spark.createDataFrame(OLD, SCHEMA), spark.createDataFrame(NEW, SCHEMA)


def test_change_set(tables, rows):
    old, new = tables
    got = rows(ch.changes(old, new, ["id"]), "id", "g", "v", "_action", "_is_update", "_copies")
    assert got == sorted([
        (2, "a", 20, "DELETE", True, 1), (2, "b", 20, "INSERT", True, 1), (3, "b", 30, "DELETE", False, 1),
        (4, None, 40, "DELETE", True, 1), (4, None, 41, "INSERT", True, 1), (6, "c", 60, "INSERT", False, 1),
        (7, None, 1, "INSERT", False, 1)], key=lambda t: tuple((v is None, str(v)) for v in t))
    assert rows(ch.true_deletes(ch.changes(old, new, ["id"])), "id") == [(3,)]
    assert rows(ch.changes(old, new, ["id"], append_only=True), "id") == [(6,), (7,)]


def test_null_keys_are_matched(spark, rows):
    old = spark.createDataFrame([(None, 1)], "id int, v int")
    new = spark.createDataFrame([(None, 2)], "id int, v int")
    assert rows(ch.changes(old, new, ["id"]), "v", "_action", "_is_update") == [(1, "DELETE", True), (2, "INSERT", True)]


def test_copies_are_counted_not_repeated(spark, rows):
    old = spark.createDataFrame([(1,)] * 5 + [(2,)], "v int")
    new = spark.createDataFrame([(1,)] * 2 + [(3,)] * 3, "v int")
    assert rows(ch.changes(old, new), "v", "_action", "_copies") == [(1, "DELETE", 3), (2, "DELETE", 1), (3, "INSERT", 3)]
    bag = ch.apply_to_bag(ch.as_bag(old), ch.changes(old, new))
    assert rows(bag) == [(1, 2), (3, 3)]


def test_delete_and_reinsert_cancel_out(spark, rows):
    log = spark.createDataFrame(
        [(1, 5, "DELETE", False, 1), (1, 5, "INSERT", False, 1), (2, 5, "DELETE", False, 1), (2, 6, "INSERT", False, 1)],
        "id int, v int, _action string, _is_update boolean, _copies long")
    assert rows(ch.net_changes(log, ["id"]), "id", "v", "_action", "_is_update") == [(2, 5, "DELETE", True), (2, 6, "INSERT", True)]


def test_apply_reaches_the_new_version(tables, rows):
    old, new = tables
    assert rows(ch.apply_changes(old, ch.changes(old, new, ["id"]), ["id"])) == rows(new)
    assert ch.changes(new, new, ["id"]).count() == 0


def versions(seed):
    """Two random versions with NULL groups, moves between groups, deletes."""
    rng = random.Random(seed)

    def row(i):
        return (i, rng.choice(["a", "b", "c", None]), rng.choice([None, rng.randint(-5, 5)]))

    old = [row(i) for i in range(60)]
    new = [row(r[0]) if rng.random() < 0.3 else r for r in old if rng.random() > 0.2] + [row(i) for i in range(60, 75)]
    return old, new


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_maintained_results_equal_recomputation(spark, rows, seed):
    old, new = (spark.createDataFrame(v, SCHEMA) for v in versions(seed))
    delta = ch.changes(old, new, ["id"])
    sums = inc.delta_agg(inc.agg_state(old, ["g"], ["v"]), delta, ["g"], ["v"])
    assert rows(inc.agg_result(sums, ["g"], ["v"])) == rows(inc.agg_result(inc.agg_state(new, ["g"], ["v"]), ["g"], ["v"]))
    edges = inc.delta_minmax(inc.minmax_state(old, ["g"], "v"), delta, new, ["g"], "v")
    assert rows(edges) == rows(inc.minmax_state(new, ["g"], "v"))
    pairs = inc.delta_distinct(ch.as_bag(old.select("g", "v")), ch.changes(old.select("g", "v"), new.select("g", "v")))
    assert rows(pairs.select("g", "v")) == rows(new.select("g", "v").distinct())


@pytest.mark.parametrize("seed", [4, 5])
def test_maintained_joins_equal_recomputation(spark, rows, seed):
    a_old, a_new = (spark.createDataFrame(v, SCHEMA) for v in versions(seed))
    b_rows = versions(seed + 10)
    b_old, b_new = (spark.createDataFrame([(r[1], r[2], r[0]) for r in v if r[1]], "g string, w int, bid int") for v in b_rows)
    da, db = ch.changes(a_old, a_new, ["id"]), ch.changes(b_old, b_new, ["bid"])
    moved = inc.delta_join(a_old, b_old, da, db, ["g"])
    state = ch.apply_to_bag(ch.as_bag(a_old.join(b_old, "g")), moved)
    assert rows(state.select(*sorted(state.columns))) == rows(ch.as_bag(a_new.join(b_new, "g")).select(*sorted(state.columns)))
    for how in ("left", "full"):
        outer = inc.delta_outer_join(a_old.join(b_old, "g", how), a_new, b_new, da, db, ["g"], how)
        expected = a_new.join(b_new, "g", how)
        assert rows(outer.select(*sorted(outer.columns))) == rows(expected.select(*sorted(outer.columns)))


def test_board_trap_and_exact_board(spark, rows):
    old = spark.createDataFrame([(1, 90), (2, 80), (3, 70), (4, 60)], "player int, score int")
    new = spark.createDataFrame([(1, 90), (2, 10), (3, 70), (4, 60)], "player int, score int")
    board = inc.topk_initial(old, "player", "score", 3)
    delta = ch.changes(old, new, ["player"])
    # player 4 is outside the stored board and is not looked at again
    assert rows(inc.topk(board, delta, "player", "score", 3)) == [(1, 90, 1), (2, 10, 3), (3, 70, 2)]
    assert rows(inc.topk(board, delta, "player", "score", 3, source=new)) == [(1, 90, 1), (3, 70, 2), (4, 60, 3)]
    gone = spark.createDataFrame([(2, 80), (3, 70), (4, 60)], "player int, score int")
    assert rows(inc.topk(board, ch.changes(old, gone, ["player"]), "player", "score", 3, source=gone)) == [(2, 80, 1), (3, 70, 2), (4, 60, 3)]


def test_frozen_region_keeps_old_rows_and_null_is_open(spark, rows):
    old = spark.createDataFrame([(1, 100), (9, 1), (None, 5)], "day int, n int")
    source = spark.createDataFrame([(1, 7), (9, 2), (None, 6)], "day int, n int")
    got = inc.refresh_frozen(old, source, lambda df: df, F.col("day") < 5)
    assert rows(got) == [(1, 100), (9, 2), (None, 6)]


# --- MERGE ---------------------------------------------------------------------

def test_first_matching_clause_wins(spark, rows):
    target = spark.createDataFrame([(1, "x", 1), (2, "x", 2), (3, "x", 3), (None, "x", 4)], "id int, s string, v int")
    source = spark.createDataFrame([(1, 10), (2, 20), (5, 50), (6, 5), (None, 70)], "id int, v int")
    got = mg.merge(target, source, ["id"], [
        mg.Matched(condition="s.v > 15", delete=True),
        mg.Matched(update={"v": "s.v + t.v", "s": "'upd'"}),
        mg.NotMatched(condition="s.v >= 50", insert={"id": "s.id", "v": "s.v"}),
    ])
    # NULL keys match nothing: the target row stays, the source row is new
    assert rows(got) == sorted([(1, "upd", 11), (3, "x", 3), (None, "x", 4), (5, None, 50), (None, None, 70)],
                               key=lambda t: tuple((v is None, str(v)) for v in t))


def test_duplicate_source_rows(spark, rows):
    target = spark.createDataFrame([(1, 1)], "id int, v int")
    source = spark.createDataFrame([(1, 5), (1, 6)], "id int, v int")
    clauses = [mg.Matched(update={"v": "s.v"})]
    with pytest.raises(mg.DuplicateMatch):
        mg.merge(target, source, ["id"], clauses)
    assert rows(mg.merge(target, source, ["id"], clauses, "latest", [F.col("v").desc()])) == [(1, 6)]


def test_newest_wins(spark, rows):
    target = spark.createDataFrame([(1, 5, "t"), (2, 9, "t")], "id int, ts int, x string")
    source = spark.createDataFrame([(1, 6, "old"), (1, 7, "new"), (2, 9, "same"), (3, 1, "add")], "id int, ts int, x string")
    assert rows(mg.upsert_newest(target, source, ["id"], "ts")) == [(1, 7, "new"), (2, 9, "t"), (3, 1, "add")]


# --- set operations ---------------------------------------------------------------

def test_anti_keeps_duplicates_and_nulls(spark, rows):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(2,), (None,)], "k int")
    assert rows(anti(left, right, ["k"])) == [(1,), (1,), (None,)]
    assert rows(left.subtract(right)) == [(1,)]


def test_full_outer_as_union(spark, rows):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, x string")
    right = spark.createDataFrame([(2, "B"), (3, "C"), (None, "N")], "k int, y string")
    assert rows(full_outer_as_union(left, right, ["k"])) == rows(left.join(right, "k", "full"))


def test_table_diff_counts_copies(spark, rows):
    left = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    right = spark.createDataFrame([(1,), (None,), (4,)], "k int")
    assert rows(table_diff(left, right), "k", "side", "copies") == [(1, "only_left", 1), (4, "only_right", 1)]


def test_range_of_nulls_goes_with_its_last_row(spark, rows):
    old = spark.createDataFrame([(1, "a", None), (2, "a", None), (3, "b", 4)], SCHEMA)
    new = old.where("g = 'b'")
    state = inc.delta_minmax(inc.minmax_state(old, ["g"], "v"), ch.changes(old, new, ["id"]), new, ["g"], "v")
    assert rows(state) == [("b", 1, 4, 4)]


def test_floating_sums_are_refused(spark):
    with pytest.raises(TypeError):
        inc.agg_state(spark.createDataFrame([("a", 1e17)], "g string, v double"), ["g"], ["v"])


def test_small_change_sets_leave_the_state_in_place(spark):
    old = spark.range(200_000).select("id", (F.col("id") % 7).alias("v"), F.lit("x" * 50).alias("t"))
    path = f"{ch.cut_lineage.__globals__['shared_dir'](spark)}/state-in-place"
    old.write.mode("overwrite").parquet(path)
    state = spark.read.parquet(path)
    delta = ch.changes(state, state.withColumn("v", F.when(F.col("id") == 5, 99).otherwise(F.col("v"))), ["id"])
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "200k")
        plan = ch.apply_changes(state, delta, ["id"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
