import random

import pytest

from freshet.operators import bitmaps as bm
from freshet.operators import changes as ch

SCHEMA = "region string, day int, id long"


def brute(rows, width):
    groups = {}
    for row in rows:
        groups.setdefault(row[:width], set()).add(row[2])
    return {k: len(v - {None}) for k, v in groups.items()}


def counts_of(state, keys):
    return {tuple(r)[:-1]: r.n for r in bm.distinct_counts(state, keys, "n").collect()}


def sample(rng, n):
    # a third of the rows in one group; ids over several buckets, NULL groups and ids, repeated rows
    return [("hot" if rng.random() < 0.3 else rng.choice(["a", "b", None]), rng.choice([1, 2, None]),
             rng.choice([None, 0, 5, 32767, 32768, 32769, rng.randrange(200_000)])) for _ in range(n)]


def test_inserts_and_deletions(spark):
    rng = random.Random(3)
    old = sample(rng, 300)
    new = [r for r in old if rng.random() < 0.6] + sample(rng, 80) + [("none", 1, None)]
    new = [r for r in new if r[0] != "b"]  # a whole group goes
    before, after = (spark.createDataFrame(rows, SCHEMA) for rows in (old, new))
    delta = ch.changes(before, after)
    keys = ["region", "day"]
    counts = bm.delta_row_counts(bm.row_counts(before, keys, "id"), delta, keys, "id")
    state = bm.delta_bitmaps(bm.bitmaps(before, keys, "id"), delta, keys, "id", counts)
    assert counts_of(state, keys) == brute(new, 2)
    assert counts_of(bm.rolled_up(state, ["region"]), ["region"]) == brute(new, 1)
    assert {tuple(r) for r in state.drop("id_bits").collect()} == {
        tuple(r) for r in bm.bitmaps(after, keys, "id").drop("id_bits").collect()}
    assert brute(new, 2)[("none", 1)] == 0


def test_insert_only_needs_no_counts(spark):
    before = spark.createDataFrame([("a", 1, 1), ("a", 1, 40_000)], SCHEMA)
    after = spark.createDataFrame([("a", 1, 1), ("a", 1, 40_000), ("a", 1, 2), ("c", 1, 2)], SCHEMA)
    keys = ["region"]
    state = bm.delta_bitmaps(bm.bitmaps(before, keys, "id"), ch.changes(before, after), keys, "id")
    assert counts_of(state, keys) == {("a",): 3, ("c",): 1}
    with pytest.raises(Exception, match="deletions need row counts"):
        bm.delta_bitmaps(state, ch.changes(after, before), keys, "id").collect()


def test_no_change_and_empty_tables(spark):
    rows = spark.createDataFrame([("a", 1, 1)], SCHEMA)
    none = rows.limit(0)
    keys = ["region"]
    counts = bm.row_counts(rows, keys, "id")
    assert counts_of(bm.delta_bitmaps(bm.bitmaps(rows, keys, "id"), ch.changes(rows, rows), keys, "id", counts), keys) == {("a",): 1}
    assert counts_of(bm.bitmaps(none, keys, "id"), keys) == {}
