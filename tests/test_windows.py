import random

import pytest
from pyspark.sql import functions as F

from freshet.operators import windows as w


def skewed(seed=3, n=600):
    """A third of all rows belongs to one key, some to the NULL key."""
    rng = random.Random(seed)
    return [(rng.choice([None, "hot", "hot", "a", "b", "c"]), i, rng.choice([None, rng.randint(0, 9)])) for i in range(n)]


def brute(rows):
    by_key = {}
    for key, i, value in sorted(rows, key=lambda r: r[1]):
        by_key.setdefault(key, []).append((i, value))
    out = []
    for key, items in by_key.items():
        total = None
        for place, (i, value) in enumerate(items):
            total = total if value is None else (total or 0) + value
            before = items[place - 1][1] if place else None
            after = items[place + 1][0] if place + 1 < len(items) else None
            out.append((key, i, place + 1, total, before, after))
    return sorted(out, key=lambda r: r[1])


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_ordered_windows_match_brute_force(spark, partitions):
    rows = skewed()
    df = spark.createDataFrame(rows, "k string, i int, v int").repartition(7)
    # without coalescing the hot key lies in many ranges
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = w.ordered_windows(
            df, ["k"], ["i"], totals={"place": F.lit(1), "total": "v"}, previous={"before": "v"}, following={"after": "i"})
        got = sorted((tuple(r) for r in out.select("k", "i", "place", "total", "before", "after").collect()), key=lambda r: r[1])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == brute(rows)


def test_global_order(spark):
    df = spark.createDataFrame([(i, (i * 7) % 11) for i in range(50)], "i int, v int")
    got = {r.i: r.place for r in w.row_numbers(df, [], [F.col("v").desc(), F.col("i")], "place").collect()}
    expected = sorted(range(50), key=lambda i: (-((i * 7) % 11), i))
    assert [got[i] for i in expected] == list(range(1, 51))


def test_ranks_have_gaps(spark, rows):
    df = spark.createDataFrame([("a", 5), ("a", 5), ("a", 3), (None, 1), (None, None)], "k string, v int")
    assert rows(w.ranks(df, ["k"], "v")) == sorted(
        [("a", 5, 1), ("a", 5, 1), ("a", 3, 3), (None, 1, 1), (None, None, 2)],
        key=lambda t: tuple((v is None, str(v)) for v in t))


def test_top_per_key_trims_in_the_map_tasks(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    top = w.top_per_key(df, ["k"], [F.col("id").desc()], 2)
    assert top._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2
    assert sorted(r.id for r in top.collect()) == [94, 95, 96, 97, 98, 99]
