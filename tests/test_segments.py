import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from freshet.operators import aggregates as agg
from freshet.operators import changes as ch
from freshet.operators import segments as sg

SCHEMA = "k string, at int, id int, v long"


def sample(rng, ids):
    # one key holds half of the rows; NULL keys, orders and values, ties in the order
    return [(rng.choice(["hot", "hot", "a", None]), rng.choice([None, *range(-12, 40)]), i, rng.choice([None, -3, 5, 7])) for i in ids]


def brute(rows):
    out, groups = {}, {}
    for row in rows:
        groups.setdefault(row[0], []).append(row)
    for members in groups.values():
        total, place = None, 0
        for row in sorted(members, key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
            total = total if row[3] is None else (total or 0) + row[3]
            place += 1
            out[row[2]] = (total, place)
    return out


def running():
    return sg.RunningTotals(["k"], ["at", "id"], {"total": F.col("v"), "place": F.lit(1).cast("bigint")}, F.floor(F.col("at") / 10))


def read(totals, state):
    return {r.id: (r.total, r.place) for r in totals.read(state).collect()}


def test_running_totals_follow_changes(spark):
    rng = random.Random(11)
    old = sample(rng, range(120))
    new = [r if rng.random() < 0.9 else (*r[:3], 100) for r in old if rng.random() < 0.8 and r[0] != "a"]
    new += sample(rng, range(200, 230))
    before, after = (spark.createDataFrame(r, SCHEMA) for r in (old, new))
    totals = running()
    state = totals.build(before)
    assert read(totals, state) == brute(old)
    assert read(totals, totals.refresh(state, after, ch.changes(before, after, ["id"]))) == brute(new)
    assert read(totals, totals.build(before.limit(0))) == {}


def test_a_change_in_a_hot_key_touches_one_segment(spark):
    rows = [("hot", i % 50, i, i) for i in range(500)]
    changed = [(k, at, i, 1000 if i == 23 else v) for k, at, i, v in rows]
    before, after = (spark.createDataFrame(r, SCHEMA) for r in (rows, changed))
    totals, delta = running(), ch.changes(before, after, ["id"])
    touched, again = totals.replaced(after, delta)
    assert [tuple(r) for r in touched.collect()] == [("hot", 2)] and again.count() == 100
    assert read(totals, totals.refresh(totals.build(before), after, delta)) == brute(changed)


def test_floating_totals_are_refused(spark):
    df = spark.createDataFrame([("a", 1, 1, 1)], SCHEMA).withColumn("v", F.col("v").cast("double"))
    with pytest.raises(TypeError):
        running().build(df)


def test_percentiles_follow_changes(spark):
    rng = random.Random(13)
    shares = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p100": 1.0}

    def values(n, low):
        return [(rng.choice(["hot", "hot", None, "b"]), rng.choice([None, low, rng.randrange(low, 900)])) for _ in range(n)]

    old = values(200, -50)
    new = [r for r in old if rng.random() < 0.7 and r[0] != "b"] + values(60, 300) + [("c", None), ("d", 4)]
    before, after = (spark.createDataFrame(r, "k string, v int") for r in (old, new))
    counted = sg.ValueCounts(["k"], "v", F.floor(F.col("v") / 100))
    state = counted.refresh(counted.build(before), ch.changes(before, after))

    def result(df):
        return {tuple(r) for r in df.collect()}

    assert result(counted.percentiles(state, shares)) == result(agg.percentiles(after, ["k"], F.col("v"), shares))
    # the median is looked for in one or two ranges a key
    kept = counted.hit(state, {"p50": 0.5}).groupBy("k").count().agg(F.max("count")).first()[0]
    assert kept <= 2 and state.segments.groupBy("k").count().agg(F.max("count")).first()[0] > 5
    assert counted.percentiles(counted.build(before.limit(0)), shares).isEmpty()


def test_percentiles_of_a_whole_table(spark):
    rows = spark.createDataFrame([(Decimal(v),) for v in (1, 2, 3, 10)], "v decimal(10,2)")
    counted = sg.ValueCounts([], "v", F.floor(F.col("v") / 2))
    assert counted.percentiles(counted.build(rows), {"p": 0.5}).collect()[0].p == 2.5
