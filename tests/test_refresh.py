import pytest
from pyspark.sql import functions as F

from freshet.operators import changes as ch
from freshet.operators import incremental as inc
from freshet.plans import refresh
from freshet.plans.refresh import Maintained, MaintainedTables, RetentionError


def orders(spark, n, bump=0):
    return spark.range(n).select("id", (F.col("id") % 3).alias("g"), (F.col("id") + bump).alias("v"))


def totals(t):
    return t["orders"].groupBy("g").agg(F.sum("v").alias("total"))


@pytest.fixture
def tables(spark, tmp_path):
    t = MaintainedTables(spark, str(tmp_path / "db"), max_delta_ratio=0.2)
    t.add_base("orders", ["id"])
    t.add(Maintained("copy", ["orders"], compute=lambda f: f["orders"],
                     apply=lambda old, d, f: ch.apply_changes(old, d["orders"], ["id"])), keys=["id"])
    t.add(Maintained("totals", ["copy"], compute=lambda f: f["copy"].groupBy("g").agg(F.sum("v").alias("total"))), keys=["g"])
    t.publish("orders", orders(spark, 100))
    return t


def actions(t, name):
    done = t.history().where(F.col("name") == name).orderBy("refresh_start_time")
    return [(r.state, r.refresh_action) for r in done.collect()]


def test_actions_follow_the_size_of_the_change(spark, tables, rows):
    tables.refresh("totals")
    tables.refresh("totals")
    tables.publish("orders", orders(spark, 105))
    tables.refresh("totals")
    tables.publish("orders", orders(spark, 105, bump=1))
    tables.refresh("totals")
    assert actions(tables, "copy") == [
        ("SUCCEEDED", "FULL"), ("SUCCEEDED", "NO_DATA"), ("SUCCEEDED", "INCREMENTAL"), ("SUCCEEDED", "FULL")]
    assert rows(tables.read("copy")) == rows(orders(spark, 105, bump=1))
    expected = orders(spark, 105, bump=1).groupBy("g").agg(F.sum("v").alias("total"))
    assert rows(tables.read("totals")) == rows(expected)


def test_schema_change_rebuilds(spark, tables):
    tables.refresh("copy")
    tables.publish("orders", orders(spark, 100).withColumn("extra", F.lit(1)))
    tables.refresh("copy")
    assert actions(tables, "copy")[-1] == ("SUCCEEDED", "REINITIALIZE")
    assert "extra" in tables.read("copy").columns


def test_failure_keeps_the_old_version_and_marks_readers(spark, tables, rows):
    tables.refresh("totals")
    before = rows(tables.read("copy"))
    broken = Maintained("copy", ["orders"], compute=lambda f: f["orders"].select(
        "id", "g", F.when(F.col("id") >= 0, F.raise_error(F.lit("bad row"))).otherwise(F.col("v")).cast("long").alias("v")), mode="FULL")
    tables.definitions["copy"] = broken
    tables.publish("orders", orders(spark, 101))
    tables.refresh("totals")
    assert actions(tables, "copy")[-1][0] == "FAILED"
    assert actions(tables, "totals")[-1][0] == "UPSTREAM_FAILED"
    assert rows(tables.read("copy")) == before
    assert "bad row" in tables.history().where("state = 'FAILED'").first().state_message


def test_gate_holds_small_changes_back(spark, tables):
    tables.definitions["copy"] = Maintained(
        "copy", ["orders"], compute=lambda f: f["orders"],
        apply=lambda old, d, f: ch.apply_changes(old, d["orders"], ["id"]), gate=lambda n: n >= 10)
    tables.refresh("copy")
    tables.publish("orders", orders(spark, 103))
    tables.refresh("copy")
    assert actions(tables, "copy")[-1][0] == "SKIPPED"
    tables.publish("orders", orders(spark, 112))
    tables.refresh("copy")
    assert actions(tables, "copy")[-1] == ("SUCCEEDED", "INCREMENTAL")
    assert tables.read("copy").count() == 112


def test_expired_history_fails_the_refresh(spark, tables):
    tables.refresh("copy")
    tables.publish("orders", orders(spark, 101))
    tables.expire("orders", 2)
    tables.refresh("copy")
    assert actions(tables, "copy")[-1][0] == "FAILED"
    with pytest.raises(RetentionError):
        tables.read("orders", 1)


def test_order_and_unknown_inputs(tables):
    assert tables.order("totals") == ["copy", "totals"]
    with pytest.raises(ValueError):
        tables.add(Maintained("x", ["nowhere"], compute=lambda f: None))


def test_handed_over_change_sets_are_used_and_netted(spark, tables, rows):
    tables.refresh("copy")
    first, second, third = (orders(spark, n) for n in (100, 102, 101))
    tables.publish("orders", second, ch.changes(first, second, ["id"]))
    tables.publish("orders", third, ch.changes(second, third, ["id"]))
    between = tables.changes_between("orders", 1, 3)
    assert rows(between, "id", "_action") == [(100, "INSERT")]  # 101 came and went
    tables.refresh("copy")
    assert actions(tables, "copy")[-1] == ("SUCCEEDED", "INCREMENTAL")
    assert rows(tables.read("copy")) == rows(third)


def test_tables_with_a_past_are_not_rebuilt_by_size(spark, tmp_path, rows):
    """Enrichment as of then: the same rows whether 2 or 20 are new."""
    for n in (2, 20):
        t = MaintainedTables(spark, str(tmp_path / f"db{n}"), max_delta_ratio=0.05)
        for name in ("facts", "names"):
            t.add_base(name, ["id"])
        t.add(Maintained(
            "enriched", ["facts", "names"], stateful=True, compute=lambda f: f["facts"].join(f["names"], "id", "left"),
            apply=lambda old, d, f: old.unionByName(
                d["facts"].where("_action = 'INSERT'").select("id").join(f["names"], "id", "left"))), keys=["id"])
        t.publish("facts", spark.range(100))
        t.publish("names", spark.range(200).withColumn("name", F.lit("old")))
        t.refresh("enriched")
        t.publish("names", spark.range(200).withColumn("name", F.lit("new")))
        t.publish("facts", spark.range(100 + n))
        t.refresh("enriched")
        assert rows(t.read("enriched").groupBy("name").count()) == [("new", n), ("old", 100)]
        t.publish("names", spark.range(200).withColumn("name", F.lit("new")).withColumn("more", F.lit(1)))
        t._checked.clear()
        t.refresh("enriched")
        assert actions(t, "enriched")[-1][0] == "FAILED" and "more" not in t.read("enriched").columns
        t.rebuild("enriched")
        assert rows(t.read("enriched").groupBy("name").count()) == [("new", 100 + n)]


def test_incremental_refresh_does_not_build_the_whole(spark, tables):
    calls = []
    tables.definitions["copy"] = Maintained(
        "copy", ["orders"], compute=lambda f: calls.append(1) or f["orders"],
        apply=lambda old, d, f: ch.apply_changes(old, d["orders"], ["id"]))
    tables.refresh("copy")
    for n in (101, 102, 103):
        tables.publish("orders", orders(spark, n))
        tables.refresh("copy")
    assert len(calls) == 2  # the first contents, and one look at the layout


def test_gate_counts_rows_and_messages_are_kept_whole(spark, tmp_path):
    seen = []
    t = MaintainedTables(spark, str(tmp_path / "db"))
    t.add_base("bag")
    t.add(Maintained("copy", ["bag"], compute=lambda f: f["bag"], apply=lambda old, d, f: f["bag"], gate=lambda n: seen.append(n) or True))
    t.publish("bag", spark.range(100).select(F.lit(1).alias("v")))
    t.refresh("copy")
    t.publish("bag", spark.range(600).select(F.lit(1).alias("v")))
    t.refresh("copy")
    assert seen == [500]

    def fail(frames):
        raise RuntimeError("x" * 2000)

    t.definitions["copy"] = Maintained("copy", ["bag"], compute=fail, mode="FULL")
    t.publish("bag", spark.range(601).select(F.lit(1).alias("v")))
    t.refresh("copy")
    assert len(t.history().where("state = 'FAILED'").first().state_message) == 2000


@pytest.fixture
def in_parts(spark, tmp_path):
    """orders -> copy (16 buckets) -> totals per group of 50 (8 buckets)."""
    t = MaintainedTables(spark, str(tmp_path / "db"), max_delta_ratio=0.2)
    t.add_base("orders", ["id"])
    t.add(Maintained("copy", ["orders"], compute=lambda f: f["orders"], touched=lambda d: d["orders"],
                     apply=lambda old, d, f: ch.apply_changes(old, d["orders"], ["id"])), keys=["id"], parts=16)
    t.add(Maintained("totals", ["copy"], compute=grouped, touched=lambda d: d["copy"],
                     apply=lambda old, d, f: inc.delta_agg(old, d["copy"], ["g"], ["v"])), keys=["g"], parts=8)
    return t


def grouped(f):
    return inc.agg_state(f["copy"], ["g"], ["v"])


def keyed(spark, n, bump=()):
    rows = spark.range(n).select("id", (F.col("id") % 50).alias("g"), F.col("id").alias("v"))
    return rows.withColumn("v", F.when(F.col("id").isin(list(bump)), -F.col("v")).otherwise(F.col("v"))) if bump else rows


def bucket_files(t, name, version):
    import os

    path = t._path(name, version)
    return sorted(d for d in os.listdir(path) if d.startswith("_bucket=")) if os.path.isdir(path) else []


def test_a_refresh_writes_touched_buckets_and_hands_its_changes_on(spark, in_parts, rows, monkeypatch):
    t = in_parts
    t.publish("orders", keyed(spark, 1000))
    t.refresh("totals")
    assert len(bucket_files(t, "copy", 1)) == 16 and set(t.manifest("copy").values()) == {1}
    second = keyed(spark, 1000, bump=(7, 57))
    t.publish("orders", second, ch.changes(keyed(spark, 1000), second, ["id"]))
    compared = []
    real = refresh.changes
    monkeypatch.setattr(refresh, "changes", lambda old, new, keys: compared.append((old.count(), new.count())) or real(old, new, keys))
    t.refresh("totals")
    assert actions(t, "copy")[-1] == actions(t, "totals")[-1] == ("SUCCEEDED", "INCREMENTAL")
    # two rows of one group: at most two buckets of the copy, one of the totals; only touched rows are compared
    assert 1 <= len(bucket_files(t, "copy", 2)) <= 2 and len(bucket_files(t, "totals", 2)) == 1
    assert compared == [(2, 2), (1, 1)]
    assert sorted(set(t.manifest("copy").values())) == [1, 2] and len(t.manifest("copy")) == 16
    assert rows(t.read("copy")) == rows(second) and rows(t.read("totals")) == rows(grouped({"copy": second}))
    assert rows(t.read("copy", 1)) == rows(keyed(spark, 1000))  # the version before is still whole
    log = t.changes_between("totals", 1, 2)
    assert rows(log, "g", "_action", "_is_update") == [(7, "DELETE", True), (7, "INSERT", True)]
    counts = {(r.name, r.version): r.row_count for r in t.history().collect() if r.state == "SUCCEEDED"}
    assert counts["copy", 2] == 1000 and counts["totals", 2] == 50


def test_parts_follow_inserts_and_deletions(spark, in_parts, rows):
    t = in_parts
    for n in (1000, 1003, 995, 995):
        t.publish("orders", keyed(spark, n))
        t.refresh("totals")
        assert rows(t.read("copy")) == rows(keyed(spark, n)) and rows(t.read("totals")) == rows(grouped({"copy": keyed(spark, n)}))
    assert rows(t.changes_between("copy", 1, 3), "id", "_action") == [(i, "DELETE") for i in range(995, 1000)]
    assert [r.row_count for r in t.history().where("name = 'copy' AND state = 'SUCCEEDED'").orderBy("refresh_start_time").collect()] == [1000, 1003, 995, 995]


def test_buckets_that_lose_all_rows_and_empty_tables(spark, in_parts, rows):
    t = in_parts
    t.max_delta_ratio = 10
    for n in (20, 2, 0, 3):
        t.publish("orders", keyed(spark, n))
        t.refresh("totals")
        assert rows(t.read("copy")) == rows(keyed(spark, n)) and rows(t.read("totals")) == rows(grouped({"copy": keyed(spark, n)}))
        assert len(t.manifest("copy")) <= n


def test_keys_that_are_not_named_are_refused(spark, in_parts):
    t = in_parts
    t.definitions["copy"] = Maintained("copy", ["orders"], compute=lambda f: f["orders"], touched=lambda d: d["orders"].where("id = 3"),
                                       apply=lambda old, d, f: f["orders"])
    t.publish("orders", keyed(spark, 100))
    t.refresh("copy")
    t.publish("orders", keyed(spark, 101))
    t.refresh("copy")
    assert actions(t, "copy")[-1][0] == "FAILED" and t.version("copy") == 1 and t.read("copy").count() == 100
    with pytest.raises(ValueError):
        t.add(Maintained("bag", ["orders"], compute=lambda f: f["orders"]), parts=4)


def test_vacuum_keeps_what_a_kept_version_lists(spark, in_parts, rows):
    t = in_parts
    for n in (100, 101, 102):
        t.publish("orders", keyed(spark, n))
        t.refresh("copy")
    t.expire("copy", 3)
    gone = t.vacuum("copy")
    assert gone and rows(t.read("copy")) == rows(keyed(spark, 102))
    assert any(v < 3 for v in t.manifest("copy").values()) and not t.vacuum("copy")
    with pytest.raises(RetentionError):
        t.read("copy", 2)
