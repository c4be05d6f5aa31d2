import pytest
from pyspark.sql import functions as F

from freshet.operators import changes as ch
from freshet.plans.refresh import Maintained, MaintainedTables, RetentionError
from freshet.streaming import files as st
from freshet.streaming import versions as sv
from freshet.streaming.buckets import BucketedTable, newest, totals

SCHEMA = "id int, ts int, name string"


def table(spark, path, parts=8, layout=SCHEMA):
    return BucketedTable(spark, str(path), ["id"], layout, parts=parts)


def batch(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def latest(df):
    return newest(["id"], [F.col("ts").desc(), F.col("name")])(df)


def test_newest_rows_of_many_batches(spark, tmp_path, rows):
    kept, best = table(spark, tmp_path / "t"), {}
    sink = kept.upsert(latest)
    for n in range(4):
        part = [(i, (i * 7 + n * 5) % 11, f"{n}-{i}") for i in range(n, 40, n + 1)] + [(None, n, f"null{n}"), (None, n, f"null{n}")]
        for i, ts, name in part:
            if i not in best or (-ts, name) < (-best[i][0], best[i][1]):
                best[i] = (ts, name)
        sink(batch(spark, part), f"s-{n}", n)
    assert rows(kept.read()) == sorted(((i, *v) for i, v in best.items()), key=lambda t: tuple((v is None, str(v)) for v in t))


def test_reading_does_not_depend_on_the_number_of_batches(spark, tmp_path):
    kept = table(spark, tmp_path / "t", parts=4)
    for n in range(6):
        kept.upsert(latest)(batch(spark, [(i, n, "x") for i in range(20)]), f"s-{n}", n)
    folders = {f.rsplit("/", 1)[0] for f in kept.read().inputFiles()}
    assert len(folders) <= 4 and all("/s-5/" in f for f in folders)


def test_only_touched_buckets_are_rewritten(spark, tmp_path, rows):
    kept = table(spark, tmp_path / "t", parts=16)
    kept.upsert(latest)(batch(spark, [(i, 0, "old") for i in range(200)]), "s-0", 0)
    before, _ = kept.manifest()
    kept.upsert(latest)(batch(spark, [(3, 1, "new")]), "s-1", 1)
    after, taken = kept.manifest()
    moved = [b for b in after if after[b] != before[b]]
    assert len(before) == 16 and len(moved) == 1 and taken == {"s": 1}
    assert rows(kept.read().where("name = 'new'")) == [(3, 1, "new")] and kept.read().count() == 200


def test_a_batch_counts_once(spark, tmp_path, rows):
    kept = table(spark, tmp_path / "t", layout="id int, n long")
    sink = kept.upsert(totals(["id"], ["n"]))
    one = spark.createDataFrame([(1, 2), (1, 3), (2, 1), (None, 4)], "id int, n long")
    sink(one, "s-0", 0)
    sink(one, "s-0", 0)  # handed over again after it was taken in
    sink(one, "other-0", 0)  # the first batch of another stream is another batch
    assert rows(kept.read()) == [(1, 10), (2, 2), (None, 8)]


def test_a_crash_before_the_manifest_is_made_good(spark, tmp_path, rows, monkeypatch):
    kept = table(spark, tmp_path / "t", layout="id int, n long")
    sink = kept.upsert(totals(["id"], ["n"]))
    one = spark.createDataFrame([(i, 1) for i in range(30)], "id int, n long")
    sink(one, "s-0", 0)
    with monkeypatch.context() as m:
        m.setattr(BucketedTable, "_manifest_path", lambda self, v: (_ for _ in ()).throw(OSError("lost")) if v == 2 else
                  f"{self.root}/manifest/v{v:08d}")
        with pytest.raises(OSError):
            sink(one, "s-1", 1)
    assert {r["n"] for r in kept.read().collect()} == {1}  # the folders of the lost attempt are in no manifest
    sink(one, "s-1", 1)
    assert {r["n"] for r in kept.read().collect()} == {2} and kept.read().count() == 30


def test_vacuum_keeps_what_is_listed(spark, tmp_path, rows):
    kept = table(spark, tmp_path / "t", parts=4)
    for n in range(3):
        kept.upsert(latest)(batch(spark, [(i, n, "x") for i in range(n * 5, 20)]), f"s-{n}", n)
    before = rows(kept.read())
    gone = kept.vacuum()
    assert gone and kept.versions() == [3] and rows(kept.read()) == before
    kept.upsert(latest)(batch(spark, [(1, 9, "y")]), "s-3", 3)
    assert kept.versions() == [3, 4] and kept.read().count() == 20


def test_empty_table_and_empty_batch(spark, tmp_path):
    kept = table(spark, tmp_path / "t")
    assert kept.read().count() == 0
    assert kept.rewrite(batch(spark, []), lambda old: old, "s-0") == []
    assert kept.read().count() == 0 and kept.manifest() == ({}, {"s": 0})


def test_rows_of_keys_that_the_batch_does_not_hold(spark, tmp_path):
    kept = table(spark, tmp_path / "t", parts=64)
    with pytest.raises(ValueError):
        kept.rewrite(batch(spark, [(1, 1, "x")]), lambda old: batch(spark, [(i, 1, "x") for i in range(50)]), "s-0")


def test_batches_of_a_stream(spark, tmp_path, rows):
    src, kept = str(tmp_path / "in"), table(spark, tmp_path / "t")
    for part in ([(1, 5, "a"), (2, 1, "b")], [(1, 4, "late"), (3, 1, "c")]):
        batch(spark, part).write.mode("append").parquet(src)
        st.run_available(st.read_new_files(spark, src, SCHEMA), kept.upsert(latest), str(tmp_path / "offsets"))
    assert rows(kept.read()) == [(1, 5, "a"), (2, 1, "b"), (3, 1, "c")]


# --- change sets as a stream ---------------------------------------------------------

V = [[(1, 1, "a"), (2, 1, "b"), (3, 1, "c")], [(1, 2, "a"), (3, 1, "c"), (4, 1, "d")], [(1, 2, "a"), (2, 5, "again")], []]


def chain(spark, path, parts=4):
    tables = MaintainedTables(spark, str(path), max_delta_ratio=100.0)
    tables.add_base("base", ["id"])
    tables.add(Maintained("all", ["base"], compute=lambda t: t["base"], touched=lambda d: d["base"],
                          apply=lambda old, d, t: ch.apply_changes(old, d["base"], ["id"])), keys=["id"], parts=parts)
    return tables


def test_streamed_copy_equals_the_table(spark, tmp_path, rows):
    tables, kept = chain(spark, tmp_path / "m"), table(spark, tmp_path / "copy")
    for version in V:
        tables.publish("base", batch(spark, version))
        tables.refresh("all")
        sv.follow(tables, "all", kept.copy(), str(tmp_path / "offsets"))
        assert rows(kept.read()) == rows(tables.read("all")) == rows(batch(spark, version))


def test_versions_missed_are_made_up_for(spark, tmp_path, rows):
    tables, kept, seen = chain(spark, tmp_path / "m"), table(spark, tmp_path / "copy"), []

    def sink(change_set, name, batch_id):
        seen.append(rows(change_set.groupBy("_action", "_is_update").agg(F.sum("_copies"))))
        kept.copy()(change_set, name, batch_id)

    for n, version in enumerate(V):
        tables.publish("base", batch(spark, version))
        tables.refresh("all")
        if n in (0, 2):  # the third call covers two versions
            sv.follow(tables, "all", sink, str(tmp_path / "offsets"))
    sv.follow(tables, "all", sink, str(tmp_path / "offsets"))
    sv.follow(tables, "all", sink, str(tmp_path / "offsets"))  # nothing new
    assert kept.read().count() == 0
    assert seen == [[("INSERT", False, 3)], [("DELETE", False, 1), ("DELETE", True, 2), ("INSERT", True, 2)], [("DELETE", False, 2)]]


def test_a_failed_batch_covers_the_same_versions(spark, tmp_path, rows):
    tables, kept, offsets = chain(spark, tmp_path / "m"), table(spark, tmp_path / "copy"), str(tmp_path / "offsets")
    tables.publish("base", batch(spark, V[0]))
    tables.refresh("all")

    def failing(change_set, name, batch_id):
        raise OSError("lost")

    with pytest.raises(Exception, match="lost"):
        sv.follow(tables, "all", failing, offsets)
    tables.publish("base", batch(spark, V[1]))
    tables.refresh("all")
    sizes = []
    sv.follow(tables, "all", lambda c, name, i: (sizes.append(c.count()), kept.copy()(c, name, i)), offsets)
    assert sizes[0] == 3 and rows(kept.read()) == rows(batch(spark, V[1]))  # the first batch again, then the rest


def test_a_table_without_keys_and_an_expired_version(spark, tmp_path, rows):
    tables, got = MaintainedTables(spark, str(tmp_path / "m")), []
    tables.add_base("bag")
    one = [(1, 1, "a"), (1, 1, "a"), (2, 1, None)]
    tables.publish("bag", batch(spark, one))
    take = lambda c, name, i: got.append(rows(c.select("id", "_action", "_copies")))
    sv.follow(tables, "bag", take, str(tmp_path / "o"))
    assert got == [[(1, "INSERT", 2), (2, "INSERT", 1)]]
    tables.publish("bag", batch(spark, one[1:]))
    tables.publish("bag", batch(spark, []))
    tables.expire("bag", 3)
    with pytest.raises(Exception, match=RetentionError.__name__):
        sv.follow(tables, "bag", take, str(tmp_path / "o"))
