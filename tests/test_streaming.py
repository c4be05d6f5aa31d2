import pytest
from pyspark.sql import functions as F

from freshet.streaming import alerts as al
from freshet.streaming import files as st

SCHEMA = "id int, ts int, name string, state string"


def drop(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def stream(spark, path, **options):
    return st.read_new_files(spark, path, SCHEMA, **options)


def test_files_are_taken_once(spark, tmp_path, rows):
    src, out, offsets = (str(tmp_path / n) for n in ("in", "out", "offsets"))
    drop(spark, src, [(1, 1, "a", "x")])
    st.append_new(stream(spark, src), out, offsets)
    drop(spark, src, [(2, 1, "b", "x")])
    st.append_new(stream(spark, src), out, offsets)
    st.append_new(stream(spark, src), out, offsets)
    assert rows(spark.read.parquet(out), "id") == [(1,), (2,)]


def test_replayed_batch_replaces_itself(spark, tmp_path, rows):
    out = str(tmp_path / "out")
    write = st.batch_writer(out)
    batch = spark.createDataFrame([(1, 1, "a", "x")], SCHEMA)
    write(batch, "a-0", 0)
    write(batch, "a-0", 0)
    assert rows(spark.read.parquet(out), "id") == [(1,)]


def test_new_checkpoint_adds_to_the_table(spark, tmp_path, rows):
    src, more, out = (str(tmp_path / n) for n in ("in", "more", "out"))
    drop(spark, src, [(i, 1, "a", "x") for i in range(5)])
    st.append_new(stream(spark, src), out, str(tmp_path / "o1"))
    drop(spark, more, [(i, 1, "b", "x") for i in range(5, 8)])
    st.append_new(stream(spark, more), out, str(tmp_path / "o2"))
    assert rows(spark.read.parquet(out), "id") == [(i,) for i in range(8)]


def test_newest_row_wins_across_batches(spark, tmp_path, rows):
    src, out, offsets = (str(tmp_path / n) for n in ("in", "out", "offsets"))
    order = [F.col("ts").desc(), F.col("name")]
    drop(spark, src, [(1, 5, "first", "x"), (1, 4, "older", "x"), (2, 1, "two", "x")])
    drop(spark, src, [(1, 9, "newest", "x"), (2, 0, "late", "x")])
    st.upsert_newest(stream(spark, src, per_batch=1), out, offsets, ["id"], order)
    assert rows(st.read_newest(spark, out, ["id"], order), "id", "name") == [(1, "newest"), (2, "two")]
    st.compact(spark, out, str(tmp_path / "compact"), ["id"], order)
    assert rows(st.read_newest(spark, str(tmp_path / "compact"), ["id"], order), "id", "name") == [(1, "newest"), (2, "two")]


def test_alert_lists_ten_names_and_counts_all(spark, tmp_path):
    src, out, offsets = (str(tmp_path / n) for n in ("in", "out", "offsets"))
    drop(spark, src, [(i, i, f"t{i:02d}", "FAILED") for i in range(15)] + [(99, 0, "fine", "SUCCEEDED")])
    al.alert_on_new(stream(spark, src), out, offsets)
    alert = spark.read.parquet(out).first()
    assert alert.event_count == 15 and alert.message.endswith("t08, t09") and "t10" not in alert.message
    drop(spark, src, [(100, 0, "fine", "SUCCEEDED")])
    al.alert_on_new(stream(spark, src), out, offsets)
    assert spark.read.parquet(out).count() == 1  # nothing failed, no alert


def test_lag_limits():
    assert st.lag_trigger(300) == {"processingTime": "300 seconds"}
    with pytest.raises(ValueError):
        st.lag_trigger(30)
    with pytest.raises(ValueError):
        st.lag_trigger(120, upstream_lag_seconds=300)
