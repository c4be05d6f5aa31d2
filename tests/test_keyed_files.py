import pytest
from pyspark.sql import functions as F

from freshet.operators.merge import DuplicateMatch, Matched, NotMatched, merge
from freshet.plans.keyed_files import KeyedFiles

LAYOUT = "id long, part string, v long"
CLAUSES = [Matched(delete=True, condition="s.v < 0"), Matched(update={"v": "s.v"}), NotMatched(insert={"id": "s.id", "part": "s.part", "v": "s.v"})]


def rows_of(spark, ids, v=1):
    return spark.createDataFrame([(i, "ab"[i % 2], v * i) for i in ids], LAYOUT)


@pytest.fixture
def table(spark, tmp_path):
    t = KeyedFiles(spark, str(tmp_path / "t"), ["id", "part"], LAYOUT, rows_per_file=100)
    t.replace(rows_of(spark, range(0, 4000, 2)).unionByName(spark.createDataFrame([(None, "a", 5), (4, None, 6)], LAYOUT)))
    return t


@pytest.mark.parametrize("ids", [[10, 12, 3990], [11, 13], [5000, 5001], []])
def test_merge_of_files_equals_merge_of_the_whole(spark, table, rows, ids):
    source = rows_of(spark, ids, 7).unionByName(spark.createDataFrame([(20, "a", -1), (21, "b", -1), (None, "a", 9), (4, None, 9)], LAYOUT))
    whole = merge(table.read(), source, ["id", "part"], CLAUSES)
    expected, before = rows(whole), rows(table.read())
    done = table.merge(source, CLAUSES)
    assert rows(table.read()) == expected and rows(table.read(done.version - 1)) == before
    assert done.read <= 4 < done.of


def test_files_without_a_key_are_not_read(spark, table, rows):
    total = table.manifest().count()
    assert total >= 20
    assert len(table.candidates(rows_of(spark, [100]))) == 1
    # inside the ranges, but odd ids are in no file: the filters say so but for a false positive
    assert len(table.candidates(rows_of(spark, range(1, 41, 2)))) <= 1
    assert table.candidates(rows_of(spark, [9999])) == [] and table.candidates(rows_of(spark, [])) == []
    part = table._rows(table.candidates(rows_of(spark, [100, 3000])))
    assert len(part.inputFiles()) == 2 and len(table.read().inputFiles()) == total
    every = {r["file"] for r in table.manifest().where("low IS NOT NULL").collect()}
    assert set(table.candidates(rows_of(spark, range(0, 4000, 2)))) == every  # no key is ever missed


def test_overlapping_files_after_several_merges(spark, table, rows):
    for i, ids in enumerate([range(1, 400, 2), range(300, 900, 3), [3999], range(0, 4000, 401)]):
        source = rows_of(spark, ids, 10 + i)
        expected = rows(merge(table.read(), source, ["id", "part"], CLAUSES))
        done = table.merge(source, CLAUSES)
        assert rows(table.read()) == expected and done.read < done.of
    kept = [r["file"] for r in table.manifest().collect()]
    assert len(kept) == len(set(kept)) and table.versions() == [1, 2, 3, 4, 5]


def test_duplicate_matches_leave_the_version(spark, table):
    with pytest.raises(DuplicateMatch):
        table.merge(rows_of(spark, [2, 2]), CLAUSES)
    assert table.versions() == [1]


def test_merge_into_nothing(spark, tmp_path, rows):
    t = KeyedFiles(spark, str(tmp_path / "t"), ["id"], LAYOUT)
    assert t.read().count() == 0
    done = t.merge(rows_of(spark, [1, 2]), CLAUSES)
    assert rows(t.read()) == rows(rows_of(spark, [1, 2])) and (done.read, done.of) == (0, 0)
    t.merge(spark.createDataFrame([(1, "b", -1), (2, "a", -1)], LAYOUT), CLAUSES)
    assert t.read().count() == 0 and t.merge(rows_of(spark, [3]), CLAUSES).version == 3


@pytest.mark.parametrize("kind,values", [("string", ["a", "é", "zz", ""]), ("date", None), ("decimal(10,2)", None)])
def test_keys_of_other_types(spark, tmp_path, rows, kind, values):
    base = spark.range(400).select((F.col("id") * 3).alias("n"))
    key = F.lpad(F.col("n").cast("string"), 6, "0") if kind == "string" else F.date_add(F.lit("2020-01-01").cast("date"), F.col("n").cast("int")) if kind == "date" else F.col("n")
    data = base.select(key.cast(kind).alias("k"), F.col("n").alias("v"))
    t = KeyedFiles(spark, str(tmp_path / "t"), ["k"], f"k {kind}, v long", rows_per_file=40)
    t.replace(data)
    source = data.where("v % 600 = 0").withColumn("v", F.lit(-5).cast("long"))
    clauses = [Matched(update={"v": "s.v"}), NotMatched(insert={"k": "s.k", "v": "s.v"})]
    expected = rows(merge(data, source, ["k"], clauses))
    done = t.merge(source, clauses)
    assert rows(t.read()) == expected and done.read <= 3 < done.of
