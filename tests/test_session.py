from pyspark.sql import functions as F

from freshet import session


def test_cuts_are_files_that_their_owner_deletes(spark):
    before = session.scratch_paths(spark)
    df = session.cut_lineage(spark.range(10).withColumn("s", F.struct("id")).where("id < 0"))
    assert df.count() == 0 and df.columns == ["id", "s"]
    kept = session.cut_lineage(spark.range(10))
    mine = [p for p in session.scratch_paths(spark) if p not in before]
    assert len(mine) == 2
    session.release_scratch(spark, mine[:1])
    assert kept.count() == 10 and session.scratch_paths(spark) == [*before, mine[1]]
    session.release_scratch(spark, mine[1:])
    assert session.scratch_paths(spark) == before
