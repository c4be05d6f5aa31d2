"""Indexes that skip what cannot be among the best: same answers as a full scan, less read."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from freshet.plans import search, text_index, vector_index


def clustered(spark, n=600, width=8):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, width))
    data = [(i, (centres[0 if i % 3 == 0 else i % 12] + rng.normal(size=width) * 0.05).round(3).tolist(), i % 2) for i in range(n)]
    data[9] = (9, data[3][1], 1)  # a tie
    data += [(1000, None, 0), (1001, [None] + [1.0] * (width - 1), 1), (1002, [0.0] * width, 0), (1003, [0.0] * width, 1)]
    return spark.createDataFrame(data, "id long, v array<double>, side int").repartition(5), centres


def as_rows(df):
    return sorted((str(r["question_id"]), r["place"], r["id"], r["score"]) for r in df.collect() if r["score"] is not None) + sorted(
        (str(r["question_id"]), r["place"], r["id"]) for r in df.collect() if r["score"] is None)


@pytest.mark.parametrize("k,filters", [(5, None), (1, None), (7, {"side": 1}), (700, None)])
def test_vector_index_gives_the_answers_of_a_full_scan(spark, tmp_path, k, filters):
    vectors, centres = clustered(spark)
    asked = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centres)] + [(50, [0.0] * 8), (51, (-centres[0]).tolist())], "question_id long, vector array<double>")
    index = vector_index.build_vector_index(vectors, "id", "v", str(tmp_path / "i"), ["side"], centres=16, rings=3, sample=300)
    found = vector_index.search_vector_index(index, asked, k, filters)
    assert as_rows(found.rows) == as_rows(search.vector_topk(vectors, "id", "v", asked, k, filters))
    assert found.read <= found.of


def test_vector_index_skips_partitions(spark, tmp_path):
    vectors, centres = clustered(spark)
    index = vector_index.build_vector_index(vectors, "id", "v", str(tmp_path / "i"), centres=16, rings=3, sample=300)
    asked = spark.createDataFrame([(0, centres[4].tolist())], "question_id long, vector array<double>")
    found = vector_index.search_vector_index(index, asked, 5)
    assert as_rows(found.rows) == as_rows(search.vector_topk(vectors, "id", "v", asked, 5))
    assert found.read <= 0.25 * found.of
    plan = found.rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cell" in plan
    cells = {c["cell"]: c for c in index.cells().collect()}
    stored = index.rows().groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("most")).collect()
    assert all((cells[r["cell"]]["n"], cells[r["cell"]]["most"]) == (r["n"], r["most"]) for r in stored) and len(stored) == len(cells)


def test_vector_bounds_hold(spark, tmp_path):
    rng = np.random.default_rng(8)
    data = rng.normal(size=(300, 5))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "id long, v array<double>")
    index = vector_index.build_vector_index(frame, "id", "v", str(tmp_path / "i"), centres=6, rings=2, sample=50)
    cells = index.cells().collect()
    asked, _ = vector_index._unit(rng.normal(size=(40, 5)))
    bounds = vector_index.bounds_of(cells, asked)
    where = {r["id"]: r["cell"] for r in index.rows().collect()}
    unit, _ = vector_index._unit(data)
    for j, c in enumerate(cells):
        own = unit[[i for i, cell in where.items() if cell == c["cell"]]]
        assert (asked @ own.T <= bounds[:, [j]] + vector_index.MARGIN).all()


def test_vector_index_of_nothing(spark, tmp_path):
    frame = spark.createDataFrame([], "id long, v array<double>")
    index = vector_index.build_vector_index(frame, "id", "v", str(tmp_path / "i"))
    asked = spark.createDataFrame([(0, [1.0])], "question_id long, vector array<double>")
    assert vector_index.search_vector_index(index, asked).rows.count() == 0
    some = vector_index.build_vector_index(spark.createDataFrame([(1, [1.0, 0.0])], frame.schema), "id", "v", str(tmp_path / "j"))
    assert vector_index.search_vector_index(some, asked.limit(0)).rows.count() == 0


def texts(spark, n=400):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(n):
        size = int(rng.integers(1, 12)) if i % 3 == 0 else int(rng.integers(1, 300))
        rows.append((i, " ".join(f"w{int(x)}" for x in 60 * rng.random(size) ** 2) + (" Rare, words" if i % 97 == 0 else "") + (" hit" if i % 10 == 0 else ""), i % 2))
    rows += [(900, "", 0), (901, None, 1), (902, rows[3][1], 0), (903, rows[3][1], 1)]
    return spark.createDataFrame(rows, "id long, text string, side int").repartition(3)


@pytest.mark.parametrize("k,filters", [(3, None), (10, {"side": 1}), (500, None)])
def test_text_index_gives_the_answers_of_a_full_scan(spark, tmp_path, k, filters):
    docs = texts(spark)
    asked = spark.createDataFrame([("a", "w1 w2"), ("b", "rare"), ("c", "w30, words! w0 w0"), ("d", "unknown"), ("e", ""), ("f", "w55 unknown")], "question_id string, text string")
    index = text_index.build_text_index(docs, "id", "text", str(tmp_path / "i"), ["side"], buckets=16)
    found = text_index.search_text_index(index, asked, k, filters)
    got = sorted((r["question_id"], r["place"], r["id"], r["score"]) for r in found.rows.collect())
    want = []
    for q in asked.collect():
        rows = search.bm25(docs, "id", "text", q["text"], k, filters).collect()
        want += [(q["question_id"], i, r["id"], r["score"]) for i, r in enumerate(rows, 1)]
    assert got == sorted(want)
    assert found.read <= found.of


def test_text_index_skips_buckets(spark, tmp_path):
    index = text_index.build_text_index(texts(spark), "id", "text", str(tmp_path / "i"), buckets=16)
    asked = spark.createDataFrame([("a", "hit"), ("b", "hit rare")], "question_id string, text string")
    found = text_index.search_text_index(index, asked, 3)
    assert found.rows.count() == 6 and found.read <= 0.7 * found.of  # short texts have the highest impact
    blocks = index.blocks().collect()
    saturation = search._saturation(F.col("tf"), F.col("length"), F.lit(index.statistics().first()["len"]))
    most = {(r["term"], r["bucket"]): (r["m"], r["n"]) for r in index.postings().groupBy("term", "bucket").agg(F.max(saturation).alias("m"), F.count(F.lit(1)).alias("n")).collect()}
    assert most == {(b["term"], b["bucket"]): (b["impact"], b["n"]) for b in blocks}


def test_text_index_of_nothing(spark, tmp_path):
    index = text_index.build_text_index(spark.createDataFrame([], "id long, text string"), "id", "text", str(tmp_path / "i"))
    asked = spark.createDataFrame([("a", "w1")], "question_id string, text string")
    assert text_index.search_text_index(index, asked).rows.count() == 0
