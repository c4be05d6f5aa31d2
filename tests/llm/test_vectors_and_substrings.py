"""Clustering, vector codes and substring dedup against plain versions."""

import hashlib
import math
import random

import numpy as np
import pytest

from freshet.llm import ptolemy_clusters, substring_dedup, vector_codes
from freshet.session import scratch_paths
from pyspark.sql import functions as F

from . import brute

SCHEMA = "vec_id long, embedding array<float>, label int"
DOCS = "doc_id long, text string"


def vectors(n=150, dimension=8, seed=1):
    """Points around a few centres, one of which has a third of all, with repeats, ties and unusable rows."""
    rnd = random.Random(seed)
    centres = [[rnd.uniform(-1, 1) for _ in range(dimension)] for _ in range(5)]
    rows = []
    for i in range(n):
        c = centres[0 if i % 3 == 0 else rnd.randrange(5)]
        rows.append((i, [round((x + rnd.gauss(0, 0.1)) * 64) / 64 for x in c], rnd.choice([None, 0, 0, 0, 1, 2])))
    rows += [(7, rows[7][1], 1), (7, rows[8][1], None), (None, rows[3][1], 5), (None, rows[3][1], 5)]
    rows += [(900, None, 1), (901, [], 1), (902, [1.0], 1), (903, [None] + [0.0] * (dimension - 1), 1)]
    rows += [(904 + i, [bad] + [0.0] * (dimension - 1), 1) for i, bad in enumerate([math.nan, math.inf, -math.inf])]
    return rows + [(-5, [-0.0] * dimension, 9), (-6, [1e-9] * dimension, 9), (-7, [-1e-9] * dimension, 9)]


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


CLASHING = ["row", "position", "entry", "salt", "q", "x0", "next", "distance", "code", "error", "cached", "cluster", "v", "of"]


def ones(names):
    return {c: F.lit(1) for c in names}


@pytest.mark.parametrize("parts,entries,rounds", [(4, 6, 5), (2, 200, 2), (8, 1, 1)])
def test_vector_codes(spark, parts, entries, rounds):
    rows = vectors()
    before = scratch_paths(spark)
    got = vector_codes.compress(frame(spark, rows).withColumns(ones(CLASHING)), parts, entries, rounds, 32, 8)
    out = vector_codes.with_label_errors(got).collect()
    want, books = brute.vector_codes(rows, parts, entries, rounds, 32, 8)
    assert sorted(((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in out), key=str) == want
    numbers = ",".join(str(x) for book in books for entry in book for x in entry)
    assert {r["codebooks_sha256"] for r in out} == {hashlib.sha256(numbers.encode()).hexdigest()}
    assert len(scratch_paths(spark)) == len(before) + 1  # the codes; tables of members are gone
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("members_")]


def test_vector_codes_of_nothing(spark):
    nothing = vector_codes.compress(frame(spark, []))
    assert vector_codes.with_label_errors(nothing).count() == 0 and nothing.codebooks == [[]] * 8
    with pytest.raises(ValueError):
        vector_codes.compress(frame(spark, []), parts=7)


def test_only_members_that_change_their_entry_are_shuffled(spark):
    """The plan of a round: sums of owners need no exchange by owner, and the branch of those that stay has none at all."""
    width, owners = 2, 4
    rng = np.random.default_rng(4)
    rows = [(i, int(p), int(e), int(s), int(a), int(b)) for i, (p, e, s, a, b) in enumerate(zip(
        rng.integers(0, 2, 400), rng.integers(0, 3, 400), rng.integers(0, 16, 400), rng.integers(-9, 9, 400), rng.integers(-9, 9, 400)))]
    members = frame(spark, rows, "row long, position int, entry int, salt int, x0 int, x1 int")
    table = vector_codes.stored(members.repartition(owners, *vector_codes.OWNER), owners)
    sums = vector_codes.owner_sums(table.rows(), width)._jdf.queryExecution().executedPlan().toString()
    assert sums.count("Exchange hashpartitioning") == 1 and "hashpartitioning(position" in sums and "salt" not in sums.split("Exchange hashpartitioning")[1].split("\n")[0]
    books = [[[0, 0], [5, 5], [-5, 3]], [[1, -8], [2, 2], [7, 0]]]
    step = vector_codes.migrated(table.rows(), books, width, owners)
    plan = step._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    stay, moved = plan.split("Exchange hashpartitioning")
    assert "(next" in stay and "NOT (next" in moved
    after = {r["row"]: r["entry"] for r in step.collect()}
    assert after == {i: brute.lloyd([[a, b]], books[p], 0)[1][0][0] for i, p, _, _, a, b in rows}
    table.drop()


def test_every_member_lies_with_its_owner(spark):
    """After migration too, a bucket holds nothing but the members of its keys."""
    members = frame(spark, [(i, i % 2, i % 3, i % 16, i) for i in range(300)], "row long, position int, entry int, salt int, x0 int")
    table = vector_codes.stored(members, 4)
    moved = vector_codes.stored(vector_codes.migrated(table.rows(), [[[0], [50], [100]], [[200], [250], [300]]], 1, 4), 4)
    by_file = moved.rows().withColumn("file", F.regexp_extract(F.input_file_name(), r"_(\d{5})", 1).cast("int"))
    assert by_file.count() == 300 and by_file.where(F.col("file") != F.expr("pmod(hash(position, entry, salt), 4)")).isEmpty()
    for t in (table, moved):
        t.drop()


@pytest.mark.parametrize("count,rounds", [(5, 10), (3, 1), (200, 2), (1, 3)])
def test_clusters(spark, count, rounds):
    rows = vectors()
    got = ptolemy_clusters.cluster(frame(spark, rows).withColumns(ones(CLASHING)), count, rounds, 32, 8)
    want, centres = brute.clusters(rows, count, rounds, 32, 8, 3)
    assert sorted(((r["vec_id"], r["cluster"], r["distance"]) for r in got.rows.collect()), key=str) == want
    assert got.centroids == centres
    out = ptolemy_clusters.with_inertia(got).collect()
    assert {r["inertia"] for r in out} == {sum(w[2] for w in want)}
    assert all(r["cluster_inertia"] == sum(w[2] for w in want if w[1] == r["cluster"]) for r in out)
    assert all(r["centroid_sha256"] == hashlib.sha256(",".join(map(str, centres[r["cluster"]])).encode()).hexdigest() for r in out)


def test_clusters_of_nothing(spark):
    assert ptolemy_clusters.with_inertia(ptolemy_clusters.cluster(frame(spark, []))).count() == 0


def test_bounds_never_exceed_the_distance_and_save_work():
    rng = np.random.default_rng(7)
    for spread in (3, 1 << 20):
        centres = rng.integers(-spread, spread, (6, 64))
        x = np.concatenate([c + rng.integers(-spread // 8 - 1, spread // 8 + 2, (300, 64)) for c in centres] + [centres, centres])
        pivots = ptolemy_clusters.Pivots.of(centres.tolist(), 64)
        cached = ptolemy_clusters.pivot_distances(x, pivots.points)
        for moved in (centres, centres + rng.integers(-spread // 4 - 1, spread // 4 + 2, centres.shape), centres[[0, 0, 1, 1, 5, 5]]):
            exact = np.stack([ptolemy_clusters.squared(x, c) for c in moved], axis=1)
            bounds = pivots.bounds(cached, moved)
            assert (bounds ** 2 <= exact).all()  # at the pivots themselves the bound is tight
            cluster, distance, computed = pivots.nearest(x, cached, moved)
            assert (cluster == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
            assert len(x) <= computed <= exact.size
    assert ptolemy_clusters.Pivots.of([[1] * 64, [1] * 64], 64).pairs == []
    far = np.array([[0] * 64, [1000] * 64, [-1000, 1000] * 32])
    x = np.concatenate([c + rng.integers(-9, 9, (200, 64)) for c in far])
    pivots = ptolemy_clusters.Pivots.of(far.tolist(), 64)
    assert pivots.nearest(x, ptolemy_clusters.pivot_distances(x, pivots.points), far + 5)[2] == len(x)  # groups apart: one distance each


def copies():
    """Passages shared by many, copies, passages over the end of each other, repeats within a document, odd rows."""
    rnd = random.Random(3)
    word = lambda: f"w{rnd.randrange(400)}"
    passage, other = [word() for _ in range(40)], [word() for _ in range(30)]
    rows = []
    for i in range(60):
        own = [word() for _ in range(rnd.randrange(60))]
        if i % 3 == 0:
            a = rnd.randrange(25)
            own[10:10] = passage[a:a + rnd.randint(10, 20)]
        if i % 4 == 0:
            own += other[rnd.randrange(10):] + passage[:rnd.randrange(20)]
        rows.append((1000 - i, rnd.choice([" ", "\n", "\t \x0b"]).join(own)))
    rows += [(2000 + i, " ".join(passage + other)) for i in range(40)] + [(1999, " ".join(other[-8:] + passage[:8]))]
    rows += [(3000, " ".join(passage).upper()), (3001, "the " * 13), (3002, "the " * 500), (3003, "the " * 12), (3004, "a b " * 20)]
    rows += [(3005, "\x1c   é " * 9), (3006, " ".join(f"u{i}" for i in range(60_000))), (3007, " ".join(f"u{i}" for i in range(30_000, 30_040)))]
    rows += [(None, None), (None, " ".join(passage)), (None, " ".join(passage)), (-1, None), (-2, ""), (-3, " \n"), (2000, " ".join(passage + other)), (2000, " ".join(other))]
    return rows


@pytest.mark.parametrize("window,anchor", [(13, 5), (5, 5), (4, 1)])
def test_dedup_substrings(spark, window, anchor):
    rows = copies()
    extra = ones(["doc", "content", "row", "spans", "anchor", "first", "n_words", "d0", "kept"])
    out = substring_dedup.dedup_substrings(frame(spark, rows, DOCS).withColumns(extra), window=window, anchor=anchor).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in out), key=str) == sorted(brute.dedup_substrings(rows, window), key=str)
    assert all((r["doc"], r["content"], r["row"], r["d0"]) == (1, 1, 1, 1) for r in out)


def test_factors_stand_in_their_source(spark):
    rows = [r for r in copies() if r[0] is not None and r[0] != 2000]
    words = {d: brute.WORDS.findall(t or "") for d, t in rows}
    found = substring_dedup.factors(frame(spark, rows, DOCS)).collect()
    assert found and all(r["source"] < r["doc"] and r["length"] >= 13 for r in found)
    assert all(words[r["doc"]][r["start"]:r["start"] + r["length"]] == words[r["source"]][r["source_at"]:r["source_at"] + r["length"]] for r in found)
    assert len([r for r in found if r["doc"] == 2039]) <= 20  # factors by first places, not one per copy before it


def test_dedup_substrings_of_nothing(spark):
    assert substring_dedup.dedup_substrings(frame(spark, [], DOCS)).count() == 0
    one = substring_dedup.dedup_substrings(frame(spark, [(1, "a"), (2, None)], DOCS)).collect()
    assert sorted(tuple(r) for r in one) == [(1, "a", 1, 0), (2, "", 0, 0)]
