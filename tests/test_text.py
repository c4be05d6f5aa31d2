import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from freshet.plans import enrich, scoring, search

DOCS = [(1, "Hydraulic pump and hydraulic hose", "a"), (2, "safety gloves", "a"), (3, "pump", "b"), (4, "", "b"),
        (5, "Pümp für Öl — pump!", "b"), (6, "pump", "a")]


def brute_bm25(question):
    import re

    words = {i: re.findall(r"[^\W_]+", text.lower()) for i, text, _ in DOCS}
    n, avg = len(DOCS), sum(map(len, words.values())) / len(DOCS)
    scores = {}
    for term in dict.fromkeys(re.findall(r"[^\W_]+", question.lower())):
        df = sum(term in w for w in words.values())
        idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
        for i, w in words.items():
            tf = w.count(term)
            if tf:
                scores[i] = scores.get(i, 0) + idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(w) / avg))
    return sorted(((i, round(s, 6)) for i, s in scores.items()), key=lambda p: (-p[1], p[0]))


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(DOCS, "id int, text string, kind string")


@pytest.mark.parametrize("question", ["pump", "hydraulic PUMP", "gloves öl", "nothing here", "!!"])
def test_bm25_matches_brute_force(spark, docs, question):
    expected = brute_bm25(question)
    assert [(r.id, r.score) for r in search.bm25(docs, "id", "text", question).collect()] == expected
    index = search.build_index(docs, "id", "text")
    stats = docs.agg(F.struct(F.count(F.lit(1)).alias("n"), F.avg(F.size(search.tokens("text"))).alias("len"))).scalar()
    asked = spark.createDataFrame([("q", question)], "question_id string, text string")
    found = search.search_index(index, "id", stats["n"], stats["len"], asked).orderBy("place").collect()
    assert [(r.id, r.score) for r in found] == expected


def test_filters_do_not_change_scores(docs):
    everything = dict(brute_bm25("pump"))
    got = search.bm25(docs, "id", "text", "pump", filters={"kind": "b"}).collect()
    assert [(r.id, r.score) for r in got] == [(3, everything[3]), (5, everything[5])]


def test_vector_search_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    data = rng.normal(size=(200, 8)).round(3)
    data[7] = data[3]  # a tie, decided by the id
    data[11] = 0
    frame = spark.createDataFrame([(i, v.tolist(), i % 2) for i, v in enumerate(data)], "id long, v array<double>, side int").repartition(5)
    asked = spark.createDataFrame([("a", data[3].tolist()), ("b", data[50].tolist())], "question_id string, vector array<double>")
    got = {}
    for r in search.vector_topk(frame, "id", "v", asked, k=6).orderBy("question_id", "place").collect():
        got.setdefault(r.question_id, []).append(r.id)
    for name, q in (("a", data[3]), ("b", data[50])):
        norms = np.linalg.norm(data, axis=1)
        cos = np.round(np.divide(data @ q, norms * np.linalg.norm(q), out=np.zeros(200), where=norms > 0), 9)
        assert got[name] == sorted(range(200), key=lambda i: (-cos[i], i))[:6]
    odd = search.vector_topk(frame, "id", "v", asked, k=3, filters={"side": 1}).collect()
    assert all(r.id % 2 == 1 for r in odd)


def test_sentiment_and_category(spark):
    df = spark.createDataFrame([(1, "Great shoes, great price, but late delivery"), (2, "I want a refund and a return"), (3, "plain words")], "id int, transcript string")
    got = {r.id: (r.sentiment, r.issue_category) for r in enrich.enrich_cases(df).collect()}
    assert got[1] == (pytest.approx(1 / 3), "Shipping")
    assert got[2] == (-1.0, "Return")
    assert got[3] == (0.0, None)


ANSWERS = [
    ("numeric_present", "total is 5", True), ("numeric_present", "none", False), ("contains_vendor_list", "1. Acme", True),
    ("contains_vendor_list", "Acme, Summit", False), ("mentions_source_system", "from sap and Workday", True),
    ("mentions_currency_codes", "in eur", True), ("mentions_approval_status", "all paid", False), ("mentions_time_period", "in 2025-01", True),
    ("mentions_time_period", "last March", True), ("mentions_acme", "ACME Corp", True), ("mentions_overdue", "Past due", True),
    ("mentions_threshold", "over 100,000", True), ("mentions_threshold", "over 100k", True), ("mentions_threshold", "over 10,000", False),
    ("no_hallucinated_certainty", "Could you specify a window?", True), ("no_hallucinated_certainty", "It is Acme.", False), ("tone", "x", None),
]


def test_answer_checks(spark):
    df = spark.createDataFrame([(i, c, a) for i, (c, a, _) in enumerate(ANSWERS)], "id int, check string, answer string")
    rows = scoring.score(df).orderBy("id").collect()
    assert [r.passed for r in rows] == [p for _, _, p in ANSWERS]
    assert rows[4].note == "mentions SAP, WORKDAY" and rows[6].note == "no approval status named"
    assert rows[-1].note == "unknown check: tone"
    total = scoring.pass_rate(scoring.score(df)).first()
    assert (total.answers, total.passed_answers) == (17, 11)
    assert scoring.failed(scoring.score(df)).count() == 6


def test_any_number_of_vector_questions(spark):
    frame = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(20)] + [(90, None), (91, [None, 1.0])], "id long, v array<double>")
    asked = spark.createDataFrame([(i, [float(i % 20), 1.0]) for i in range(300)], "question_id long, vector array<double>")
    best = search.vector_topk(frame, "id", "v", asked, k=1).collect()
    assert len(best) == 300 and all(r.id == r.question_id % 20 for r in best)
    every = search.vector_topk(frame, "id", "v", asked.limit(1), k=30).collect()
    assert len(every) == 22 and {r.id for r in every if r.score is None} == {90, 91}
    assert search.vector_topk(frame, "id", "v", asked.limit(0), k=3).count() == 0
    with pytest.raises(Exception, match="elements of the questions"):
        search.vector_topk(frame.unionByName(spark.createDataFrame([(5, [1.0])], frame.schema)), "id", "v", asked, k=1).collect()
