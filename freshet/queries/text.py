"""Text and vector search, enrichment of free text, answer scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import bindings as b
from ..plans import enrich as en
from ..plans import retail
from ..plans import scoring as sc
from ..plans import search as se
from ..plans import text_index, vector_index
from ..session import scratch_path
from ..sources import files
from . import query
from .fragments import with_invoices

WORDS = r"list_filter(regexp_split_to_array(lower({0}), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '')"
DOCS = f"""
doc AS (SELECT doc_id, lang, {WORDS.format('text')} AS words FROM documents),
stat AS (SELECT count(*) AS n, avg(len(words)) AS avg_len FROM doc),
post AS (SELECT doc_id, lang, len(words) AS dl, unnest(words) AS term FROM doc),
tf AS (SELECT term, doc_id, lang, dl, count(*) AS tf FROM post GROUP BY ALL)"""
PART = """ln(1.0 + (n - df + 0.5) / (df + 0.5)) * (tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avg_len)))"""


def documents(spark, sf):
    return b.table(spark, sf, "documents")


@query("searchable_invoices", with_invoices("""
SELECT invoice_id, invoice_number, line_description, vendor_name, approval_status, source_system, cost_center, gl_account, po_number FROM inv"""))
def _(spark, sf):
    return se.searchable_invoices(b.invoices(spark, sf))


@query("text_search", f"""
WITH {DOCS}, hit AS (SELECT * FROM tf WHERE term IN ('rewh', 'thatin', 'orantion')), freq AS (SELECT term, count(*) AS df FROM hit GROUP BY 1)
SELECT doc_id, round(sum({PART}), 6) AS score FROM hit JOIN freq USING (term), stat GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def _(spark, sf):
    return se.bm25(documents(spark, sf).select("doc_id", "text"), "doc_id", "text", "Rewh thatin, orantion?")


@query("text_search_filtered", f"""
WITH {DOCS}, hit AS (SELECT * FROM tf WHERE term IN ('de', 'und', 'ing')), freq AS (SELECT term, count(*) AS df FROM hit GROUP BY 1)
SELECT doc_id, lang, round(sum({PART}), 6) AS score FROM hit JOIN freq USING (term), stat WHERE lang IN ('fr', 'de') GROUP BY 1, 2 ORDER BY 3 DESC, 1 LIMIT 10""")
def _(spark, sf):
    docs = documents(spark, sf).select("doc_id", "lang", "text")
    return se.bm25(docs, "doc_id", "text", "de und ing", filters={"lang": ["fr", "de"]})


@query("text_index", f"WITH {DOCS} SELECT term, doc_id, dl AS length, tf FROM tf")
def _(spark, sf):
    index = se.build_index(documents(spark, sf), "doc_id", "text")
    return index.withColumn("length", F.col("length").cast("bigint"))


@query("text_index_search", f"""
WITH {DOCS}, asked(q, term) AS (VALUES ('a', 'rewh'), ('a', 'thatin'), ('b', 'orantion'), ('b', 'the'), ('c', 'ononst')),
freq AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
scored AS (SELECT q AS question_id, doc_id, round(sum({PART}), 6) AS score FROM asked JOIN tf USING (term) JOIN freq USING (term), stat GROUP BY 1, 2)
SELECT *, CAST(row_number() OVER (PARTITION BY question_id ORDER BY score DESC, doc_id) AS INTEGER) AS place FROM scored QUALIFY place <= 10""")
def _(spark, sf):
    docs = documents(spark, sf)
    path = scratch_path(spark, "index")
    files.write_clustered(se.build_index(docs, "doc_id", "text"), path, ["term"], files=8)
    index = spark.read.parquet(path)
    stats = docs.agg(F.struct(F.count(F.lit(1)).alias("n"), F.avg(F.size(se.tokens("text"))).alias("len"))).scalar()
    questions = spark.createDataFrame([("a", "rewh thatin"), ("b", "orantion the"), ("c", "ononst")], "question_id string, text string")
    return se.search_index(index, "doc_id", stats["n"], stats["len"], questions)


BLOCK_QUESTIONS = "('a', 'rewh'), ('a', 'thatin'), ('b', 'orantion'), ('b', 'the'), ('c', 'ononst')"


def text_blocks(spark, sf, filters=None):
    docs = documents(spark, sf).select("doc_id", "lang", "text")
    index = text_index.build_text_index(docs, "doc_id", "text", scratch_path(spark, "blocks"), ["lang"])
    asked = spark.createDataFrame([("a", "rewh thatin"), ("b", "orantion the"), ("c", "ononst")], "question_id string, text string")
    return text_index.search_text_index(index, asked, filters=filters).rows


@query("text_block_search", f"""
WITH {DOCS}, asked(q, term) AS (VALUES {BLOCK_QUESTIONS}), freq AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
scored AS (SELECT q AS question_id, doc_id, round(sum({PART}), 6) AS score FROM asked JOIN tf USING (term) JOIN freq USING (term), stat GROUP BY 1, 2)
SELECT *, CAST(row_number() OVER (PARTITION BY question_id ORDER BY score DESC, doc_id) AS INTEGER) AS place FROM scored QUALIFY place <= 10""")
def _(spark, sf):
    return text_blocks(spark, sf)


@query("text_block_search_filtered", f"""
WITH {DOCS}, asked(q, term) AS (VALUES {BLOCK_QUESTIONS}), freq AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
scored AS (SELECT q AS question_id, doc_id, round(sum({PART}), 6) AS score FROM asked JOIN tf USING (term) JOIN freq USING (term), stat WHERE lang IN ('fr', 'de') GROUP BY 1, 2)
SELECT *, CAST(row_number() OVER (PARTITION BY question_id ORDER BY score DESC, doc_id) AS INTEGER) AS place FROM scored QUALIFY place <= 10""")
def _(spark, sf):
    return text_blocks(spark, sf, {"lang": ["fr", "de"]})


VECTORS = """SELECT question_id, vec_id, round(cos, 6) AS score, CAST(row_number() OVER (PARTITION BY question_id ORDER BY round(cos, 9) DESC, vec_id) AS INTEGER) AS place
FROM (SELECT q.question_id, e.vec_id, list_cosine_similarity(e.embedding::DOUBLE[], q.vector::DOUBLE[]) AS cos FROM embeddings e, q {0}) QUALIFY place <= 4"""


def questions(spark, sf):
    """One question per label: its first vector."""
    return b.table(spark, sf, "embeddings").groupBy(F.col("label").cast("bigint").alias("question_id")).agg(
        F.min_by("embedding", "vec_id").alias("vector"))


@query("vector_search", "WITH q AS (SELECT CAST(label AS BIGINT) AS question_id, arg_min(embedding, vec_id) AS vector FROM embeddings GROUP BY 1) " + VECTORS.format(""))
def _(spark, sf):
    found = se.vector_topk(b.table(spark, sf, "embeddings"), "vec_id", "embedding", questions(spark, sf), k=4)
    return found.withColumn("score", F.round("score", 6))


@query("vector_search_filtered", "WITH q AS (SELECT CAST(label AS BIGINT) AS question_id, arg_min(embedding, vec_id) AS vector FROM embeddings GROUP BY 1) " + VECTORS.format("WHERE label IN (1, 2, 3)"))
def _(spark, sf):
    found = se.vector_topk(b.table(spark, sf, "embeddings"), "vec_id", "embedding", questions(spark, sf), k=4, filters={"label": [1, 2, 3]})
    return found.withColumn("score", F.round("score", 6))


def vector_cells(spark, sf, filters=None):
    vectors = b.table(spark, sf, "embeddings")
    index = vector_index.build_vector_index(vectors, "vec_id", "embedding", scratch_path(spark, "cells"), ["label"])
    return vector_index.search_vector_index(index, questions(spark, sf), 4, filters).rows.withColumn("score", F.round("score", 6))


@query("vector_index_search", "WITH q AS (SELECT CAST(label AS BIGINT) AS question_id, arg_min(embedding, vec_id) AS vector FROM embeddings GROUP BY 1) " + VECTORS.format(""))
def _(spark, sf):
    return vector_cells(spark, sf)


@query("vector_index_search_filtered", "WITH q AS (SELECT CAST(label AS BIGINT) AS question_id, arg_min(embedding, vec_id) AS vector FROM embeddings GROUP BY 1) " + VECTORS.format("WHERE label IN (1, 2, 3)"))
def _(spark, sf):
    return vector_cells(spark, sf, {"label": [1, 2, 3]})


@query("vector_similarity_to_label", """
WITH q AS (SELECT label, arg_min(embedding, vec_id) AS v FROM embeddings GROUP BY 1)
SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], v::DOUBLE[]), 6) AS score FROM embeddings JOIN q USING (label)""")
def _(spark, sf):
    vectors = b.table(spark, sf, "embeddings")
    firsts = vectors.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("v"))
    return vectors.join(firsts, "label").select("vec_id", F.round(se.cosine("embedding", "v"), 6).alias("score"))


# --- enrichment ----------------------------------------------------------------------

UP, DOWN = ["the", "and", "la", "der"], ["of", "to", "de", "und"]
LABELS = {"Return": {"re": 2, "an": 1}, "Quality": {"th": 2, "that": 1}, "Shipping": {"en": 2, "st": 1}}
MOOD = f"""words AS (SELECT *, {WORDS.format('text')} AS w FROM documents),
counted AS (SELECT *, len(list_filter(w, lambda x: x IN ('the', 'and', 'la', 'der'))) AS up, len(list_filter(w, lambda x: x IN ('of', 'to', 'de', 'und'))) AS down,
  2 * len(list_filter(w, lambda x: x = 're')) + len(list_filter(w, lambda x: x = 'an')) AS a,
  2 * len(list_filter(w, lambda x: x = 'th')) + len(list_filter(w, lambda x: x = 'that')) AS q,
  2 * len(list_filter(w, lambda x: x = 'en')) + len(list_filter(w, lambda x: x = 'st')) AS s FROM words),
mood AS (SELECT CAST(doc_id AS VARCHAR) AS id, source AS product, CASE WHEN up + down > 0 THEN CAST(up - down AS DOUBLE) / (up + down) ELSE 0 END AS sentiment,
  CASE WHEN greatest(a, q, s) = 0 THEN NULL WHEN a >= q AND a >= s THEN 'Return' WHEN q >= s THEN 'Quality' ELSE 'Shipping' END AS issue_category FROM counted)"""


def cases(spark, sf):
    return en.enrich_cases(b.support_cases(spark, sf), positive=UP, negative=DOWN, labels=LABELS)


@query("sentiment_and_category", f"WITH {MOOD} SELECT id, sentiment, issue_category FROM mood")
def _(spark, sf):
    return cases(spark, sf).select("id", "sentiment", "issue_category")


CAMPAIGN = """camp AS (SELECT CAST(ts AS DATE) AS date, event_type AS campaign_name, 'src' || (user_id % 20) AS category, CAST(sum(floor(value)) AS BIGINT) AS clicks FROM events GROUP BY 1, 2, 3)"""


@query("campaign_feedback", f"""
WITH {MOOD}, {CAMPAIGN} SELECT campaign_name, clicks, category AS product_name, avg_sentiment
FROM camp JOIN (SELECT product, round(avg(sentiment), 6) AS avg_sentiment FROM mood GROUP BY 1) ON category = product""")
def _(spark, sf):
    df = retail.campaign_feedback(b.campaigns(spark, sf), cases(spark, sf))
    return df.withColumn("avg_sentiment", F.round("avg_sentiment", 6))


@query("clicks_and_satisfaction", f"""
WITH {MOOD}, {CAMPAIGN}, c AS (SELECT category, CAST(sum(clicks) AS BIGINT) AS clicks FROM camp GROUP BY 1),
m AS (SELECT product AS category, count(*) AS cases, round(avg(sentiment), 6) AS avg_sentiment FROM mood GROUP BY 1)
SELECT category, clicks, cases, avg_sentiment FROM c JOIN m USING (category)""")
def _(spark, sf):
    df = retail.clicks_and_satisfaction(b.campaigns(spark, sf), cases(spark, sf))
    return df.withColumn("avg_sentiment", F.round("avg_sentiment", 6))


@query("top_campaigns", f"WITH {CAMPAIGN} SELECT campaign_name, CAST(sum(clicks) AS BIGINT) AS clicks FROM camp GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5")
def _(spark, sf):
    return retail.top_campaigns(b.campaigns(spark, sf))


@query("complaint_summary", f"""
WITH {MOOD} SELECT issue_category, count(*) AS cases, count(*) FILTER (sentiment < 0) AS negative_cases FROM mood GROUP BY 1""")
def _(spark, sf):
    return retail.complaint_summary(cases(spark, sf))


# --- answer scoring ---------------------------------------------------------------------

CHECKS = list(sc.TESTS) + ["tone"]
NAMED_SQL = "list_filter([{0}], lambda w: contains(upper(answer), w))"


def _hedged():
    return " OR ".join(f"contains(lower(answer), '{w}')" for w in sc.HEDGES)


ANSWERS = f"""ans AS (SELECT conv_id, turn, text AS answer, role AS category,
  [{', '.join(repr(c) for c in CHECKS)}][CAST(length(text) % {len(CHECKS)} AS INTEGER) + 1] AS chk FROM conversations),
names AS (SELECT *, CASE chk WHEN 'mentions_source_system' THEN list_filter(['SAP', 'ORACLE', 'BAAN', 'WORKDAY'], lambda w: contains(upper(answer), w))
  WHEN 'mentions_currency_codes' THEN list_filter(['USD', 'EUR', 'GBP'], lambda w: contains(upper(answer), w))
  WHEN 'mentions_approval_status' THEN list_filter(['APPROVED', 'PENDING'], lambda w: contains(upper(answer), w)) END AS found FROM ans),
judged AS (SELECT *, CASE chk WHEN 'numeric_present' THEN regexp_matches(answer, '\\p{{Nd}}')
  WHEN 'contains_vendor_list' THEN regexp_matches(answer, '(-|\\p{{Nd}}\\.|,)') AND regexp_matches(answer, '\\p{{Nd}}')
  WHEN 'mentions_source_system' THEN len(found) > 0 WHEN 'mentions_currency_codes' THEN len(found) > 0 WHEN 'mentions_approval_status' THEN len(found) > 0
  WHEN 'mentions_time_period' THEN regexp_matches(lower(answer), 'jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec') OR regexp_matches(answer, '\\p{{Nd}}{{4}}-\\p{{Nd}}{{2}}')
  WHEN 'mentions_acme' THEN contains(lower(answer), 'acme') WHEN 'mentions_overdue' THEN regexp_matches(lower(answer), 'overdue|due date|past due')
  WHEN 'mentions_threshold' THEN regexp_matches(lower(answer), '100,?000|100k') WHEN 'no_hallucinated_certainty' THEN {_hedged()} END AS passed FROM names),
scored AS (SELECT *, CASE WHEN chk = 'tone' THEN 'unknown check: tone' WHEN found IS NOT NULL AND passed THEN 'mentions ' || array_to_string(found, ', ')
  {' '.join(f"WHEN chk = '{name}' AND {'passed' if good else 'NOT passed'} THEN '{text}'" for name, notes in sc.NOTES.items() for good, text in ((True, notes[0]), (False, notes[1])) if text)} END AS note FROM judged)"""


def answers(spark, sf):
    picked = F.element_at(F.array(*map(F.lit, CHECKS)), (F.length("text") % len(CHECKS) + 1).cast("int"))
    return b.table(spark, sf, "conversations").select(
        "conv_id", "turn", F.col("text").alias("answer"), F.col("role").alias("category"), picked.alias("check"))


@query("answer_scores", f"""WITH {ANSWERS} SELECT conv_id, turn, chk AS "check", passed, note FROM scored""")
def _(spark, sf):
    return sc.score(answers(spark, sf)).select("conv_id", "turn", "check", "passed", "note")


@query("answer_pass_rate", f"""WITH {ANSWERS} SELECT category, count(*) AS answers, count(*) FILTER (passed) AS passed_answers, count(*) FILTER (passed) / count(*) AS pass_rate FROM scored GROUP BY 1""")
def _(spark, sf):
    return sc.pass_rate(sc.score(answers(spark, sf)), ["category"])


@query("answers_failed", f"""WITH {ANSWERS} SELECT conv_id, turn, chk AS "check", note FROM scored WHERE NOT coalesce(passed, false)""")
def _(spark, sf):
    return sc.failed(sc.score(answers(spark, sf))).select("conv_id", "turn", "check", "note")
