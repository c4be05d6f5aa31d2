"""The registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (backoff, compression_quality, decontamination, jaccard_join, language_id, line_dedup, pii, ptolemy_clusters, rule_ledger,
               sentencepiece_io, substring_dedup, vector_codes)
from .common import documents, fold
from .url_filter import judge_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql.strip()
        return fn

    return register


@query("op1_decontamination", r"""
WITH texts AS (
  SELECT 'd' AS k, doc_id AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') AS w FROM documents
  UNION ALL
  SELECT 'i', item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') FROM benchmark),
shingles AS (
  SELECT DISTINCT k, id, list_slice(w, i, i + 4) AS s
  FROM (SELECT k, id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM texts WHERE len(w) > 0)),
sizes AS (SELECT id, count(*) AS n FROM shingles WHERE k = 'i' GROUP BY id),
held AS (
  SELECT d.id AS doc_id, i.id AS item_id, count(*) AS shared
  FROM shingles d JOIN shingles i ON d.s = i.s WHERE d.k = 'd' AND i.k = 'i' GROUP BY ALL)
SELECT doc_id, item_id, shared, n AS item_shingles FROM held JOIN sizes ON item_id = id WHERE 100 * shared >= 75 * n
""")
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet").select("item_id", "text")
    return decontamination.contained_items(documents(spark, sf_dir), items)


@query("op2_language_id")
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    filters = language_id.fit(docs.where(fold("doc_id", 4) != 2))
    return language_id.identify(docs.select("doc_id", "text"), filters).select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


@query("op3_quality_classifier")
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet").select("doc_id", "quality")
    model = compression_quality.fit(docs, labels.where(fold("doc_id", 3) != 1))
    return compression_quality.score(docs, model).select(
        "doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op4_quality_rules", r"""
WITH words AS (
  SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + 7), ' ') AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM words WHERE len(w) >= 8)),
twice AS (SELECT doc_id, win FROM windows GROUP BY doc_id, win HAVING count(*) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM windows JOIN twice USING (doc_id, win)) GROUP BY doc_id),
measured AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words, len(l)::BIGINT AS n_lines,
         len(list_filter(w, lambda x: regexp_matches(x, '\p{L}')))::BIGINT AS n_letter_words,
         length(regexp_replace(coalesce(text, ''), '\P{L}', '', 'g'))::BIGINT AS n_letters,
         length(regexp_replace(coalesce(text, ''), '\P{Lu}', '', 'g'))::BIGINT AS n_upper,
         len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1]))::BIGINT AS n_run_words
  FROM words LEFT JOIN covered USING (doc_id)),
judged AS (
  SELECT *, (n_words < 20)::BIGINT AS b0, (100 * n_repeat_words > 30 * n_words)::BIGINT AS b1, (word_chars < 2 * n_words)::BIGINT AS b2,
         (word_chars > 15 * n_words)::BIGINT AS b3, (100 * n_symbols > 10 * n_words)::BIGINT AS b4, (100 * n_dup_lines > 40 * n_lines)::BIGINT AS b5,
         (100 * n_letter_words < 80 * n_words)::BIGINT AS b6, (100 * n_upper > 50 * n_letters)::BIGINT AS b7,
         (100 * n_run_words > 30 * n_words)::BIGINT AS b8 FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, b0 + b1 > 0 AS base_failed, b0 + b1 + b2 + b3 + b4 + b5 + b6 + b7 + b8 = 0 AS kept,
       b0 + 2 * b1 + 4 * b2 + 8 * b3 + 16 * b4 + 32 * b5 + 64 * b6 + 128 * b7 + 256 * b8 AS fail_bits
FROM judged
""")
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rule_ledger.ledger(documents(spark, sf_dir))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~rule_ledger.passes("2026-1")).alias("base_failed"), rule_ledger.passes().alias("kept"), "fail_bits")


@query("op5_sentencepiece")
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_io.digests(documents(spark, sf_dir).select("doc_id", "text")).drop("text")


@query("op6_pii")
def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    rows = pii.find_spans(docs, pii.fit(docs))
    count = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return rows.select(
        "doc_id", *[count(kind) for kind in pii.KINDS], F.sha2(pii.as_text(F.col("base_spans")), 256).alias("base_sha256"),
        pii.as_text(F.col("spans")).alias("spans"))


@query("op7_line_dedup", r"""
WITH lines AS (
  SELECT doc_id, i, l, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
windows AS (
  SELECT doc_id, i AS a, lead(i, 2) OVER w AS b, struct_pack(x := l, y := lead(l) OVER w, z := lead(l, 2) OVER w) AS win
  FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY k)),
ordered AS (SELECT *, row_number() OVER (PARTITION BY win ORDER BY doc_id NULLS LAST, a) AS n FROM windows WHERE b IS NOT NULL),
gone AS (SELECT DISTINCT doc_id, unnest(range(a, b + 1)) AS i FROM ordered WHERE n > 1),
every AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS l, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents),
rest AS (
  SELECT doc_id, string_agg(l, chr(10) ORDER BY i) FILTER (WHERE g IS NULL) AS text, count(g) AS lines_removed
  FROM (SELECT e.*, g.i AS g FROM every e LEFT JOIN gone g ON e.doc_id = g.doc_id AND e.i = g.i) GROUP BY doc_id)
SELECT d.doc_id, length(coalesce(r.text, ''))::INTEGER AS n_chars_left, coalesce(r.lines_removed, 0) AS lines_removed, sha256(coalesce(r.text, '')) AS text_sha256
FROM documents d LEFT JOIN rest r USING (doc_id)
""")
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    text = F.coalesce("text", F.lit(""))
    return line_dedup.dedup_lines(docs).select(
        "doc_id", F.length(text).alias("n_chars_left"), "lines_removed", F.sha2(text, 256).alias("text_sha256"))


@query("op8_lm_scoring", r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') AS w FROM documents),
tokens AS (SELECT doc_id, len(w) AS n, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM texts),
unigrams AS (SELECT x, count(*) AS c FROM tokens GROUP BY x),
total AS (SELECT count(*) AS total FROM tokens),
own AS (SELECT doc_id, x, count(*) AS own FROM tokens GROUP BY ALL),
words AS (
  SELECT t.doc_id, t.i, t.x, v.c - o.own AS elsewhere, greatest(total - t.n, 1) AS others
  FROM tokens t JOIN own o ON t.doc_id = o.doc_id AND t.x = o.x JOIN unigrams v ON t.x = v.x, total),
alone AS (
  SELECT *, CASE WHEN elsewhere > 0 THEN ln(elsewhere / others) ELSE ln(0.4::DOUBLE) - ln(others) END AS p,
         lag(x) OVER d AS before, lag(elsewhere) OVER d AS before_elsewhere
  FROM words WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
pairs AS (SELECT before, x, count(*) AS c FROM alone WHERE i > 1 GROUP BY ALL),
own_pairs AS (SELECT doc_id, before, x, count(*) AS own FROM alone WHERE i > 1 GROUP BY ALL),
terms AS (
  SELECT a.doc_id, CASE WHEN a.i = 1 THEN round(1000000 * p)
                        WHEN coalesce(q.c - o.own, 0) > 0 THEN round(1000000 * ln((q.c - o.own) / before_elsewhere))
                        ELSE round(1000000 * (ln(0.4::DOUBLE) + p)) END::BIGINT AS term
  FROM alone a LEFT JOIN pairs q ON a.before = q.before AND a.x = q.x
  LEFT JOIN own_pairs o ON a.doc_id = o.doc_id AND a.before = o.before AND a.x = o.x),
scored AS (SELECT doc_id, count(*) AS n_words, sum(term)::BIGINT AS total FROM terms GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(total, 0) / 1000000 AS log_score, total / 1000000 / n_words AS score
FROM documents d LEFT JOIN scored USING (doc_id)
""")
def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return backoff.score_corpus(docs)


#: The rules of the query, fixed values.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


@query("op9_url_filters", r"""
WITH parts AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^([^/?#]*)([^?#]*)', 2) AS path FROM parts),
rules(rule_host, rule_path, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fits AS (
  SELECT s.*, r.rule_host || r.rule_path AS rule, r.verdict,
         row_number() OVER (PARTITION BY s.page_id ORDER BY length(r.rule_host) + length(r.rule_path) DESC, length(r.rule_host) DESC) AS n
  FROM split s LEFT JOIN rules r
    ON (s.host = r.rule_host OR ends_with(s.host, '.' || r.rule_host)) AND starts_with(s.path, r.rule_path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE n = 1
""")
def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet").select("page_id", "url")
    return judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@query("op10_jaccard_join")
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed, _ = jaccard_join.join(documents(spark, sf_dir))
    return jaccard_join.component_ids(placed).select(
        F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet")


def _chain(rounds: int, step: str) -> str:
    """``step`` once per round: what it calls {r} and {s} are the round's number and the next."""
    return ",\n".join(step.replace("{r}", str(r)).replace("{s}", str(r + 1)) for r in range(rounds))


FLOOR_MEAN = "((s - ((s % n) + n) % n) // n)"
WHOLE_VECTORS = """kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(SCALE * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
numbered AS (SELECT q, row_number() OVER (ORDER BY FIRST NULLS LAST, q) - 1 AS e FROM kept)"""


@query("op11_centroid_clusters", f"""
WITH {WHOLE_VECTORS.replace("SCALE", "1024").replace("FIRST", "sha256('3:' || vec_id)")},
x AS MATERIALIZED (SELECT vec_id, unnest(q) AS x, unnest(range(64)) AS i FROM kept),
c0 AS MATERIALIZED (SELECT e, unnest(q) AS c, unnest(range(64)) AS i FROM numbered WHERE e < 8),
""" + _chain(10, f"""a{{r}} AS MATERIALIZED (
  SELECT vec_id, min(struct_pack(d := d, e := e)) AS m
  FROM (SELECT vec_id, e, sum((x - c) * (x - c))::BIGINT AS d FROM x JOIN c{{r}} USING (i) GROUP BY ALL) GROUP BY vec_id),
c{{s}} AS MATERIALIZED (
  SELECT c.e, coalesce(v, c) AS c, c.i FROM c{{r}} c LEFT JOIN (
    SELECT e, i, {FLOOR_MEAN}::BIGINT AS v FROM (
      SELECT m.e AS e, i, sum(x)::BIGINT AS s, count(*)::BIGINT AS n FROM a{{r}} JOIN x USING (vec_id) GROUP BY ALL)) u ON c.e = u.e AND c.i = u.i)""") + """,
last AS (
  SELECT vec_id, min(struct_pack(d := d, e := e)) AS m
  FROM (SELECT vec_id, e, sum((x - c) * (x - c))::BIGINT AS d FROM x JOIN c10 USING (i) GROUP BY ALL) GROUP BY vec_id),
digests AS (SELECT e, sha256(string_agg(c::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c10 GROUP BY e)
SELECT vec_id, m.e::INTEGER AS cluster, m.d AS distance, (sum(m.d) OVER (PARTITION BY m.e))::BIGINT AS cluster_inertia,
       (sum(m.d) OVER ())::BIGINT AS inertia, centroid_sha256
FROM last JOIN digests ON digests.e = m.e
""")
def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ptolemy_clusters.with_inertia(ptolemy_clusters.cluster(embeddings(spark, sf_dir)))


@query("op12_substring_dedup", r"""
WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + 12), ' ') AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM texts WHERE len(w) >= 13)),
firsts AS (SELECT win, min(doc_id) AS least FROM windows GROUP BY win),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM windows JOIN firsts USING (win) WHERE least < doc_id),
words AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM texts),
rest AS (
  SELECT doc_id, count(*) AS n_words, count(g.i) AS n_removed, string_agg(x, ' ' ORDER BY i) FILTER (WHERE g.i IS NULL) AS kept
  FROM words LEFT JOIN gone g USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN rest USING (doc_id)
""")
def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return substring_dedup.dedup_substrings(docs).select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query("op13_vector_codes", f"""
WITH {WHOLE_VECTORS.replace("SCALE", "4096").replace("FIRST", "vec_id")},
x AS MATERIALIZED (SELECT vec_id, unnest(q) AS x, unnest(range(64)) // 8 AS p, unnest(range(64)) % 8 AS i FROM kept),
c0 AS MATERIALIZED (SELECT e, unnest(q) AS c, unnest(range(64)) // 8 AS p, unnest(range(64)) % 8 AS i FROM numbered WHERE e < 16),
""" + _chain(6, f"""a{{r}} AS MATERIALIZED (
  SELECT vec_id, p, min(struct_pack(d := d, e := e)) AS m
  FROM (SELECT vec_id, p, e, sum((x - c) * (x - c))::BIGINT AS d FROM x JOIN c{{r}} USING (p, i) GROUP BY ALL) GROUP BY vec_id, p),
c{{s}} AS MATERIALIZED (
  SELECT c.e, coalesce(v, c) AS c, c.p, c.i FROM c{{r}} c LEFT JOIN (
    SELECT p, e, i, {FLOOR_MEAN}::BIGINT AS v FROM (
      SELECT p, m.e AS e, i, sum(x)::BIGINT AS s, count(*)::BIGINT AS n FROM a{{r}} JOIN x USING (vec_id, p) GROUP BY ALL)) u
    ON c.p = u.p AND c.e = u.e AND c.i = u.i)""") + """,
last AS (
  SELECT vec_id, p, min(struct_pack(d := d, e := e)) AS m
  FROM (SELECT vec_id, p, e, sum((x - c) * (x - c))::BIGINT AS d FROM x JOIN c6 USING (p, i) GROUP BY ALL) GROUP BY vec_id, p),
codes AS (
  SELECT vec_id, string_agg(lpad(lower(hex(m.e)), 2, '0'), '' ORDER BY p) AS code, sum(m.d)::BIGINT AS error FROM last GROUP BY vec_id),
digest AS (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY p, e, i)) AS codebooks_sha256 FROM c6)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM codes JOIN kept USING (vec_id), digest
""")
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.with_label_errors(vector_codes.compress(embeddings(spark, sf_dir))).select(
        "vec_id", "code", "error", "label_error", "codebooks_sha256")
