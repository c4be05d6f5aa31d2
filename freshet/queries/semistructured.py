"""JSON text, arrays, and the staged order tables built from JSON."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import bindings as b
from ..functions import semistructured as s
from ..plans import retail
from . import query


def events(spark, sf):
    return b.table(spark, sf, "events")


@query("json_fields", """
SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k, props->>'$.missing' AS missing FROM events""")
def _(spark, sf):
    df = s.extract(events(spark, sf), "props", {"k": ("k", "bigint"), "missing": ("missing", "string")})
    return df.select("event_id", "k", "missing")


@query("json_path_variant", "SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k FROM events")
def _(spark, sf):
    return events(spark, sf).select("event_id", s.extract_path("props", "$.k", "bigint").alias("k"))


@query("json_dotted_keys", "SELECT event_id, CAST(user_id AS VARCHAR) AS user_name, event_type AS kind FROM events")
def _(spark, sf):
    attributes = F.to_json(F.struct(F.col("user_id").cast("string").alias("unit.name"),
                                    F.col("event_type").alias("unit.event.kind")))
    df = events(spark, sf).withColumn("attributes", attributes)
    fields = {"user_name": ("unit.name", "string"), "kind": ("unit.event.kind", "string")}
    return s.extract(df, "attributes", fields).select("event_id", "user_name", "kind")


@query("flatten_arrays", r"""
SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents)
WHERE word <> '' GROUP BY 1, 2""")
def _(spark, sf):
    docs = b.table(spark, sf, "documents").select("doc_id", F.split("text", " ").alias("words"))
    return s.flatten(docs, "words", "word").where("word <> ''").groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("n"))


@query("array_contains_and_size", """
SELECT doc_id, len(string_split(text, ' ')) AS pieces, list_contains(string_split(text, ' '), 'the') AS has_the FROM documents""")
def _(spark, sf):
    words = F.split("text", " ")
    return b.table(spark, sf, "documents").select(
        "doc_id", F.size(words).cast("bigint").alias("pieces"), F.array_contains(words, "the").alias("has_the"))


@query("state_from_json_or_text", """
SELECT user_id, CASE WHEN max(value) > 250 THEN 'SUSPENDED' ELSE 'ACTIVE' END AS state FROM events GROUP BY 1""")
def _(spark, sf):
    tables = events(spark, sf).groupBy("user_id").agg(F.max("value").alias("v"))
    state = F.when(F.col("v") > 250, "SUSPENDED").otherwise("ACTIVE")
    as_json = F.to_json(F.struct(state.alias("STATE")))
    return tables.select("user_id", s.state_of(F.when(F.col("v") > 100, as_json).otherwise(state)).alias("state"))


FACT = """
WITH c AS (SELECT c_custkey AS customer_id, c_name AS customer_name FROM customer),
o AS (SELECT o_custkey AS customer_id, l_partkey AS product_id,
        CAST(l_extendedprice AS DOUBLE) AS order_price, CAST(l_quantity AS INTEGER) AS quantity, CAST(o_orderdate AS DATE) AS order_date
      FROM orders JOIN lineitem ON l_orderkey = o_orderkey)
SELECT c.customer_id, customer_name, product_id, order_price, quantity, order_date FROM c LEFT JOIN o ON c.customer_id = o.customer_id"""


@query("staged_customers", """
SELECT c_custkey AS customer_id, c_name AS customer_name, CAST(CAST(c_acctbal AS DECIMAL(10,2)) AS DOUBLE) AS spend_limit FROM customer""")
def _(spark, sf):
    return retail.stage_customers(b.json_customers(spark, sf))


@query("staged_orders", """
SELECT o_custkey AS customer_id, l_partkey AS product_id,
  CAST(l_extendedprice AS DOUBLE) AS order_price, CAST(l_quantity AS INTEGER) AS quantity, CAST(o_orderdate AS DATE) AS order_date
FROM orders JOIN lineitem ON l_orderkey = o_orderkey""")
def _(spark, sf):
    return retail.stage_orders(b.json_orders(spark, sf))


@query("customer_order_fact", FACT)
def _(spark, sf):
    return retail.customer_orders(retail.stage_customers(b.json_customers(spark, sf)), retail.stage_orders(b.json_orders(spark, sf)))


@query("customer_order_fact_clean", FACT + " WHERE product_id IS NOT NULL")
def _(spark, sf):
    return retail.customer_orders(retail.stage_customers(b.json_customers(spark, sf)),
                                  retail.stage_orders(b.json_orders(spark, sf)), with_product=True)
