"""Two small retail plans: orders arriving as JSON, and campaigns next to
support cases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.semistructured import json_struct

# Keys of the purchase JSON (fixed values).
PURCHASE = {"prodid": "bigint", "purchase_amount": "double", "quantity": "int", "purchase_date": "date"}


def stage_customers(customers: DataFrame) -> DataFrame:
    return customers.select(
        F.col("custid").alias("customer_id"),
        F.col("cname").alias("customer_name"),
        F.col("spendlimit").cast("double").alias("spend_limit"),
    )


def stage_orders(orders: DataFrame) -> DataFrame:
    """One parse of the purchase JSON per row; a missing key gives NULL."""
    parsed = orders.select("custid", json_struct("purchase", PURCHASE).alias("p"))
    return parsed.select(
        F.col("custid").alias("customer_id"),
        F.col("p.prodid").alias("product_id"),
        F.col("p.purchase_amount").alias("order_price"),
        F.col("p.quantity").alias("quantity"),
        F.col("p.purchase_date").alias("order_date"),
    )


def customer_orders(customers: DataFrame, orders: DataFrame, with_product: bool = False) -> DataFrame:
    """All customers with their orders; ``with_product`` drops rows without a
    product, which turns the outer join into an inner one."""
    fact = customers.select("customer_id", "customer_name").join(orders, "customer_id", "left")
    return fact.where(F.col("product_id").isNotNull()) if with_product else fact


def campaign_feedback(campaigns: DataFrame, cases: DataFrame, sentiment: str = "sentiment") -> DataFrame:
    """Each campaign row next to the average sentiment of the cases of its
    category.

    The cases are averaged before the join, so a category's campaign rows are
    not paired with each of its cases.
    """
    moods = cases.groupBy(F.col("product").alias("product_name")).agg(F.avg(sentiment).alias("avg_sentiment"))
    return campaigns.select("campaign_name", "clicks", F.col("category").alias("product_name")).join(moods, "product_name").select(
        "campaign_name", "clicks", "product_name", "avg_sentiment")


def clicks_and_satisfaction(campaigns: DataFrame, cases: DataFrame, sentiment: str = "sentiment") -> DataFrame:
    clicks = campaigns.groupBy("category").agg(F.sum("clicks").alias("clicks"))
    mood = cases.groupBy(F.col("product").alias("category")).agg(
        F.count(F.lit(1)).alias("cases"), F.sum(sentiment).alias("_s"), F.count(sentiment).alias("_n")
    )
    return clicks.join(mood, "category").select(
        "category", "clicks", "cases", (F.col("_s").cast("double") / F.col("_n")).alias("avg_sentiment")
    )


def top_campaigns(campaigns: DataFrame, k: int = 5) -> DataFrame:
    return campaigns.groupBy("campaign_name").agg(F.sum("clicks").alias("clicks")).orderBy(
        F.col("clicks").desc(), "campaign_name"
    ).limit(k)


def complaint_summary(cases: DataFrame, issue: str = "issue_category", sentiment: str = "sentiment") -> DataFrame:
    """Cases per issue with how many are negative."""
    return cases.groupBy(issue).agg(
        F.count(F.lit(1)).alias("cases"), F.count_if(F.col(sentiment) < 0).alias("negative_cases")
    )
