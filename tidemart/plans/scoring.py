"""Batch scoring of candidate lists and the bookkeeping of released versions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def candidate_rows(requests: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """(request_id, customer_unique_id, product_key, known) per candidate.

    ``requests`` has request_id, customer_unique_id and the candidates as JSON text. Text that
    is no list of numbers gives no row. If the customer or any candidate is unknown the whole
    request becomes one row with a null product.
    """
    parsed = requests.select(
        "request_id", "customer_unique_id",
        F.from_json("candidate_product_ids", "array<bigint>").alias("ids"),
    ).filter(F.col("ids").isNotNull())
    rows = parsed.select("request_id", "customer_unique_id", F.explode("ids").alias("product_key"))
    goods = products.select("product_key").distinct().withColumn("_good", F.lit(1))
    people = customers.select("customer_unique_id").distinct().withColumn("_person", F.lit(1))
    marked = rows.join(goods, "product_key", "left").join(people, "customer_unique_id", "left")
    answers = marked.groupBy("request_id", "customer_unique_id").agg(
        F.collect_list("product_key").alias("ids"),
        F.bool_and(F.col("_good").isNotNull() & F.col("_person").isNotNull()).alias("known"),
    )
    nothing = F.array(F.lit(None).cast("bigint"))
    return answers.select(
        "request_id", "customer_unique_id",
        F.explode(F.when(F.col("known"), F.col("ids")).otherwise(nothing)).alias("product_key"),
        "known",
    )


def score_candidates(requests: DataFrame, customers: DataFrame, products: DataFrame,
                     predict: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Candidates of each request, best first; an unanswerable request has null columns.

    ``predict`` adds ``prediction`` to (request_id, customer_unique_id, product_key).
    """
    rows = candidate_rows(requests, customers, products)
    scored = predict(rows.filter("known").drop("known"))
    place = Window.partitionBy("request_id").orderBy(F.desc("prediction"), "product_key")
    ranked = scored.select(
        "request_id", F.col("customer_unique_id").alias("customer_id"), "product_key",
        F.col("prediction").alias("predicted_score"), F.row_number().over(place).alias("rank"),
    )
    blank = rows.filter("not known").select(
        "request_id", F.col("customer_unique_id").alias("customer_id"), "product_key",
        F.lit(None).cast("double").alias("predicted_score"), F.lit(None).cast("int").alias("rank"),
    )
    return ranked.unionByName(blank)


def scd_version_diff(current: DataFrame, released: DataFrame) -> DataFrame:
    """Names whose current version is above the released one; unreleased names count as 0."""
    last = released.select("name", F.col("version").alias("last_version"))
    return current.join(last, "name", "left").select(
        "name", "version", F.coalesce("last_version", F.lit(0)).alias("last_version")
    ).filter(F.col("version") > F.col("last_version"))


def state_upsert(state: DataFrame, updates: DataFrame) -> DataFrame:
    """State by name with the updates written over it."""
    both = state.select("name", "version", F.lit(0).alias("at")).unionByName(
        updates.select("name", "version", F.lit(1).alias("at"))
    )
    return both.groupBy("name").agg(F.max(F.struct("at", "version"))["version"].alias("version"))
