"""Product and customer content features and satisfaction labels."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.scalars import as_double, chosen_by, mean, mean_of, ratio
from tidemart.operators.relational import with_firsts
from tidemart.plans.churn import analysis_snapshot
from tidemart.plans.collaborative import reviewed_pairs
from tidemart.sources.star import Star

SEPARATOR = " | "


def _persons(t: Star) -> DataFrame:
    return t.customers.select("customer_key", "customer_unique_id")


def _or(name: str, default: int = 0) -> Column:
    return F.coalesce(F.col(name), F.lit(default)).alias(name)


def product_sales(t: Star) -> DataFrame:
    placed = t.orders.select("order_key", "order_purchase_date_key")
    price, freight = F.col("price"), F.col("freight_value")
    named = F.when(F.col("order_id").isNotNull(), 1).alias("named")
    sold = t.sold(["product_key", "seller_key", named, "price", "freight_value"], placed, _persons(t)).select(
        "product_key", "customer_unique_id", "seller_key", "named", "price", "freight_value",
        "order_purchase_date_key")
    return (
        with_firsts(sold, "product_key", "customer_unique_id", "seller_key")
        .groupBy("product_key")
        .agg(
            F.count("named").alias("total_sales_count"),
            F.sum("first_customer_unique_id").alias("num_unique_purchasers"),
            F.sum("first_seller_key").alias("num_sellers"),
            mean(price).alias("avg_price"),
            F.stddev_samp(price.cast("double")).alias("stddev_price"),
            as_double(F.min(price)).alias("min_price"),
            as_double(F.max(price)).alias("max_price"),
            mean(freight).alias("avg_freight_value"),
            F.avg(ratio(freight, price)).alias("freight_to_price_ratio"),
            F.min("order_purchase_date_key").alias("first_sale_date_key"),
            F.max("order_purchase_date_key").alias("last_sale_date_key"),
        )
    )


def product_review_stats(t: Star) -> DataFrame:
    """Score statistics over item–review rows.

    Scores take few values, so rows are first counted per (product, score).
    """
    scores = t.reviews.groupBy("order_key", "score").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("review_id").alias("n_reviews")
    )
    per_score = (
        t.lines.select("order_key", "product_key")
        .join(scores, "order_key")
        .groupBy("product_key", "score")
        .agg(F.sum("n_rows").alias("n"), F.sum("n_reviews").alias("n_reviews"))
    )
    score, n = F.col("score"), F.col("n")
    scored = F.sum(F.when(score.isNotNull(), n))
    total, squares = F.sum(score * n), F.sum(score * score * n)
    spread = (scored * squares - total * total).cast("double")
    return per_score.groupBy("product_key").agg(
        mean_of(total, scored).alias("avg_review_score"),
        F.sqrt(ratio(spread, scored * (scored - 1))).alias("stddev_review_score"),
        F.sum("n_reviews").alias("total_reviews_count"),
        mean_of(F.sum(F.when(score >= 4, n).otherwise(0)), F.sum(n)).alias(
            "positive_review_ratio"
        ),
        mean_of(F.sum(F.when(score <= 2, n).otherwise(0)), F.sum(n)).alias(
            "negative_review_ratio"
        ),
    )


def product_payment_stats(t: Star) -> DataFrame:
    paid = t.payments.groupBy("order_key").agg(
        F.sum("payment_installments").alias("installments"),
        F.count("payment_installments").alias("n"),
    )
    return (
        t.lines.select("order_key", "product_key")
        .join(paid, "order_key")
        .groupBy("product_key")
        .agg(mean_of(F.sum("installments"), F.sum("n")).alias("avg_payment_installments"))
    )


def product_volume(products: DataFrame) -> DataFrame:
    return products.withColumn(
        "product_volume_cm3",
        F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm"),
    )


def product_content_features(t: Star) -> DataFrame:
    """One row per product with a category."""
    products = product_volume(t.products.filter("product_category_name is not null"))
    return (
        products.join(product_sales(t), "product_key", "left")
        .join(product_review_stats(t), "product_key", "left")
        .join(product_payment_stats(t), "product_key", "left")
        .select(
            *products.columns,
            _or("total_sales_count"), _or("num_unique_purchasers"),
            ratio(F.col("total_sales_count"), F.col("num_unique_purchasers")).alias(
                "repurchase_ratio"
            ),
            _or("avg_price"), _or("stddev_price"), _or("avg_freight_value"),
            _or("freight_to_price_ratio"), _or("total_reviews_count"), _or("avg_review_score"),
            _or("stddev_review_score"), _or("positive_review_ratio"),
            _or("negative_review_ratio"), _or("num_sellers"), _or("avg_payment_installments"),
            "first_sale_date_key", "last_sale_date_key",
        )
    )


def latest_customers(t: Star) -> DataFrame:
    """Each person with the place of the version that has the highest key."""
    return t.customers.groupBy("customer_unique_id").agg(
        F.max_by("customer_city", "customer_key").alias("customer_city"),
        F.max_by("customer_state", "customer_key").alias("customer_state"),
    )


def customer_transactions(t: Star) -> DataFrame:
    placed = t.orders.select("order_key", "order_id", "order_purchase_date_key").join(
        F.broadcast(
            t.dates.select(F.col("date_key").alias("order_purchase_date_key"), "full_date")
        ),
        "order_purchase_date_key",
    )
    bought = t.sold(["seller_key", "product_key", "price"], placed, _persons(t)).select(
        "customer_unique_id", "order_id", "seller_key", "product_key", "price", "full_date")
    firsts = with_firsts(bought, "customer_unique_id", "order_id", "seller_key")
    totals = firsts.groupBy("customer_unique_id").agg(
        F.sum("first_order_id").alias("frequency"),
        F.sum("price").alias("spent"),
        F.max("full_date").alias("last_purchase_date"),
        F.min("full_date").alias("first_purchase_date"),
        F.count("product_key").alias("total_items_purchased"),
        F.sum("first_seller_key").alias("distinct_sellers_count"),
    )
    return totals.select(
        "customer_unique_id", "frequency", as_double("spent").alias("monetary"),
        "last_purchase_date", "first_purchase_date", "total_items_purchased",
        ratio(F.col("spent"), F.col("frequency")).alias("avg_value_per_order"),
        ratio(F.col("total_items_purchased"), F.col("frequency")).alias("avg_items_per_order"),
        "distinct_sellers_count",
    )


def _category_days(t: Star) -> DataFrame:
    """Items per (person, purchase day, category)."""
    return (
        t.items.select("order_key", "customer_key", "product_key")
        .join(t.orders.select("order_key", "order_purchase_date_key"), "order_key")
        .join(t.products.select("product_key", "product_category_name"), "product_key")
        .join(_persons(t), "customer_key")
        .groupBy("customer_unique_id", "order_purchase_date_key", "product_category_name")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def customer_preferences(t: Star) -> DataFrame:
    """Distinct categories and the category of every item in purchase order.

    What reaches a person's group is one entry per (day, category), never one per item;
    the repeats are put back inside the row.
    """
    cells = _category_days(t)
    entry = F.struct("order_purchase_date_key", "product_category_name", "n")
    runs = F.transform(
        F.sort_array(F.collect_list(entry)),
        lambda e: F.array_repeat(e["product_category_name"], e["n"].cast("int")),
    )
    return cells.groupBy("customer_unique_id").agg(
        F.countDistinct("product_category_name").alias("distinct_categories_purchased"),
        F.array_join(F.flatten(runs), SEPARATOR).alias("purchase_category_history"),
    )


def favorite_category(t: Star) -> DataFrame:
    per_category = (
        _category_days(t)
        .groupBy("customer_unique_id", "product_category_name")
        .agg(F.sum("n").alias("n"))
    )
    return per_category.groupBy("customer_unique_id").agg(
        chosen_by(F.col("n"), F.col("product_category_name")).alias("favorite_category")
    )


def customer_reviews(t: Star) -> DataFrame:
    per_key = t.reviews.groupBy("customer_key").agg(
        F.sum("score").alias("score_total"), F.count("score").alias("n_scores"),
        F.count("review_id").alias("n_reviews"),
    )
    return (
        per_key.join(_persons(t), "customer_key")
        .groupBy("customer_unique_id")
        .agg(
            mean_of(F.sum("score_total"), F.sum("n_scores")).alias("avg_review_score"),
            F.sum("n_reviews").alias("total_reviews_given"),
        )
    )


def customer_payments(t: Star) -> DataFrame:
    per_type = (
        t.payments.join(t.orders.select("order_key"), "order_key", "left_semi")
        .groupBy("customer_key", "payment_type_key")
        .agg(
            F.sum("payment_installments").alias("installments"),
            F.count("payment_installments").alias("n"),
            F.max("payment_installments").alias("most"),
        )
    )
    return (
        per_type.join(_persons(t), "customer_key")
        .groupBy("customer_unique_id")
        .agg(
            mean_of(F.sum("installments"), F.sum("n")).alias("avg_payment_installments"),
            F.max("most").alias("max_payment_installments"),
            F.countDistinct("payment_type_key").alias("distinct_payment_types_used"),
        )
    )


def customer_content_features(t: Star, as_of: datetime.date | None = None) -> DataFrame:
    """One row per person; days since purchase count to ``as_of`` (default: the snapshot)."""
    today = F.lit(as_of) if as_of else analysis_snapshot(t).scalar()
    rows = latest_customers(t)
    for part in (customer_transactions(t), customer_preferences(t), favorite_category(t),
                 customer_reviews(t), customer_payments(t)):
        rows = rows.join(part, "customer_unique_id", "left")
    lifetime = F.datediff("last_purchase_date", "first_purchase_date")
    return rows.select(
        "customer_unique_id", "customer_city", "customer_state",
        _or("frequency").alias("total_orders"), _or("monetary").alias("total_spent"),
        _or("avg_value_per_order"),
        F.datediff(today, F.col("last_purchase_date")).alias("days_since_last_purchase"),
        lifetime.alias("customer_lifetime_days"),
        ratio(lifetime, F.col("frequency") - 1).alias("avg_days_between_orders"),
        _or("distinct_categories_purchased"), "favorite_category", "purchase_category_history",
        _or("avg_review_score").alias("avg_review_score_given"), _or("total_reviews_given"),
        ratio(F.coalesce("total_reviews_given", F.lit(0)), F.col("frequency")).alias(
            "review_propensity"
        ),
        _or("avg_payment_installments", 1), _or("max_payment_installments", 1),
        _or("distinct_payment_types_used"),
    )


def satisfaction_labels(t: Star) -> DataFrame:
    """Label (mean score) and weight (item–review rows) per (person, product) with a score."""
    pairs = reviewed_pairs(t).select(
        "customer_unique_id", "product_key",
        mean_of(F.col("score_total"), F.col("n_scores")).alias("avg_review_score_by_user"),
        F.col("n_rows").alias("purchase_count"),
    )
    return pairs.filter(F.col("avg_review_score_by_user").isNotNull())
