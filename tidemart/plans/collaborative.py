"""Customer–product interaction tables for collaborative filtering.

Reviews belong to orders, so joining them to items repeats an item once per review. These
plans fold the reviews of an order into sums first and weight items by them; the repeated
rows are never produced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.scalars import as_double, mean, mean_of
from tidemart.operators.quantiles import medians
from tidemart.session import written
from tidemart.sources.star import Star

SIZE_COLUMNS = [
    "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
]
SCORE_COLUMNS = [
    "avg_review_score_by_user", "user_avg_overall_review_score", "product_avg_review_score",
]
#: What tells two rows of the interaction table apart; the other columns follow from these.
IDENTITY = [
    "customer_unique_id", "product_key", "customer_city", "customer_state",
    "product_category_name", *SIZE_COLUMNS,
]
RATING_RANGE = (1.0, 5.0)


def _persons(t: Star, *more: str) -> DataFrame:
    return t.customers.select("customer_key", "customer_unique_id", *more)


def order_reviews(t: Star) -> DataFrame:
    """Per order: review count, score total and number of scores."""
    return t.reviews.groupBy("order_key").agg(
        F.count(F.lit(1)).alias("n_reviews"),
        F.sum("score").alias("score_total"),
        F.count("score").alias("n_scores"),
    )


def _repeats() -> Column:
    """How often an item row appears after a left join with its order's reviews."""
    return F.coalesce(F.col("n_reviews"), F.lit(1))


def user_item_interactions(t: Star) -> DataFrame:
    placed = t.orders.select("order_key", "order_purchase_date_key").join(
        F.broadcast(
            t.dates.select(F.col("date_key").alias("order_purchase_date_key"), "full_date")
        ),
        "order_purchase_date_key",
    )
    return (
        t.items.join(placed, "order_key")
        .join(_persons(t), "customer_key")
        .groupBy("customer_unique_id", "product_key")
        .agg(
            F.count("order_id").alias("purchase_count"),
            as_double(F.sum("price")).alias("total_spent_on_product"),
            mean("price").alias("avg_price_for_product"),
            as_double(F.sum("freight_value")).alias("total_freight_on_product"),
            F.min("full_date").alias("first_purchase_date"),
            F.max("full_date").alias("last_purchase_date"),
        )
    )


def reviewed_pairs(t: Star) -> DataFrame:
    """Per (person, product): score total, number of scores, and item–review rows.

    The person is the one who wrote the review; the review counts for every item of its
    order.
    """
    by_author = t.reviews.groupBy("order_key", "customer_key").agg(
        F.count(F.lit(1)).alias("n_reviews"),
        F.sum("score").alias("score_total"),
        F.count("score").alias("n_scores"),
    )
    written_by = by_author.join(_persons(t), "customer_key").drop("customer_key")
    return (
        t.lines.select("order_key", "order_id", "product_key")
        .join(written_by, "order_key")
        .groupBy("customer_unique_id", "product_key")
        .agg(
            F.sum("score_total").alias("score_total"), F.sum("n_scores").alias("n_scores"),
            F.sum(F.when(F.col("order_id").isNotNull(), F.col("n_reviews")).otherwise(0)).alias(
                "n_rows"
            ),
        )
    )


def product_reviews(t: Star) -> DataFrame:
    return reviewed_pairs(t).select(
        "customer_unique_id", "product_key",
        mean_of(F.col("score_total"), F.col("n_scores")).alias("avg_review_score_by_user"),
    )


def _user_rows(t: Star) -> DataFrame:
    """Per item: person, place, order, category and the order's folded reviews."""
    known = t.products.select("product_key", "product_category_name")
    return (
        t.items.select("order_key", "customer_key", "product_key", F.col("price").alias("spent"))
        .join(known, "product_key")
        .join(t.orders.select("order_key", "order_id"), "order_key")
        .join(order_reviews(t), "order_key", "left")
        .join(_persons(t, "customer_city", "customer_state"), "customer_key")
    )


def cf_user_features(t: Star) -> DataFrame:
    """Per (person, city, state). Spend counts once per review of the order."""
    return _user_rows(t).groupBy("customer_unique_id", "customer_city", "customer_state").agg(
        F.countDistinct("order_id").alias("total_orders"),
        as_double(F.sum(F.col("spent") * _repeats())).alias("total_monetary"),
        mean_of(F.sum("score_total"), F.sum("n_scores")).alias("avg_overall_review_score"),
        F.countDistinct("product_category_name").alias("distinct_categories_purchased"),
    )


def cf_user_features_dedup(t: Star) -> DataFrame:
    """Per person: spend counts once, a review counts once, place from the newest version."""
    latest = t.customers.groupBy("customer_unique_id").agg(
        F.max_by("customer_city", "customer_key").alias("customer_city"),
        F.max_by("customer_state", "customer_key").alias("customer_state"),
    )
    rows = _user_rows(t)
    orders = rows.groupBy("customer_unique_id", "order_id").agg(
        F.sum("spent").alias("spent"),
        F.max("score_total").alias("score_total"), F.max("n_scores").alias("n_scores"),
    )
    totals = orders.groupBy("customer_unique_id").agg(
        F.count("order_id").alias("total_orders"),
        as_double(F.sum("spent")).alias("total_monetary"),
        mean_of(F.sum("score_total"), F.sum("n_scores")).alias("avg_overall_review_score"),
    )
    categories = rows.groupBy("customer_unique_id").agg(
        F.countDistinct("product_category_name").alias("distinct_categories_purchased")
    )
    return totals.join(categories, "customer_unique_id").join(latest, "customer_unique_id")


def cf_product_features(t: Star) -> DataFrame:
    """Per product; sales and price are weighted by the reviews of the order."""
    priced = F.when(F.col("price").isNotNull(), _repeats())
    sold = F.when(F.col("order_id").isNotNull(), _repeats()).otherwise(0)
    return (
        t.items.select("order_key", "order_id", "product_key", "customer_key", "price")
        .join(order_reviews(t), "order_key", "left")
        .join(_persons(t), "customer_key")
        .groupBy("product_key")
        .agg(
            mean_of(F.sum(F.col("price") * _repeats()), F.sum(priced)).alias("avg_product_price"),
            F.countDistinct("customer_unique_id").alias("num_unique_purchasers"),
            F.sum(sold).alias("total_sales_count"),
            mean_of(F.sum("score_total"), F.sum("n_scores")).alias("avg_product_review_score"),
        )
    )


def cf_interaction_table(t: Star, ordered: bool = True) -> DataFrame:
    """Interactions with review, user, product and size columns."""
    users = cf_user_features(t).select(
        "customer_unique_id",
        F.col("total_orders").alias("user_total_orders"),
        F.col("total_monetary").alias("user_total_monetary"),
        F.col("avg_overall_review_score").alias("user_avg_overall_review_score"),
        F.col("distinct_categories_purchased").alias("user_distinct_categories_purchased"),
        "customer_city", "customer_state",
    )
    sold = cf_product_features(t).select(
        "product_key", "avg_product_price",
        F.col("num_unique_purchasers").alias("product_num_unique_purchasers"),
        F.col("total_sales_count").alias("product_total_sales_count"),
        F.col("avg_product_review_score").alias("product_avg_review_score"),
    )
    facts = t.products.select("product_key", "product_category_name", *SIZE_COLUMNS)
    table = (
        user_item_interactions(t)
        .join(product_reviews(t), ["customer_unique_id", "product_key"], "left")
        .join(users, "customer_unique_id", "left")
        .join(facts.join(sold, "product_key", "left"), "product_key")
        .select(
            "customer_unique_id", "product_key", "product_category_name", "purchase_count",
            "total_spent_on_product", "avg_price_for_product", "total_freight_on_product",
            "first_purchase_date", "last_purchase_date", "avg_review_score_by_user",
            *users.columns[1:], *sold.columns[1:], *SIZE_COLUMNS,
        )
    )
    if not ordered:
        return table
    return table.orderBy("customer_unique_id", F.desc("purchase_count"), "product_key")


def cf_cleaned(table: DataFrame, identity: list[str] | None = None) -> DataFrame:
    """Median-filled scores, rows without product sizes dropped, duplicates removed.

    The table is written once: the medians and the cleaned rows both read the copy. Where the
    ``identity`` columns fix all others, copies are counted while the rows still lie where the
    last join left them. The medians count every copy; no row crosses the network again.
    """
    scores = [c for c in SCORE_COLUMNS if c in table.columns]
    if identity:
        rest = [c for c in table.columns if c not in identity]
        table = table.groupBy(*identity).agg(
            *[F.any_value(c).alias(c) for c in rest], F.count(F.lit(1)).alias("_copies")
        )
    table = written(table, "interactions")
    every = table
    if identity:
        every = table.select(*scores, F.explode(F.array_repeat(F.lit(1), F.col("_copies").cast("int"))))
        table = table.drop("_copies")
    found = medians(every, scores)
    filled = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in found.items() if v is not None}
    sized = table.withColumns(filled).na.drop(subset=SIZE_COLUMNS)
    return sized if identity else sized.dropDuplicates()


def cf_ratings(t: Star, observed_only: bool = False) -> DataFrame:
    """(userID, itemID, rating): one row per cleaned interaction, clipped to the scale.

    Unreviewed pairs carry the median score, as the fill comes before the drop;
    ``observed_only`` keeps the reviewed pairs alone.
    """
    low, high = RATING_RANGE
    score = F.greatest(F.lit(low), F.least(F.lit(high), F.col("avg_review_score_by_user")))
    named = [
        F.col("customer_unique_id").alias("userID"), F.col("product_key").alias("itemID"),
        score.alias("rating"),
    ]
    if observed_only:
        sized = t.products.na.drop(subset=SIZE_COLUMNS).select("product_key")
        scored = product_reviews(t).na.drop(subset=["avg_review_score_by_user"])
        return scored.join(sized, "product_key", "left_semi").select(*named)
    # Only what a rating depends on is asked of the table, so Spark prunes the rest of it.
    table = cf_interaction_table(t, ordered=False).select(*IDENTITY, "avg_review_score_by_user")
    return cf_cleaned(table, IDENTITY).select(*named)


def duplicate_count(table: DataFrame) -> DataFrame:
    """One row: how many rows repeat an earlier row in every column."""
    copies = table.groupBy(*table.columns).agg(F.count(F.lit(1)).alias("copies"))
    return copies.agg(F.sum(F.col("copies") - 1).alias("duplicate_rows"))


