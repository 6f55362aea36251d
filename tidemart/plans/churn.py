"""Churn features: one row per current customer person, labelled by recency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.functions.scalars import as_double, chosen_by, mean, mean_of, sixth
from tidemart.sources.star import Star

THRESHOLD_DAYS = 180

# Aggregates that are averaged again when several customer keys share a person.
_AVERAGED = [
    "avg_order_price", "avg_freight", "avg_delivery_delay", "late_delivery_rate",
    "avg_delivery_overdue_days", "avg_internal_processing_days", "avg_promised_window_days",
    "holiday_purchase_rate", "avg_overdue_days_on_holidays", "avg_overdue_days_on_non_holidays",
]


def analysis_snapshot(t: Star) -> DataFrame:
    """One row: the day after the last purchase over all orders."""
    placed = t.orders.select(F.col("order_purchase_date_key").alias("date_key")).distinct()
    return placed.join(F.broadcast(t.dates.select("date_key", "full_date")), "date_key").agg(
        F.date_add(F.max("full_date"), 1).alias("snapshot_date")
    )


def delivered_orders(t: Star) -> DataFrame:
    """Delivered orders with their dates resolved and the day counts derived from them."""
    roles = {
        "purchase": ("order_purchase_date_key", "inner"),
        "delivered": ("order_delivered_customer_date_key", "left"),
        "estimated": ("order_estimated_delivery_date_key", "left"),
        "approved": ("order_approved_at_date_key", "left"),
        "carrier": ("order_delivered_carrier_date_key", "left"),
    }
    orders = t.orders.filter("order_status = 'delivered'").select(
        "order_key", "order_id", *[key for key, _ in roles.values()]
    )
    for role, (key, how) in roles.items():
        day = t.dates.select(
            F.col("date_key").alias(key), F.col("full_date").alias(role),
            *([F.col("is_holiday")] if role == "purchase" else []),
        )
        orders = orders.join(F.broadcast(day), key, how)
    return orders.select(
        "order_key", "order_id",
        F.col("purchase").alias("purchase_date"), F.col("delivered").alias("delivered_date"),
        F.datediff("delivered", "estimated").alias("delivery_overdue_days"),
        F.when(F.col("delivered") > F.col("estimated"), 1).otherwise(0).alias("is_delivered_late"),
        F.datediff("carrier", "approved").alias("internal_processing_days"),
        F.datediff("estimated", "purchase").alias("promised_window_days"),
        F.col("is_holiday").alias("is_purchase_holiday"),
    )


def order_dates(t: Star) -> DataFrame:
    """Delivered orders repeated once per order item, with the item's customer."""
    return t.items.select("order_key", "customer_key").join(delivered_orders(t), "order_key")


def baskets(t: Star) -> DataFrame:
    """Per (order, customer): item count and exact price and freight totals."""
    return t.items.groupBy("order_key", "customer_key").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.sum("price").alias("order_price"),
        F.sum("freight_value").alias("order_freight"),
    )


def order_values(t: Star) -> DataFrame:
    return baskets(t).select(
        "order_key", "customer_key",
        as_double("order_price").alias("order_price"),
        as_double("order_freight").alias("order_freight"),
    )


def _weighted(col: str | Column, keep: Column | None = None) -> Column:
    """Mean of an integer column with each row counted ``weight`` times, nulls left out."""
    value = F.col(col) if isinstance(col, str) else col
    value = value if keep is None else F.when(keep, value)
    seen = F.when(value.isNotNull(), F.col("weight"))
    return mean_of(F.sum(value * F.col("weight")), F.sum(seen))


def _key_aggregates(rows: DataFrame) -> DataFrame:
    """Aggregate order rows per customer key.

    ``weight`` says how many joined rows an order row stands for; ``spent`` and ``shipped``
    are the totals those rows carry together.
    """
    holiday = F.col("is_purchase_holiday")
    return rows.groupBy("customer_key").agg(
        F.max("purchase_date").alias("last_purchase_date"),
        F.min("purchase_date").alias("first_purchase_date"),
        F.count("order_id").alias("frequency_orders"),
        F.sum("spent").alias("monetary_value"),
        mean_of(F.sum("spent"), F.sum("weight")).alias("avg_order_price"),
        F.sum("shipped").alias("sum_freight"),
        mean_of(F.sum("shipped"), F.sum("weight")).alias("avg_freight"),
        _weighted(F.datediff("delivered_date", "purchase_date")).alias("avg_delivery_delay"),
        _weighted("is_delivered_late").alias("late_delivery_rate"),
        _weighted("delivery_overdue_days").alias("avg_delivery_overdue_days"),
        _weighted("internal_processing_days").alias("avg_internal_processing_days"),
        _weighted("promised_window_days").alias("avg_promised_window_days"),
        _weighted(F.when(holiday, 1).otherwise(0)).alias("holiday_purchase_rate"),
        _weighted("delivery_overdue_days", holiday).alias("avg_overdue_days_on_holidays"),
        _weighted("delivery_overdue_days", ~holiday).alias("avg_overdue_days_on_non_holidays"),
    )


def customer_key_agg(t: Star) -> DataFrame:
    """Key-level aggregates in which an order of n items counts n times.

    Every item of an order meets the totals of each customer of that order. The product is
    never built: an order row is weighted by how many such rows it stands for.
    """
    # One row per distinct customer of an order by now, so the window groups are short; the
    # join has already placed the rows by order.
    same_order = Window.partitionBy("order_key")
    rows = (
        baskets(t)
        .join(delivered_orders(t), "order_key")
        .withColumn("weight", F.col("n_items") * F.count(F.lit(1)).over(same_order))
        .withColumn("spent", F.sum("order_price").over(same_order) * F.col("n_items"))
        .withColumn("shipped", F.sum("order_freight").over(same_order) * F.col("n_items"))
    )
    return _key_aggregates(rows)


def customer_key_agg_dedup(t: Star) -> DataFrame:
    """The same aggregates at order grain: each (order, customer) counts once."""
    rows = (
        baskets(t)
        .join(delivered_orders(t), "order_key")
        .withColumn("weight", F.lit(1))
        .withColumnsRenamed({"order_price": "spent", "order_freight": "shipped"})
    )
    return _key_aggregates(rows)


def review_by_key(t: Star) -> DataFrame:
    return t.reviews.groupBy("customer_key").agg(mean("score").alias("avg_review_score"))


def payment_by_key(t: Star) -> DataFrame:
    per_type = t.payments.groupBy("customer_key", "payment_type_key").agg(
        F.sum("payment_installments").alias("installments"),
        F.count("payment_installments").alias("n"),
    )
    return (
        per_type.join(F.broadcast(t.payment_types), "payment_type_key")
        .groupBy("customer_key")
        .agg(
            F.countDistinct("payment_type").alias("distinct_payment_methods"),
            mean_of(F.sum("installments"), F.sum("n")).alias("avg_installments"),
        )
    )


def _persons(t: Star) -> DataFrame:
    return t.customers.select("customer_key", "customer_unique_id")


def purchase_cells(t: Star) -> DataFrame:
    """Item counts per (person, product, seller).

    Several tables start here. The product filter, which their joins imply anyway, keeps the
    plans equal, so Spark computes the cells once.
    """
    return (
        t.items.select("customer_key", "product_key", "seller_key")
        .filter(F.col("product_key").isNotNull())
        .join(_persons(t), "customer_key")
        .groupBy("customer_unique_id", "product_key", "seller_key")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _seller_spread(t: Star) -> DataFrame:
    """Per person: distinct sellers and the concentration over (category, product, seller).

    The sum of squared shares is the sum of squared counts over the squared total, so no
    window over a person's cells is needed. Distinct values are counted by grouping once more
    instead of several distinct counts in one grouping, which would copy every row.
    """
    n = F.col("n")
    known = purchase_cells(t).join(t.products.select("product_key"), "product_key", "left_semi")
    per_seller = known.groupBy("customer_unique_id", "seller_key").agg(
        F.sum(n).alias("n"), F.sum(n * n).alias("squares")
    )
    return per_seller.groupBy("customer_unique_id").agg(
        F.count("seller_key").alias("distinct_sellers"),
        sixth(mean_of(F.sum("squares"), F.pow(F.sum("n").cast("double"), F.lit(2)))).alias(
            "category_concentration"
        ),
    )


def _product_spread(t: Star) -> DataFrame:
    """Per person: distinct categories and products, and the most bought product."""
    listed = t.products.select("product_key", "product_category_name", F.lit(1).alias("listed"))
    per_product = (
        purchase_cells(t)
        .groupBy("customer_unique_id", "product_key")
        .agg(F.sum("n").alias("n"))
        .join(listed, "product_key", "left")
    )
    best = F.struct((-F.col("n")).alias("rank"), F.col("product_key").alias("value"))
    per_category = per_product.groupBy("customer_unique_id", "product_category_name").agg(
        F.sum("listed").alias("n_products"), F.min(best).alias("best")
    )
    return per_category.groupBy("customer_unique_id").agg(
        F.count("product_category_name").alias("distinct_categories"),
        F.sum("n_products").alias("distinct_products"),
        F.min("best")["value"].alias("most_purchased_product"),
    )


def product_diversity_unique(t: Star) -> DataFrame:
    """Distinct counts and concentration over (category, product, seller) cells."""
    products = _product_spread(t).drop("most_purchased_product")
    return products.join(_seller_spread(t), "customer_unique_id")


def category_concentration_dedup(t: Star) -> DataFrame:
    """Concentration over categories proper, one share per category."""
    per_category = (
        purchase_cells(t)
        .join(t.products.select("product_key", "product_category_name"), "product_key")
        .groupBy("customer_unique_id", "product_category_name")
        .agg(F.sum("n").alias("n"))
    )
    return per_category.groupBy("customer_unique_id").agg(
        sixth(
            mean_of(F.sum(F.col("n") * F.col("n")), F.pow(F.sum("n").cast("double"), F.lit(2)))
        ).alias("category_concentration")
    )


def top_product_unique(t: Star) -> DataFrame:
    return _product_spread(t).select("customer_unique_id", "most_purchased_product")


def top_payment_unique(t: Star) -> DataFrame:
    per_key = t.payments.groupBy("customer_key", "payment_type_key").agg(
        F.count(F.lit(1)).alias("n")
    )
    per_type = (
        per_key.join(F.broadcast(t.payment_types), "payment_type_key")
        .join(_persons(t), "customer_key")
        .groupBy("customer_unique_id", "payment_type")
        .agg(F.sum("n").alias("n"))
    )
    return per_type.groupBy("customer_unique_id").agg(
        chosen_by(F.col("n"), F.col("payment_type")).alias("most_used_payment_type")
    )


def review_detail_unique(t: Star) -> DataFrame:
    """Reviews with text, and mean days from creation to answer, per person."""
    has_text = t.review_content.select(
        "review_content_key",
        F.when(
            (F.length("review_comment_title") > 0) | (F.length("review_comment_message") > 0), 1
        ).otherwise(0).alias("with_text"),
    )
    dates = t.dates.select("date_key", "full_date")
    asked = dates.withColumnsRenamed({"date_key": "review_creation_date_key", "full_date": "asked"})
    told = dates.withColumnsRenamed({"date_key": "review_answer_date_key", "full_date": "told"})
    per_key = (
        t.reviews.join(has_text, "review_content_key")
        .join(F.broadcast(asked), "review_creation_date_key")
        .join(F.broadcast(told), "review_answer_date_key")
        .groupBy("customer_key")
        .agg(
            F.sum("with_text").alias("with_text"),
            F.sum(F.datediff("told", "asked")).alias("days"),
            F.count(F.datediff("told", "asked")).alias("n"),
        )
    )
    return (
        per_key.join(_persons(t), "customer_key")
        .groupBy("customer_unique_id")
        .agg(
            F.sum("with_text").alias("review_with_comment"),
            mean_of(F.sum("days"), F.sum("n")).alias("avg_review_response_time"),
        )
    )


def current_customers(t: Star) -> DataFrame:
    return t.customers.filter("is_current").select("customer_key", "customer_unique_id")


_FROM_KEY = ["avg_review_score", "distinct_payment_methods", "avg_installments"]
_FROM_PERSON = [
    "distinct_categories", "distinct_products", "distinct_sellers", "category_concentration",
    "most_purchased_product", "most_used_payment_type", "review_with_comment",
    "avg_review_response_time",
]


def _assemble(t: Star, keys: DataFrame, extra_keys: list[str], aggregated: list[Column],
              threshold_days: int) -> DataFrame:
    person = [
        _product_spread(t), _seller_spread(t), top_payment_unique(t), review_detail_unique(t),
    ]
    rows = (
        keys.join(current_customers(t), "customer_key")
        .join(review_by_key(t), "customer_key", "left")
        .join(payment_by_key(t), "customer_key", "left")
    )
    for part in person:
        rows = rows.join(part, "customer_unique_id", "left")
    # Without a listed product there is no diversity row: its counts are null, not 0.
    has_listed = F.col("distinct_products").isNotNull()
    rows = rows.withColumn(
        "distinct_categories", F.when(has_listed, F.col("distinct_categories"))
    )
    grouped = rows.groupBy("customer_unique_id", *extra_keys, *_FROM_PERSON).agg(
        F.max("last_purchase_date").alias("last"),
        F.min("first_purchase_date").alias("first"),
        F.sum("frequency_orders").alias("frequency_orders"),
        as_double(F.sum("monetary_value")).alias("monetary_value"),
        as_double(F.sum("sum_freight")).alias("sum_freight"),
        *[sixth(F.avg(c)).alias(c) for c in _AVERAGED],
        *aggregated,
    )
    recency = F.datediff(analysis_snapshot(t).scalar(), F.col("last"))
    return grouped.select(
        F.col("customer_unique_id").alias("customer_id"),
        recency.alias("recency_days"),
        F.datediff("last", "first").alias("customer_tenure"),
        "frequency_orders", "monetary_value", "sum_freight", *_AVERAGED,
        *[sixth(F.col(c)).alias(c) if c != "distinct_payment_methods" else F.col(c)
          for c in _FROM_KEY],
        *_FROM_PERSON[:-1],
        sixth(F.col("avg_review_response_time")).alias("avg_review_response_time"),
        F.when(recency > threshold_days, 1).otherwise(0).alias("churn_label"),
    )


def churn_features(t: Star, threshold_days: int = THRESHOLD_DAYS) -> DataFrame:
    """The churn table. Review and payment values stay at key level and are grouped on, so
    a person with two current keys may give two rows."""
    return _assemble(t, customer_key_agg(t), _FROM_KEY, [], threshold_days)


def churn_features_dedup(t: Star, threshold_days: int = THRESHOLD_DAYS) -> DataFrame:
    """The churn table at its intended grain: orders count once, one row per person."""
    folded = [
        F.avg("avg_review_score").alias("avg_review_score"),
        F.max("distinct_payment_methods").alias("distinct_payment_methods"),
        F.avg("avg_installments").alias("avg_installments"),
    ]
    return _assemble(t, customer_key_agg_dedup(t), [], folded, threshold_days)
