"""Sales, logistics, marketing and customer marts.

Where a dimension key repeats often, facts are summed per key before they meet the
dimension, so a key that holds a large share of the facts is one row by the time of the join;
other fact joins are left to the adaptive skew split. Only the calendar, the clock
and the payment types carry a broadcast hint: their size is fixed. Other dimensions are
left to the optimiser's size check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.functions.scalars import as_double, at_time, mean_of, ratio, whole_hours
from tidemart.sources.star import Star

# Weekday labels, Monday = 1.
DAY_NAMES = {
    1: "Monday", 2: "Tuesday", 3: "Wednesday", 4: "Thursday", 5: "Friday", 6: "Saturday",
    7: "Sunday",
}


def _current_states(t: Star) -> DataFrame:
    return t.customers.filter("is_current").select("customer_key", "customer_state")


def _calendar(t: Star, role: str, *cols: str) -> DataFrame:
    """The calendar keyed for one role of an order's dates."""
    return F.broadcast(t.dates.select(F.col("date_key").alias(role), *cols))


def revenue_by_month(t: Star) -> DataFrame:
    per_order = t.lines.groupBy("order_key").agg(F.sum("price").alias("spent"))
    return (
        per_order.join(t.orders.select("order_key", "order_purchase_date_key"), "order_key")
        .join(_calendar(t, "order_purchase_date_key", "year", "month"), "order_purchase_date_key")
        .groupBy("year", "month")
        .agg(as_double(F.sum("spent")).alias("revenue"))
        .orderBy("year", "month")
    )


def distributed_state_revenue(t: Star) -> DataFrame:
    per_order = t.items.groupBy("customer_key", "order_key").agg(F.sum("price").alias("spent"))
    return (
        per_order.join(_current_states(t), "customer_key")
        .groupBy("customer_state")
        .agg(
            as_double(F.sum("spent")).alias("total_revenue"),
            F.countDistinct("order_key").alias("total_orders"),
            F.countDistinct("customer_key").alias("total_customers"),
        )
        .orderBy(F.desc("total_revenue"), "customer_state")
    )


def payment_type_ratio(t: Star) -> DataFrame:
    per_key = t.payments.groupBy("payment_type_key").agg(
        F.count("order_key").alias("n"), F.sum("payment_value").alias("paid")
    )
    return (
        per_key.join(F.broadcast(t.payment_types), "payment_type_key")
        .groupBy("payment_type")
        .agg(
            F.sum("n").alias("number_of_transactions"),
            as_double(F.sum("paid")).alias("total_payment_value"),
        )
        .orderBy(F.desc("number_of_transactions"), "payment_type")
    )


def seller_year_revenue(t: Star) -> DataFrame:
    """Revenue per seller (id, city, state) and purchase year."""
    placed = t.orders.select("order_key", "order_purchase_date_key").join(
        _calendar(t, "order_purchase_date_key", "year"), "order_purchase_date_key"
    )
    return (
        t.lines.select("order_key", "seller_key", "price")
        .join(placed, "order_key")
        .groupBy("seller_key", "year")
        .agg(F.sum("price").alias("spent"))
        .join(t.sellers, "seller_key")
        .groupBy("seller_id", "seller_city", "seller_state", "year")
        .agg(F.sum("spent").alias("spent"))
    )


def top10_sellers_each_year(t: Star, k: int = 10) -> DataFrame:
    """Sellers ranked up to ``k`` in a year; tied sellers share a rank and all stay."""
    by_revenue = Window.partitionBy("year").orderBy(F.desc("spent"))
    return (
        seller_year_revenue(t)
        .withColumn("rank_num", F.rank().over(by_revenue))
        .filter(F.col("rank_num") <= k)
        .select(
            "seller_id", "seller_city", "seller_state", "year",
            as_double("spent").alias("total_revenue"), "rank_num",
        )
        .orderBy("year", "rank_num", "seller_id")
    )


def _spend_by_state(t: Star) -> DataFrame:
    """Per state: exact price and freight totals, item and customer counts."""
    per_customer = t.items.groupBy("customer_key").agg(
        F.sum("price").alias("price"),
        F.sum("freight_value").alias("freight"),
        F.count("price").alias("n_priced"),
    )
    return (
        per_customer.join(_current_states(t), "customer_key")
        .groupBy("customer_state")
        .agg(
            F.sum("price").alias("price"),
            F.sum("freight").alias("freight"),
            F.sum("n_priced").alias("n_priced"),
            F.countDistinct("customer_key").alias("n_customers"),
        )
    )


def logistics_freight_cost_analysis(t: Star) -> DataFrame:
    return (
        _spend_by_state(t)
        .select(
            "customer_state",
            as_double("price").alias("total_product_value"),
            as_double("freight").alias("total_freight_value"),
            (ratio(F.col("freight"), F.col("price")) * 100).alias(
                "freight_to_price_ratio_percent"
            ),
        )
        .orderBy(F.desc("freight_to_price_ratio_percent"), "customer_state")
    )


def mkt_customer_segmentation_by_geo(t: Star) -> DataFrame:
    return (
        _spend_by_state(t)
        .select(
            "customer_state",
            F.col("n_customers").alias("number_of_customers"),
            as_double("price").alias("total_revenue"),
            mean_of(F.col("price"), F.col("n_priced")).alias("average_spend_per_item"),
        )
        .orderBy(F.desc("total_revenue"), "customer_state")
    )


def _clocked(t: Star, orders: DataFrame, role: str) -> DataFrame:
    """Orders with the timestamp of one (date, time) role; orders without it drop out."""
    day, second = f"order_{role}_date_key", f"order_{role}_time_key"
    clock = t.times.select(F.col("time_key").alias(second), F.col("full_time").alias("clock"))
    return (
        orders.join(_calendar(t, day, F.col("full_date").alias("day")), day)
        .join(F.broadcast(clock), second)
        .withColumn(role, at_time(F.col("day"), F.col("clock")))
        .drop("day", "clock")
    )


def logistics_order_processing_time(t: Star) -> DataFrame:
    """Mean whole hours from approval to carrier, per seller state, weighted per item."""
    stages = t.orders.select(
        "order_key", "order_approved_at_date_key", "order_approved_at_time_key",
        "order_delivered_carrier_date_key", "order_delivered_carrier_time_key",
    ).na.drop(subset=["order_approved_at_date_key", "order_delivered_carrier_date_key"])
    timed = _clocked(t, _clocked(t, stages, "approved_at"), "delivered_carrier").select(
        "order_key",
        whole_hours(F.col("approved_at"), F.col("delivered_carrier")).alias("hours"),
    )
    return (
        t.lines.select("order_key", "seller_key")
        .join(timed, "order_key")
        .groupBy("seller_key")
        .agg(F.sum("hours").alias("hours"), F.count("hours").alias("n_timed"))
        .join(t.sellers.select("seller_key", "seller_state"), "seller_key")
        .groupBy("seller_state")
        .agg(mean_of(F.sum("hours"), F.sum("n_timed")).alias("avg_processing_hours"))
        .orderBy("avg_processing_hours", "seller_state")
    )


def mkt_peak_purchase_times_analysis(
    t: Star, labels: dict[int, str] | None = None, other: str = "Unknown"
) -> DataFrame:
    names = labels or DAY_NAMES
    label = F.lit(other)
    for day, name in names.items():
        label = F.when(F.col("day_of_week") == day, name).otherwise(label)
    clock = t.times.select(F.col("time_key").alias("order_purchase_time_key"), "time_of_day_bucket")
    return (
        t.orders.select("order_key", "order_purchase_date_key", "order_purchase_time_key")
        .join(_calendar(t, "order_purchase_date_key", "day_of_week"), "order_purchase_date_key")
        .join(F.broadcast(clock), "order_purchase_time_key")
        .groupBy(label.alias("day_of_week_name"), "time_of_day_bucket")
        .agg(F.countDistinct("order_key").alias("total_orders"))
        .orderBy(F.desc("total_orders"), "day_of_week_name", "time_of_day_bucket")
    )


def customer_mart(churn: DataFrame) -> DataFrame:
    """Segment, lifetime value and churn flag per customer, from the churn features."""
    big, often = F.col("monetary_value") >= 1_000_000, F.col("frequency_orders") >= 4
    segment = (
        F.when(big & often, "loyal_high_value")
        .when(big, "high_value")
        .when(often, "frequent")
        .otherwise("occasional")
    )
    return churn.select(
        "customer_id", segment.alias("segment"),
        F.col("monetary_value").alias("lifetime_value"), "frequency_orders", "recency_days",
        "churn_label",
    )


def product_performance(content: DataFrame) -> DataFrame:
    """Order metrics per product, from the product content features."""
    return content.select(
        "product_key", "product_category_name", "total_sales_count", "num_unique_purchasers",
        "avg_price", "total_reviews_count", "avg_review_score", "num_sellers",
    )
