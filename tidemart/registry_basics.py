"""Small queries: one per row, join, aggregate, window, sort and set operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.functions.scalars import (
    as_double, at_time, chosen_by, hash_unit, mean, mean_of, ratio, sixth, whole_hours,
)
from tidemart.operators import quality, quantiles, relational
from tidemart.oracle import features as sql_features
from tidemart.oracle import marts as sql_marts
from tidemart.oracle.star import star_sql
from tidemart.plans import churn, collaborative, content, marts, text
from tidemart.registry import over_star, rounded
from tidemart.session import shared_dir, written
from tidemart.sources import requests
from tidemart.sources.tables import publish_mart, run_sql


def _churn(body: str) -> str:
    return star_sql(body, **sql_marts.churn_ctes())


# --- sources ---------------------------------------------------------------------------


def lookup_region(t) -> DataFrame:
    """Customers per region through two lookups."""
    region = relational.broadcast_if_small(t.raw("region"))
    states = t.raw("nation").join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    ).select(F.col("n_name").alias("customer_state"), F.col("r_name").alias("region"))
    return relational.lookup(t.customers, states, "customer_state").groupBy("region").agg(
        F.count(F.lit(1)).alias("n_customers")
    )


over_star("lookup", lookup_region, star_sql(
    "select r_name as region, count(*) as n_customers from s_customers left join nation "
    "on n_name = customer_state left join region on r_regionkey = n_regionkey group by all"
))


def sql_text(t) -> DataFrame:
    """SQL text with a parameter over published views."""
    t.items.createOrReplaceTempView("gold_items")
    return run_sql(
        t.spark,
        "select product_key, count(*) as n_items, cast(sum(price) as double) as spent "
        "from gold_items where price >= :floor group by product_key",
        floor=50000,
    )


over_star("run_sql", sql_text, star_sql(
    "select product_key, count(*) as n_items, sum(price)::double as spent from s_items "
    "where price >= 50000 group by all"
))


def published(t) -> DataFrame:
    """A mart written to the shared folder, offered as a view and read by SQL."""
    publish_mart(
        marts.revenue_by_month(t), "published_revenue", shared_dir(t.spark, "published")
    )
    return run_sql(
        t.spark, "select year, sum(revenue) as revenue from published_revenue group by year"
    ).select("year", F.round("revenue", 2).alias("revenue"))


over_star("publish_mart", published, star_sql(
    "select year, round(sum(price)::double, 2) as revenue from s_items join s_orders "
    "using (order_key) join s_dates on date_key = order_purchase_date_key group by all"
))
over_star("scan_reviews", lambda t: t.review_content, star_sql("select * from s_content"))

_PAYLOAD_COLUMNS = ", ".join(
    f"{c}::double as {c}" if w == "FP64" else f"{c}::bigint as {c}" if w == "INT64" else c
    for c, w in requests.MODEL_INPUTS.items()
)
over_star(
    "json_requests",
    lambda t: requests.json_requests(
        churn.churn_features(t).select(
            "customer_id", requests.encode_request().alias("payload")
        ),
        "payload",
    ),
    _churn(f"select customer_id, {_PAYLOAD_COLUMNS} from churn"),
)

# --- projections and filters ------------------------------------------------------------

over_star("current_customers", churn.current_customers, star_sql(
    "select customer_key, customer_unique_id from s_customers where is_current"
))
over_star("delivered_only", lambda t: t.orders.filter("order_status = 'delivered'"), star_sql(
    "select * from s_orders where order_status = 'delivered'"
))
over_star(
    "notnull_keys",
    lambda t: t.orders.filter(
        F.col("order_approved_at_date_key").isNotNull()
        & F.col("order_delivered_carrier_date_key").isNotNull()
    ).select("order_key", "order_approved_at_date_key", "order_delivered_carrier_date_key"),
    star_sql(
        "select order_key, order_approved_at_date_key, order_delivered_carrier_date_key "
        "from s_orders where order_approved_at_date_key is not null "
        "and order_delivered_carrier_date_key is not null"
    ),
)
over_star(
    "categorised_products", lambda t: t.products.filter("product_category_name is not null"),
    star_sql("select * from s_products where product_category_name is not null"),
)
over_star(
    "product_volume",
    lambda t: content.product_volume(t.products).select("product_key", "product_volume_cm3"),
    star_sql(
        "select product_key, product_length_cm * product_height_cm * product_width_cm "
        "as product_volume_cm3 from s_products"
    ),
)
over_star(
    "having",
    lambda t: rounded(
        t.lines.groupBy("product_key").agg(mean("price").alias("avg_price"))
        .filter(F.col("avg_price").isNotNull())
    ),
    star_sql(
        "select product_key, round(sum(price)::double / count(price), 6) as avg_price "
        "from s_items group by all having sum(price)::double / count(price) is not null"
    ),
)
over_star(
    "coalesce_defaults",
    lambda t: t.products.select(
        "product_key", F.coalesce("product_category_name", F.lit("none")).alias("category"),
        F.coalesce("product_weight_g", F.lit(0)).alias("weight"),
    ),
    star_sql(
        "select product_key, coalesce(product_category_name, 'none') as category, "
        "coalesce(product_weight_g, 0) as weight from s_products"
    ),
)


def select_features(features: DataFrame) -> DataFrame:
    """Model inputs: the identifier, the label and the recency behind the label go."""
    return features.drop("customer_id", "recency_days", "churn_label")


over_star(
    "select_features", lambda t: select_features(churn.churn_features(t)),
    _churn("select * exclude (customer_id, recency_days, churn_label) from churn"),
)
over_star(
    "dropna", lambda t: t.products.na.drop(subset=collaborative.SIZE_COLUMNS), star_sql(
        "select * from s_products where product_weight_g is not null and product_length_cm "
        "is not null and product_height_cm is not null and product_width_cm is not null"
    ),
)
over_star("dropna_all", lambda t: t.orders.na.drop(), star_sql(
    "select * from s_orders where order_approved_at_date_key is not null and "
    "order_delivered_carrier_date_key is not null and "
    "order_delivered_customer_date_key is not null"
))
over_star(
    "rename_project",
    lambda t: rounded(collaborative.product_reviews(t)).toDF("userID", "itemID", "rating"),
    sql_features.cf(
        'select customer_unique_id as "userID", product_key as "itemID", '
        "round(avg_review_score_by_user, 6) as rating from pair_scores"
    ),
)
over_star(
    "cast_dates",
    lambda t: t.raw("orders").select(
        "o_orderkey",
        F.try_to_timestamp(
            F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd"),
            F.lit("yyyy-MM-dd"),
        ).cast("date").alias("placed"),
    ),
    "select o_orderkey, cast(o_orderdate as date) as placed from orders",
)
over_star(
    "review_filter",
    lambda t: text.worth_summarising(t.review_content).select(
        "review_content_key", F.length("review_comment_message").alias("n_chars")
    ),
    star_sql(
        "select review_content_key, length(review_comment_message) as n_chars from s_content "
        "where len(list_filter(regexp_split_to_array(review_comment_message, '\\s+'), "
        "lambda w: w <> '')) >= 8"
    ),
)
over_star(
    "to_str", lambda t: t.payments.select(*[F.col(c).cast("string") for c in t.payments.columns]),
    star_sql("select columns(*)::varchar from s_payments"),
)

# --- joins ------------------------------------------------------------------------------

over_star(
    "fact_dim_inner",
    lambda t: t.payments.join(F.broadcast(t.payment_types), "payment_type_key").select(
        "order_key", "payment_type", "payment_installments"
    ),
    star_sql(
        "select order_key, payment_type, payment_installments from s_payments "
        "join s_types using (payment_type_key)"
    ),
)
over_star(
    "fact_current_dim",
    lambda t: t.items.groupBy("customer_key").agg(F.count(F.lit(1)).alias("n_items")).join(
        churn.current_customers(t), "customer_key"
    ),
    star_sql(
        "select customer_key, customer_unique_id, count(*) as n_items from s_items "
        "join s_customers using (customer_key) where is_current group by all"
    ),
)
over_star("role_playing_dates", churn.delivered_orders, star_sql(
    "select order_key, order_id, bought as purchase_date, handed as delivered_date, "
    "handed - due as delivery_overdue_days, "
    "coalesce(handed > due, false)::int as is_delivered_late, "
    "shipped - approved as internal_processing_days, due - bought as promised_window_days, "
    "on_holiday as is_purchase_holiday "
    "from dated join s_orders using (order_key, order_status) where order_status = 'delivered'",
    **{n: sql_marts.CHURN_PARTS[n] for n in ("stamps", "dated")},
))
over_star(
    "role_playing_date_time",
    lambda t: marts._clocked(
        t,
        marts._clocked(
            t, t.orders.select(
                "order_key", "order_approved_at_date_key", "order_approved_at_time_key",
                "order_delivered_carrier_date_key", "order_delivered_carrier_time_key",
            ), "approved_at",
        ), "delivered_carrier",
    ).select(
        "order_key", F.unix_timestamp("approved_at").alias("approved_s"),
        F.unix_timestamp("delivered_carrier").alias("carrier_s"),
        whole_hours(F.col("approved_at"), F.col("delivered_carrier")).alias("hours"),
    ),
    star_sql(
        "select order_key, approved_s, carrier_s, "
        "trunc((carrier_s - approved_s) / 3600)::bigint as hours from stamps",
        stamps="select order_key, (epoch(a.full_date) + order_approved_at_time_key)::bigint "
        "as approved_s, (epoch(c.full_date) + order_delivered_carrier_time_key)::bigint "
        "as carrier_s from s_orders "
        "join s_dates a on a.date_key = order_approved_at_date_key "
        "join s_dates c on c.date_key = order_delivered_carrier_date_key",
    ),
)
over_star(
    "left_enrich",
    lambda t: rounded(
        t.products.select("product_key").join(
            content.product_review_stats(t).select("product_key", "avg_review_score"),
            "product_key", "left",
        )
    ),
    star_sql(
        "select product_key, round(avg_review_score, 6) as avg_review_score from s_products "
        "left join echo using (product_key)",
        **{n: sql_features.PRODUCT_PARTS[n] for n in ("verdicts", "echo")},
    ),
)
over_star(
    "composite_key_left",
    lambda t: rounded(
        collaborative.user_item_interactions(t)
        .select("customer_unique_id", "product_key", "purchase_count")
        .join(collaborative.product_reviews(t), ["customer_unique_id", "product_key"], "left")
    ),
    sql_features.cf(
        "select p.customer_unique_id, p.product_key, p.purchase_count, "
        "round(avg_review_score_by_user, 6) as avg_review_score_by_user from pairs p "
        "left join pair_scores using (customer_unique_id, product_key)"
    ),
)


def fact_fact(t) -> DataFrame:
    """Item–review rows per order from the many-to-many join of both facts."""
    items = t.lines.groupBy("order_key").agg(F.count(F.lit(1)).alias("n_items"))
    reviews = t.reviews.groupBy("order_key").agg(
        F.count(F.lit(1)).alias("n_reviews"), F.sum("score").alias("score")
    )
    return items.join(reviews, "order_key").select(
        "order_key", (F.col("n_items") * F.col("n_reviews")).alias("n_rows"),
        (F.col("n_items") * F.col("score")).alias("score_total"),
    )


over_star("fact_fact", fact_fact, star_sql(
    "select order_key, count(*) as n_rows, cast(sum(score) as bigint) as score_total "
    "from s_items join s_reviews using (order_key) group by all"
))


def left_reviews(t) -> DataFrame:
    return (
        t.lines.groupBy("order_key").agg(F.count(F.lit(1)).alias("n_items"))
        .join(collaborative.order_reviews(t), "order_key", "left")
        .select(
            "order_key",
            (F.col("n_items") * F.coalesce("n_reviews", F.lit(1))).alias("n_rows"),
            F.coalesce(F.col("n_items") * F.col("n_scores"), F.lit(0)).alias("n_scored"),
        )
    )


over_star("left_reviews", left_reviews, star_sql(
    "select i.order_key, count(*) as n_rows, count(score) as n_scored from s_items i "
    "left join s_reviews r on r.order_key = i.order_key group by all"
))


def scalar_snapshot(t) -> DataFrame:
    """Days from each order to the snapshot date, the snapshot as a scalar subquery."""
    dates = t.dates.select(F.col("date_key").alias("order_purchase_date_key"), "full_date")
    today = churn.analysis_snapshot(t).scalar()
    return t.orders.join(F.broadcast(dates), "order_purchase_date_key").select(
        "order_key", F.datediff(today, F.col("full_date")).alias("age_days")
    )


over_star("scalar_snapshot", scalar_snapshot, star_sql(
    "select order_key, date_diff('day', full_date, (select snapshot_date from snapshot)) "
    "as age_days from s_orders join s_dates on date_key = order_purchase_date_key",
    **{n: sql_marts.CHURN_PARTS[n] for n in ("stamps", "dated", "snapshot")},
))
over_star(
    "orphan_rows",
    lambda t: relational.orphans(
        t.orders.select("order_key"), t.lines.select("order_key"), "order_key"
    ),
    star_sql(
        "select order_key, count(*) as n_rows from s_orders "
        "where order_key not in (select order_key from s_items) group by all"
    ),
)

# --- aggregates -------------------------------------------------------------------------

over_star(
    "group_sum",
    lambda t: t.lines.groupBy("seller_key").agg(as_double(F.sum("price")).alias("revenue")),
    star_sql("select seller_key, sum(price)::double as revenue from s_items group by all"),
)
over_star(
    "count_distinct_multi",
    lambda t: t.items.groupBy("seller_key").agg(
        F.countDistinct("order_key").alias("n_orders"),
        F.countDistinct("customer_key").alias("n_customers"),
        F.countDistinct("product_key").alias("n_products"),
    ),
    star_sql(
        "select seller_key, count(distinct order_key) as n_orders, count(distinct customer_key) "
        "as n_customers, count(distinct product_key) as n_products from s_items group by all"
    ),
)
over_star(
    "count_star_col",
    lambda t: t.orders.groupBy("order_status").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("order_approved_at_date_key").alias("n_approved"),
    ),
    star_sql(
        "select order_status, count(*) as n_rows, count(order_approved_at_date_key) "
        "as n_approved from s_orders group by all"
    ),
)
over_star(
    "avg_min_max",
    lambda t: rounded(t.lines.groupBy("seller_key").agg(
        mean("price").alias("mean_price"), as_double(F.min("price")).alias("low"),
        as_double(F.max("price")).alias("high"),
    )),
    star_sql(
        "select seller_key, round(sum(price)::double / count(price), 6) as mean_price, "
        "min(price)::double as low, max(price)::double as high from s_items group by all"
    ),
)
over_star(
    "stddev_sample",
    lambda t: rounded(t.items.groupBy("customer_key", "product_key").agg(
        F.coalesce(F.stddev_samp(as_double("price")), F.lit(0.0)).alias("spread")
    )),
    star_sql(
        "select customer_key, product_key, round(coalesce(stddev_samp(price::double), 0), 6) "
        "as spread from s_items group by all"
    ),
)
over_star(
    "conditional_avg",
    lambda t: rounded(t.reviews.groupBy("review_creation_date_key").agg(
        mean(F.when(F.col("score") >= 4, 1).otherwise(0)).alias("liked"),
        mean(F.when(F.col("score") > 1, F.col("score"))).alias("mean_above_one"),
    )),
    star_sql(
        "select review_creation_date_key, round(avg(case when score >= 4 then 1 else 0 end), 6) "
        "as liked, round(avg(score) filter (score > 1), 6) as mean_above_one "
        "from s_reviews group by all"
    ),
)
over_star(
    "conditional_sum",
    lambda t: t.raw("documents").join(t.review_content.withColumnRenamed(
        "review_content_key", "doc_id"), "doc_id").groupBy("lang").agg(
        F.count_if(
            (F.length("review_comment_title") > 0) | (F.length("review_comment_message") > 0)
        ).alias("with_text"),
        F.sum(F.coalesce(F.length("review_comment_message"), F.lit(0))).alias("n_chars"),
    ),
    star_sql(
        "select lang, count(*) filter (length(review_comment_title) > 0 or "
        "length(review_comment_message) > 0) as with_text, "
        "cast(sum(coalesce(length(review_comment_message), 0)) as bigint) as n_chars "
        "from s_content join documents on doc_id = review_content_key group by all"
    ),
)
over_star(
    "ratio_of_sums",
    lambda t: t.lines.groupBy("seller_key").agg(
        sixth(ratio(F.sum("freight_value"), F.sum("price")) * 100).alias("freight_percent")
    ),
    star_sql(
        "select seller_key, round(sum(freight_value)::double / nullif(sum(price)::double, 0) "
        "* 100, 6) as freight_percent from s_items group by all"
    ),
)
over_star(
    "mean_ratio",
    lambda t: t.lines.groupBy("product_key").agg(
        sixth(F.avg(ratio(F.col("freight_value"), F.col("price")))).alias("mean_share")
    ),
    star_sql(
        "select product_key, round(avg(freight_value::double / nullif(price::double, 0)), 6) "
        "as mean_share from s_items group by all"
    ),
)


def herfindahl(t) -> DataFrame:
    """Concentration of a product's sales over its sellers."""
    cells = t.lines.groupBy("product_key", "seller_key").agg(F.count(F.lit(1)).alias("n"))
    return cells.groupBy("product_key").agg(
        sixth(mean_of(F.sum(F.col("n") ** 2), F.sum("n") ** 2)).alias("concentration")
    )


over_star("herfindahl", herfindahl, star_sql(
    "select product_key, round(sum(share * share), 6) as concentration from (select product_key, "
    "count(*)::double / sum(count(*)) over (partition by product_key) as share from s_items "
    "group by product_key, seller_key) group by all"
))
over_star(
    "collect_sorted", lambda t: content.customer_preferences(t).select(
        "customer_unique_id", "purchase_category_history"
    ),
    star_sql(
        "select customer_unique_id, coalesce(walk, '') as purchase_category_history "
        "from journeys",
        **{n: sql_features.CUSTOMER_PARTS[n] for n in (*sql_features.FOLDED, "person_lines", "journeys")},
    ),
)


def agg_of_agg(t) -> DataFrame:
    """Customer-level spend folded to persons."""
    per_key = t.items.groupBy("customer_key").agg(F.sum("price").alias("spent"))
    return per_key.join(
        t.customers.select("customer_key", "customer_unique_id"), "customer_key"
    ).groupBy("customer_unique_id").agg(
        as_double(F.max("spent")).alias("most"), as_double(F.sum("spent")).alias("spent"),
        F.count(F.lit(1)).alias("n_keys"),
    )


over_star("agg_of_agg", agg_of_agg, star_sql(
    "select customer_unique_id, max(s)::double as most, sum(s)::double as spent, "
    "count(*) as n_keys from (select customer_key, sum(price) as s from s_items group by all) "
    "join s_customers using (customer_key) group by all"
))
over_star(
    "distinct_rows",
    lambda t: t.items.select("customer_key", "seller_key").distinct(),
    star_sql("select distinct customer_key, seller_key from s_items"),
)


def median_value(t) -> DataFrame:
    """Medians of price and freight by the exact bracketed method."""
    found = quantiles.medians(t.lines, ["price", "freight_value"])
    return t.spark.range(1).select(
        *[sixth(F.lit(v)).alias(f"median_{c}") for c, v in found.items()]
    )


over_star("median_value", median_value, star_sql(
    "select round(median(price::double), 6) as median_price, "
    "round(median(freight_value::double), 6) as median_freight_value from s_items"
))
over_star(
    "value_frequency",
    lambda t: rounded(relational.value_frequency(t.products, "product_category_name")),
    star_sql(
        "select product_category_name, round(count(*)::double / sum(count(*)) over (), 6) "
        "as frequency from s_products where product_category_name is not null "
        "group by product_category_name"
    ),
)
over_star(
    "class_counts",
    lambda t: churn.churn_features(t).groupBy("churn_label").agg(
        F.count(F.lit(1)).alias("n_rows")
    ),
    _churn("select churn_label, count(*) as n_rows from churn group by all"),
)
over_star(
    "nunique",
    lambda t: t.products.agg(*[
        F.countDistinct(c).alias(c) for c in (
            "product_category_name", "product_photos_qty", "product_weight_g")
    ]),
    star_sql(
        "select count(distinct product_category_name) as product_category_name, "
        "count(distinct product_photos_qty) as product_photos_qty, "
        "count(distinct product_weight_g) as product_weight_g from s_products"
    ),
)
over_star(
    "group_by_ordinal",
    lambda t: run_sql(
        _view(t.orders, "gold_orders"),
        "select order_status, order_purchase_date_key div 10000 as year, count(*) as n_orders "
        "from gold_orders group by 1, 2",
    ),
    star_sql(
        "select order_status, order_purchase_date_key // 10000 as year, count(*) as n_orders "
        "from s_orders group by 1, 2"
    ),
)


def _view(df: DataFrame, name: str):
    df.createOrReplaceTempView(name)
    return df.sparkSession


_PROFILED = ["price", "freight_value"]
over_star(
    "describe", lambda t: rounded(relational.profile(t.lines.select(*_PROFILED))),
    star_sql(" union all ".join(
        f"select '{c}' as \"column\", count(*) as n_rows, count(*) - count({c}) as n_null, "
        f"round(avg({c}::double), 6) as mean, round(stddev_samp({c}::double), 6) as std, "
        f"min({c})::double as low, max({c})::double as high from s_items" for c in _PROFILED
    )),
)
_NUMERIC = ["monetary_value", "frequency_orders", "avg_freight", "customer_tenure"]
over_star(
    "eda_correlation",
    lambda t: rounded(relational.correlations(churn.churn_features(t), _NUMERIC)),
    _churn(" union all ".join(
        f"select '{a}' as a, '{b}' as b, round(corr({a}::double, {b}::double), 6) as r from churn"
        for i, a in enumerate(_NUMERIC) for b in _NUMERIC[i + 1:]
    )),
)
over_star(
    "eda_outliers",
    lambda t: rounded(quantiles.outlier_counts(t.lines, _PROFILED)),
    star_sql(" union all ".join(
        f"select '{c}' as \"column\", round(q1, 6) as q1, round(q3, 6) as q3, "
        f"(select count(*) from s_items where {c}::double < q1 - 1.5 * (q3 - q1) "
        f"or {c}::double > q3 + 1.5 * (q3 - q1)) as n_outliers from ("
        f"select quantile_cont({c}::double, 0.25) as q1, quantile_cont({c}::double, 0.75) as q3 "
        "from s_items)" for c in _PROFILED
    )),
)

# --- windows ----------------------------------------------------------------------------


def rank_over_agg(t) -> DataFrame:
    """Every seller's yearly revenue rank."""
    by_revenue = Window.partitionBy("year").orderBy(F.desc("spent"))
    ranked = marts.seller_year_revenue(t).withColumn("rank_num", F.rank().over(by_revenue))
    return ranked.select("seller_id", "year", "rank_num")


over_star("rank_over_agg", rank_over_agg, star_sql(
    "select seller_id, year, cast(rank() over (partition by year order by sum(price) desc) "
    "as int) as rank_num from s_items join s_orders using (order_key) "
    "join s_sellers using (seller_key) join s_dates on date_key = order_purchase_date_key "
    "group by seller_id, seller_city, seller_state, year"
))
over_star(
    "row_number_top1",
    lambda t: t.lines.groupBy("seller_key", "product_key").agg(
        F.count(F.lit(1)).alias("n")
    ).groupBy("seller_key").agg(
        chosen_by(F.col("n"), F.col("product_key")).alias("top_product")
    ),
    star_sql(
        "select seller_key, product_key as top_product from (select seller_key, product_key, "
        "row_number() over (partition by seller_key order by count(*) desc, product_key) as p "
        "from s_items group by seller_key, product_key) where p = 1"
    ),
)
over_star("latest_row", content.latest_customers, star_sql(
    "select customer_unique_id, home.city as customer_city, home.state as customer_state from homes",
    homes=sql_features.CUSTOMER_PARTS["homes"],
))
over_star("first_value_distinct", content.favorite_category, star_sql(
    "select * from likings",
    **{n: sql_features.CUSTOMER_PARTS[n] for n in (*sql_features.FOLDED, "person_lines", "likings")},
))


def share_of_total(t) -> DataFrame:
    """Each payment type's share of a customer's payments; at most one row per type."""
    cells = t.payments.groupBy("customer_key", "payment_type_key").agg(
        F.count(F.lit(1)).alias("n")
    )
    total = F.sum("n").over(Window.partitionBy("customer_key"))
    return cells.select("customer_key", "payment_type_key", sixth(F.col("n") / total).alias("share"))


over_star("share_of_total", share_of_total, star_sql(
    "select customer_key, payment_type_key, round(count(*)::double / "
    "sum(count(*)) over (partition by customer_key), 6) as share from s_payments "
    "group by customer_key, payment_type_key"
))

# --- sorts, limits, samples ---------------------------------------------------------------

over_star(
    "global_sort",
    lambda t: t.lines.groupBy("product_key").agg(as_double(F.sum("price")).alias("spent"))
    .orderBy(F.desc("spent"), "product_key"),
    star_sql("select product_key, sum(price)::double as spent from s_items group by all"),
)


def top_k_per_group(t, k: int = 3) -> DataFrame:
    """The best-selling products of each category."""
    known = t.products.select("product_key", "product_category_name")
    sold = t.lines.groupBy("product_key").agg(F.sum("price").alias("spent")).join(
        known, "product_key"
    )
    best = Window.partitionBy("product_category_name").orderBy(F.desc("spent"), "product_key")
    return sold.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k).select(
        "product_category_name", "product_key", as_double("spent").alias("spent"), "place"
    )


over_star("top_k_per_group", top_k_per_group, star_sql(
    "select product_category_name, product_key, sum(price)::double as spent, "
    "cast(row_number() over (partition by product_category_name order by sum(price) desc, "
    "product_key) as int) as place from s_items join s_products using (product_key) "
    "group by product_category_name, product_key qualify place <= 3"
))
over_star(
    "head",
    lambda t: t.lines.groupBy("product_key").agg(as_double(F.sum("price")).alias("spent"))
    .orderBy(F.desc("spent"), "product_key").limit(20),
    star_sql(
        "select product_key, sum(price)::double as spent from s_items group by all "
        "order by spent desc, product_key limit 20"
    ),
)


def unit_sql(purpose: str, seed: int, *cols: str) -> str:
    """Oracle form of ``hash_unit``."""
    text_ = " || '|' || ".join([f"'{purpose}{seed}'", *[f"{c}::varchar" for c in cols]])
    return f"(('0x' || substr(md5({text_}), 1, 8))::ubigint / 4294967296.0)"


over_star(
    "sample_fraction",
    lambda t: relational.sample_fraction(
        collaborative.user_item_interactions(t).select(
            "customer_unique_id", "product_key", "purchase_count"
        ), 0.15, 42, "customer_unique_id", "product_key",
    ),
    sql_features.cf(
        "select customer_unique_id, product_key, purchase_count from pairs where "
        f"{unit_sql('sample', 42, 'customer_unique_id', 'product_key')} < 0.15"
    ),
)
over_star(
    "sample_n",
    lambda t: relational.sample_n(
        t.review_content.select("review_content_key", "review_comment_message"), 50, 42,
        "review_content_key",
    ),
    star_sql(
        "select review_content_key, review_comment_message from s_content order by "
        f"{unit_sql('sample', 42, 'review_content_key')}, review_content_key limit 50"
    ),
)

# --- sets -------------------------------------------------------------------------------

over_star(
    "union_distinct_vocab",
    lambda t: relational.union_vocabulary(
        [t.customers.select(F.col("customer_city").alias("city")),
         t.sellers.select(F.col("seller_city").alias("city"))], "city",
    ),
    star_sql(
        "select customer_city as city from s_customers union select seller_city from s_sellers"
    ),
)

# --- scalar functions -------------------------------------------------------------------


def scalar_dates(t) -> DataFrame:
    """Day, hour and format functions over every order."""
    dates = F.broadcast(
        t.dates.select(F.col("date_key").alias("order_purchase_date_key"), "full_date")
    )
    clock = F.broadcast(
        t.times.select(F.col("time_key").alias("order_purchase_time_key"), "full_time")
    )
    stamp = at_time(F.col("full_date"), F.col("full_time"))
    return t.orders.join(dates, "order_purchase_date_key").join(
        clock, "order_purchase_time_key"
    ).select(
        "order_key", F.date_add("full_date", 1).alias("next_day"),
        F.datediff(F.lit("2003-01-01").cast("date"), F.col("full_date")).alias("days_left"),
        F.date_format(stamp, "HH:mm:ss").alias("clock"),
        F.date_format(stamp, "yyyy-MM-dd").alias("day_text"),
    )


over_star("scalar_dates", scalar_dates, star_sql(
    "select order_key, full_date + 1 as next_day, "
    "date_diff('day', full_date, date '2003-01-01') as days_left, "
    "strftime(full_time, '%H:%M:%S') as clock, strftime(full_date, '%Y-%m-%d') as day_text "
    "from s_orders join s_dates on date_key = order_purchase_date_key "
    "join s_times on time_key = order_purchase_time_key"
))


def scalar_strings(t) -> DataFrame:
    message = F.col("review_comment_message")
    return t.review_content.select(
        "review_content_key",
        F.concat(F.coalesce("review_comment_title", F.lit("")), F.lit("#")).alias("tagged"),
        F.length(message).alias("n_chars"),
        F.size(F.split(message, " ")).alias("n_parts"),
        F.nullif(F.substring(message, 1, 1), F.lit("T")).alias("first_char"),
    )


over_star("scalar_strings", scalar_strings, star_sql(
    "select review_content_key, coalesce(review_comment_title, '') || '#' as tagged, "
    "length(review_comment_message) as n_chars, "
    "len(string_split(review_comment_message, ' ')) as n_parts, "
    "nullif(substr(review_comment_message, 1, 1), 'T') as first_char from s_content"
))


def scalar_math(t) -> DataFrame:
    price, freight = as_double("price"), as_double("freight_value")
    return t.lines.groupBy("seller_key").agg(
        F.sum(F.pow(F.floor(price / 1000), F.lit(2))).alias("squares"),
        F.count(F.when(F.try_divide(price, freight).isNull(), 1)).alias("free_shipping"),
        F.sum(F.col("price").cast("int")).alias("whole_units"),
    )


over_star("scalar_math", scalar_math, star_sql(
    "select seller_key, sum(power(floor(price::double / 1000), 2)) as squares, "
    "count(*) filter (freight_value = 0) as free_shipping, "
    "cast(sum(floor(price)::bigint) as bigint) as whole_units from s_items group by all"
))

# --- data quality -----------------------------------------------------------------------

_KEY_SQL = " union all ".join(
    f"select '{n}' as \"table\", '{k}' as \"column\", 'not_null' as rule, "
    f"count(*) filter ({k} is null) as failing_rows from {cte} union all "
    f"select '{n}', '{k}', 'unique', (select count(*) from (select {k} from {cte} "
    f"where {k} is not null group by {k} having count(*) > 1))"
    for n, k, cte in (
        (n, k, {"payment_types": "s_types"}.get(n, f"s_{n}"))
        for n, k in quality.DIMENSION_KEYS.items()
    )
)
_EDGE_SQL = " union all ".join(
    f"select '{c}' as \"table\", '{k}' as \"column\", 'relationships' as rule, count(*) "
    f"as failing_rows from s_{c} where {k} is not null and {k} not in (select {k} from "
    f"{ {'payment_types': 's_types'}.get(p, f's_{p}') })"
    for c, edges in quality.RELATIONSHIPS.items() for k, p in edges.items()
)
over_star("dq_keys", quality.dq_keys_report, star_sql(_KEY_SQL))
over_star("dq_relationships", quality.dq_relationships_report, star_sql(_EDGE_SQL))
over_star("dq_report", quality.dq_report, star_sql(f"{_KEY_SQL} union all {_EDGE_SQL}"))
over_star(
    "dq_not_null",
    lambda t: quality.dq_not_null(
        t.orders, "orders", "order_approved_at_date_key", "order_delivered_customer_date_key"
    ),
    star_sql(" union all ".join(
        f"select 'orders' as \"table\", '{c}' as \"column\", 'not_null' as rule, "
        f"count(*) filter ({c} is null) as failing_rows from s_orders"
        for c in ("order_approved_at_date_key", "order_delivered_customer_date_key")
    )),
)


def dq_unique_lines(t) -> DataFrame:
    """Order–line pairs that occur more than once, as a unique rule on the raw lines."""
    lines = t.raw("lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line_id")
    )
    return quality.dq_key(lines, "lineitem", "line_id")


over_star("dq_unique", dq_unique_lines,
          "select 'lineitem' as \"table\", 'line_id' as \"column\", 'unique' as rule, "
          "count(*) as failing_rows from (select l_orderkey, l_linenumber from lineitem "
          "group by all having count(*) > 1) union all "
          "select 'lineitem', 'line_id', 'not_null', 0")
over_star(
    "dq_revenue_model",
    lambda t: quality.dq_revenue_model(marts.revenue_by_month(t), t.dates),
    star_sql(
        "select 'revenue_by_month' as \"table\", 'revenue' as \"column\", 'not_null' as rule, "
        "count(*) filter (revenue is null) as failing_rows from m union all "
        "select 'revenue_by_month', 'month', 'relationships', count(*) from m "
        "where month not in (select month from s_dates)",
        m="select year, month, sum(price) as revenue from s_items join s_orders "
        "using (order_key) join s_dates on date_key = order_purchase_date_key group by all",
    ),
)


def item_rules() -> dict:
    return {
        "freight_positive": F.col("freight_value") > 0,
        "price_below_100k": F.col("price") < 100000,
    }


_GATED = ["order_key", "seller_key", "product_key"]
over_star(
    "quality_gate",
    lambda t: quality.quality_gate(t.items, item_rules(), "drop").passed.select(
        *_GATED, as_double("price").alias("price")
    ),
    star_sql(
        "select order_key, seller_key, product_key, price::double as price from s_items "
        "where freight_value > 0 and price < 100000"
    ),
)
over_star(
    "quality_quarantine",
    lambda t: quality.quality_gate(t.items, item_rules(), "drop").quarantined.select(
        *_GATED, F.array_join("failed_rules", ",").alias("failed_rules")
    ),
    star_sql(
        "select order_key, seller_key, product_key, concat_ws(',', "
        "case when not freight_value > 0 then 'freight_positive' end, "
        "case when not price < 100000 then 'price_below_100k' end) as failed_rules "
        "from s_items where not (freight_value > 0 and price < 100000)"
    ),
)
over_star(
    "quality_rule_counts", lambda t: quality.rule_counts(t.items, item_rules()),
    star_sql(
        "select 'freight_positive' as rule, count(*) filter (not freight_value > 0) "
        "as failing_rows from s_items union all select 'price_below_100k', "
        "count(*) filter (not price < 100000) from s_items"
    ),
)


def observed_counts(t: Star) -> DataFrame:
    """Rows read and rows that break each rule, counted while the clean rows are written."""
    gate, seen = quality.observed_gate(t.items, item_rules(), "items")
    written(gate.passed, "clean-items")
    return t.spark.createDataFrame(list(seen.get.items()), "rule string, failing_rows long")


over_star("quality_observed", observed_counts, star_sql(
    "select 'freight_positive' as rule, count(*) filter (not freight_value > 0) "
    "as failing_rows from s_items union all select 'price_below_100k', "
    "count(*) filter (not price < 100000) from s_items union all "
    "select 'rows_seen', count(*) from s_items"
))
