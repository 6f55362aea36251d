"""Hand-made frames with literal expected rows for the quirks of the plans."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tidemart.operators import quality
from tidemart.plans import churn, collaborative, content, marts, text
from tidemart.sources.star import load_star

ANN = (1, "u1", "a", "X", True)
PRODUCT = (10, "toys", 5, 10, 1, 100, 10, 2, 3)


def item(order, customer=1, product=10, seller=7, price=10.0, freight=1.0):
    return (order, f"o{order}", customer, seller, product, price, freight)


def test_two_item_order_counts_twice_by_key_and_once_dedup(build):
    t = build.star(
        items=[item(1, price=10.0), item(1, product=11, price=30.0)], orders=[build.order(1)],
        customers=[ANN],
    )
    row = churn.customer_key_agg(t).first()
    assert float(row["monetary_value"]) == 80.0 and row["frequency_orders"] == 1
    assert row["avg_order_price"] == 40.0
    once = churn.customer_key_agg_dedup(t).first()
    assert float(once["monetary_value"]) == 40.0 and once["frequency_orders"] == 1


def test_order_of_two_customers_meets_both_totals(build):
    t = build.star(
        items=[item(1, customer=1, price=10.0), item(1, customer=2, price=30.0)],
        orders=[build.order(1)], customers=[ANN, (2, "u2", "b", "Y", True)],
    )
    rows = {r["customer_key"]: r for r in churn.customer_key_agg(t).collect()}
    assert float(rows[1]["monetary_value"]) == 40.0 and rows[1]["avg_order_price"] == 20.0


def test_two_reviews_double_the_spend(build):
    review = [("r1", 1, 1, 5, 1, 20000110, 20000112), ("r2", 1, 1, 1, 1, 20000110, 20000111)]
    t = build.star(
        items=[item(1)], orders=[build.order(1)], customers=[ANN], products=[PRODUCT],
        reviews=review,
    )
    row = collaborative.cf_user_features(t).first()
    assert row["total_monetary"] == 20.0 and row["avg_overall_review_score"] == 3.0
    assert collaborative.cf_user_features_dedup(t).first()["total_monetary"] == 10.0
    sold = collaborative.cf_product_features(t).first()
    assert sold["total_sales_count"] == 2 and sold["avg_product_price"] == 10.0


def test_purchases_on_old_versions_drop_out(build):
    t = build.star(
        items=[item(1, customer=1), item(2, customer=2)],
        orders=[build.order(1), build.order(2)],
        customers=[(1, "u1", "a", "X", False), (2, "u1", "a", "Y", True)],
    )
    rows = marts.distributed_state_revenue(t).collect()
    assert [(r["customer_state"], r["total_revenue"]) for r in rows] == [("Y", 10.0)]


def test_person_with_two_current_keys_may_give_two_rows(build):
    customers = [(1, "u1", "a", "X", True), (2, "u1", "a", "X", True)]
    reviews = [("r1", 1, 1, 5, 1, 20000110, 20000112), ("r2", 2, 2, 1, 1, 20000110, 20000112)]
    t = build.star(
        items=[item(1, customer=1), item(2, customer=2)],
        orders=[build.order(1), build.order(2)], customers=customers, products=[PRODUCT],
        reviews=reviews, content=[(1, None, "text")],
    )
    assert churn.churn_features(t).count() == 2
    assert churn.churn_features_dedup(t).count() == 1


def test_tied_tenth_seller_stays(build):
    sellers = [(s, f"s{s}", "c", "Z") for s in range(11)]
    items = [item(1, seller=s, price=100.0 - s if s < 9 else 50.0) for s in range(11)]
    t = build.star(items=items, orders=[build.order(1)], customers=[ANN], sellers=sellers)
    rows = marts.top10_sellers_each_year(t).collect()
    assert len(rows) == 11 and [r["rank_num"] for r in rows][-2:] == [10, 10]


def test_history_keeps_order_and_skips_null_categories(build):
    products = [(10, "b", *[1] * 7), (11, None, *[1] * 7), (12, "a", *[1] * 7)]
    items = [item(1, product=10), item(1, product=11), item(1, product=12), item(2, product=10),
             item(2, product=10)]
    t = build.star(
        items=items, orders=[build.order(1), build.order(2, purchase=20000201)],
        customers=[ANN], products=products,
    )
    row = content.customer_preferences(t).first()
    assert row["purchase_category_history"] == "a | b | b | b"
    assert row["distinct_categories_purchased"] == 2


def test_zero_price_gives_null_ratio_not_an_error(build):
    t = build.star(items=[item(1, price=0.0)], orders=[build.order(1)], customers=[ANN])
    row = content.product_sales(t).first()
    assert row["freight_to_price_ratio"] is None and row["stddev_price"] is None


def test_single_order_has_no_gap_between_orders(build):
    t = build.star(
        items=[item(1)], orders=[build.order(1)], customers=[ANN], products=[PRODUCT]
    )
    row = content.customer_content_features(t).first()
    assert row["avg_days_between_orders"] is None and row["days_since_last_purchase"] == 1
    assert row["max_payment_installments"] == 1 and row["favorite_category"] == "toys"


def test_peak_labels_can_be_replaced(build):
    t = build.star(orders=[build.order(1)])
    row = marts.mkt_peak_purchase_times_analysis(t, {1: "Mon"}, "?").first()
    assert (row["day_of_week_name"], row["time_of_day_bucket"]) == ("Mon", "night")


def test_ties_choose_the_smallest_value(build):
    t = build.star(items=[item(1, product=12), item(1, product=11)], customers=[ANN],
                   products=[(11, "x", *[1] * 7), (12, "y", *[1] * 7)])
    assert churn.top_product_unique(t).first()["most_purchased_product"] == 11


def test_review_filter(spark):
    seven, eight = "a b c d e f g", "a b c d e f g h"
    rows = spark.createDataFrame(
        [(1, None), (2, ""), (3, seven), (4, f"  {eight} ")],
        "review_content_key long, review_comment_message string",
    )
    assert [r[0] for r in text.worth_summarising(rows).collect()] == [4]


def test_summary_takes_the_densest_sentences_in_order(spark):
    message = (
        "Nothing here to see at all today. The delivery delivery was late. "
        "Late delivery again and again delivery late."
    )
    rows = spark.createDataFrame(
        [(1, message)], "review_content_key long, review_comment_message string"
    )
    short = text.summarise_reviews(rows, max_words=13).first()["summary"]
    assert short == "The delivery delivery was late. Late delivery again and again delivery late."
    assert text.summarise_reviews(rows).first()["summary"] == message


def test_summarise_with_a_user_model(spark):
    rows = spark.createDataFrame(
        [(1, "a b c d e f g h"), (2, "short")],
        "review_content_key long, review_comment_message string",
    )

    def load():
        return lambda texts: [t.split()[0] for t in texts]

    got = text.summarise_with(rows, load).collect()
    assert [(r[0], r["summary"]) for r in got] == [(1, "a")]


def test_orders_of_any_year_are_kept(spark, tmp_path):
    """The calendar spans the data: nothing is lost before 1995 or after 2002."""
    import shutil

    root = tmp_path / "data"
    root.mkdir()
    for name in ("lineitem", "customer", "nation", "supplier", "part", "documents"):
        shutil.copy(f"{SMALL}/{name}.parquet", root)
    orders = spark.read.parquet(f"{SMALL}/orders.parquet")
    orders.withColumn("o_orderdate", F.expr(
        "case when o_orderkey % 2 = 0 then o_orderdate - interval 20 years "
        "else o_orderdate + interval 30 years end")).write.parquet(str(root / "orders.parquet"))
    moved, same = (marts.revenue_by_month(load_star(spark, str(r))) for r in (root, SMALL))
    assert moved.agg(F.sum("revenue")).first()[0] == pytest.approx(same.agg(F.sum("revenue")).first()[0])
    assert moved.agg(F.min("year")).first()[0] < 1990


def test_a_line_without_its_order_is_reported(spark, tmp_path):
    import shutil

    root = tmp_path / "data"
    root.mkdir()
    for name in ("orders", "customer", "nation", "supplier", "part", "documents"):
        shutil.copy(f"{SMALL}/{name}.parquet", root)
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    stray = lines.limit(3).withColumn("l_orderkey", F.lit(10**12))
    lines.unionByName(stray).write.parquet(str(root / "lineitem.parquet"))
    rows = quality.dq_relationships_report(load_star(spark, str(root))).filter("failing_rows > 0").collect()
    assert [(r["table"], r["column"], r["failing_rows"]) for r in rows] == [("items", "order_key", 3)]


def test_no_row_of_a_table_repeats_in_every_column(small):
    table = collaborative.cf_interaction_table(small, ordered=False)
    assert collaborative.duplicate_count(table).first()[0] == 0
    twice = table.unionByName(table.limit(7))
    assert collaborative.duplicate_count(twice).first()[0] == 7


def test_fixture_totals(spark):
    """The check totals of FIXTURES.md, read from the adapter."""
    t = load_star(spark, "/root/testdata/sf0.01")
    items = t.items.agg(F.count("*"), F.sum("price"), F.sum("freight_value")).first()
    assert (items[0], str(items[1]), str(items[2])) == (60000, "3183256271.63", "127108054.43")
    assert t.payments.count() == 15600
    scores = {r["score"]: r["count"] for r in t.reviews.groupBy("score").count().collect()}
    assert scores == {1: 3647, 2: 2184, 3: 2182, 4: 2181, 5: 2181}
    people = t.customers.agg(
        F.count("*"), F.countDistinct("customer_unique_id"), F.count(F.when(F.col("is_current"), 1)))
    assert tuple(people.first()) == (1500, 1200, 1350)
    assert t.orders.filter("order_status = 'delivered'").count() == 4933
    assert t.dates.agg(F.count("*"), F.count(F.when(F.col("is_holiday"), 1))).first()[:] == (2557, 56)
