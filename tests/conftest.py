import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemart.session import build_session  # noqa: E402
from tidemart.sources.star import Star, load_star  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]", **{
            "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        }
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small(spark):
    return load_star(spark, SMALL)


ITEM = (
    "order_key long, order_id string, customer_key long, seller_key long, product_key long, "
    "price decimal(12,2), freight_value decimal(12,2)"
)
ORDER = (
    "order_key long, order_id string, order_status string, order_purchase_date_key long, "
    "order_approved_at_date_key long, order_delivered_carrier_date_key long, "
    "order_delivered_customer_date_key long, order_estimated_delivery_date_key long, "
    "order_purchase_time_key long, order_approved_at_time_key long, "
    "order_delivered_carrier_time_key long"
)
CUSTOMER = (
    "customer_key long, customer_unique_id string, customer_city string, "
    "customer_state string, is_current boolean"
)
PRODUCT = (
    "product_key long, product_category_name string, product_name_lenght int, "
    "product_description_lenght int, product_photos_qty int, product_weight_g int, "
    "product_length_cm int, product_height_cm int, product_width_cm int"
)
REVIEW = (
    "review_id string, order_key long, customer_key long, score int, review_content_key long, "
    "review_creation_date_key long, review_answer_date_key long"
)
PAYMENT = (
    "order_key long, customer_key long, payment_type_key int, payment_value decimal(12,2), "
    "payment_installments long"
)


class Builder:
    """A tiny star: give rows for the tables that matter, the rest stays empty."""

    def __init__(self, spark):
        self.spark = spark

    def order(self, key, purchase=20000103, status="delivered", delivered=20000110,
              estimated=20000115):
        return (key, f"o{key}", status, purchase, 20000104, 20000106, delivered, estimated, 0, 0, 0)

    def star(self, items=(), orders=(), customers=(), products=(), reviews=(), payments=(),
             sellers=(), content=()):
        from decimal import Decimal

        from tidemart.sources.star import PAYMENT_TYPES, calendar_dim, clock_dim

        def money(rows, *at):
            return [tuple(Decimal(str(v)) if i in at else v for i, v in enumerate(r)) for r in rows]

        def frame(rows, schema):
            return self.spark.createDataFrame(list(rows), schema)

        return Star(
            self.spark,
            items=frame(money(items, 5, 6), ITEM), orders=frame(orders, ORDER),
            customers=frame(customers, CUSTOMER), products=frame(products, PRODUCT),
            reviews=frame(reviews, REVIEW), payments=frame(money(payments, 3), PAYMENT),
            sellers=frame(
                sellers, "seller_key long, seller_id string, seller_city string, seller_state string"
            ),
            review_content=frame(
                content, "review_content_key long, review_comment_title string, "
                "review_comment_message string"
            ),
            payment_types=frame(PAYMENT_TYPES, "payment_type_key int, payment_type string"),
            dates=calendar_dim(self.spark, "2000-01-01", "2001-12-31"), times=clock_dim(self.spark),
        )


@pytest.fixture(scope="session")
def build(spark):
    return Builder(spark)
