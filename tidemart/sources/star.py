"""Star schema over the raw retail tables.

Each star table is a projection of raw columns. The expressions are plain SQL that Spark
and the test oracle both accept, so they are kept as text in one place.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"


def date_key(day: str) -> str:
    return f"cast(year({day}) * 10000 + month({day}) * 100 + day({day}) as bigint)"


_PLACED = "cast(o_orderdate as date)"
_APPROVED = f"({_PLACED} + cast(o_orderkey % 3 as int))"
_CARRIER = f"({_PLACED} + cast(o_orderkey % 3 + o_orderkey % 5 + 1 as int))"
_DELIVERED = f"({_PLACED} + cast(o_orderkey % 3 + o_orderkey % 5 + 1 + o_orderkey % 20 as int))"
_ESTIMATED = f"({_PLACED} + cast(12 + o_orderkey % 7 as int))"

ORDERS = [
    "o_orderkey as order_key",
    "'o' || o_orderkey as order_id",
    "case o_orderstatus when 'F' then 'delivered' when 'O' then 'shipped' "
    "else 'processing' end as order_status",
    f"{date_key(_PLACED)} as order_purchase_date_key",
    f"case when o_orderkey % 53 <> 0 then {date_key(_APPROVED)} end as order_approved_at_date_key",
    f"case when o_orderstatus <> 'P' then {date_key(_CARRIER)} end "
    "as order_delivered_carrier_date_key",
    f"case when o_orderstatus = 'F' then {date_key(_DELIVERED)} end "
    "as order_delivered_customer_date_key",
    f"{date_key(_ESTIMATED)} as order_estimated_delivery_date_key",
    "(o_orderkey * 7919) % 86400 as order_purchase_time_key",
    "(o_orderkey * 104729) % 86400 as order_approved_at_time_key",
    "(o_orderkey * 1299709) % 86400 as order_delivered_carrier_time_key",
]

CUSTOMERS = [
    "c_custkey as customer_key",
    "'u' || (case when c_custkey % 10 in (1, 3) then c_custkey - 1 else c_custkey end) "
    "as customer_unique_id",
    "'city_' || (c_custkey % 40) as customer_city",
    "n_name as customer_state",
    "(c_custkey % 10 <> 0) as is_current",
]

SELLERS = [
    "s_suppkey as seller_key",
    "s_name as seller_id",
    "'city_' || (s_suppkey % 10) as seller_city",
    "n_name as seller_state",
]

# The column spelling "lenght" is part of the schema.
PRODUCTS = [
    "p_partkey as product_key",
    "case when p_partkey % 50 <> 0 then p_type || '_' || p_brand end as product_category_name",
    "cast(length(p_name) as int) as product_name_lenght",
    "p_size * 10 as product_description_lenght",
    "p_size % 6 + 1 as product_photos_qty",
    "case when p_partkey % 97 <> 0 then p_size * 100 end as product_weight_g",
    "case when p_partkey % 97 <> 0 then p_size + 10 end as product_length_cm",
    "case when p_partkey % 97 <> 0 then p_size % 20 + 2 end as product_height_cm",
    "case when p_partkey % 97 <> 0 then p_size % 30 + 5 end as product_width_cm",
]

REVIEW_CONTENT = [
    "doc_id as review_content_key",
    "case when doc_id % 3 <> 0 then substr(text, 1, 20) end as review_comment_title",
    "case when doc_id % 4 <> 0 then text end as review_comment_message",
]

_PRICE = f"cast(l_extendedprice as {MONEY})"

ITEMS = [
    "l_orderkey as order_key",
    "'o' || l_orderkey as order_id",
    "o_custkey as customer_key",
    "l_suppkey as seller_key",
    "l_partkey as product_key",
    f"{_PRICE} as price",
    f"cast({_PRICE} * cast(l_tax as decimal(4,2)) as {MONEY}) as freight_value",
]

#: Items as far as their own table knows them.
LINES = [c for c in ITEMS if not c.endswith("customer_key")]

PAYMENTS = [
    "o_orderkey as order_key",
    "o_custkey as customer_key",
    "cast(substr(o_orderpriority, 1, 1) as int) as payment_type_key",
    f"cast(o_totalprice as {MONEY}) as payment_value",
    "1 + o_orderkey % 10 as payment_installments",
]
SECOND_PAYMENTS = [
    "o_orderkey as order_key",
    "o_custkey as customer_key",
    "cast(3 as int) as payment_type_key",
    f"cast(10 as {MONEY}) as payment_value",
    "cast(1 as bigint) as payment_installments",
]
SECOND_PAYMENT_RULE = "o_orderkey % 25 = 0"


def _review(prefix: str, score: str, created: str, answered: str) -> list[str]:
    return [
        f"'{prefix}' || o_orderkey as review_id",
        "o_orderkey as order_key",
        "o_custkey as customer_key",
        f"cast({score} as int) as score",
        "o_orderkey % n_documents as review_content_key",
        f"{date_key(created)} as review_creation_date_key",
        f"{date_key(answered)} as review_answer_date_key",
    ]


REVIEWS = _review(
    "r", "1 + (o_orderkey % 11) % 5", f"({_PLACED} + 30)",
    f"({_PLACED} + cast(30 + o_orderkey % 6 as int))",
)
REVIEW_RULE = "o_orderkey % 5 <> 0"
SECOND_REVIEWS = _review("s", "1", f"({_PLACED} + 40)", f"({_PLACED} + 41)")
SECOND_REVIEW_RULE = "o_orderkey % 40 = 1"

# Payment names by key, holidays as MMDD; no date lies further behind its order.
PAYMENT_TYPES = [
    (1, "credit_card"), (2, "boleto"), (3, "voucher"), (4, "debit_card"), (5, "not_defined"),
]
LATEST_DAYS = 60
HOLIDAYS = (101, 421, 501, 907, 1012, 1102, 1115, 1225)

DATES = [
    f"{date_key('full_date')} as date_key",
    "full_date",
    "cast(year(full_date) as int) as year",
    "cast(month(full_date) as int) as month",
    f"(month(full_date) * 100 + day(full_date)) in {HOLIDAYS} as is_holiday",
]
TIMES = [
    "second_of_day as time_key",
    "case when second_of_day < 21600 then 'night' when second_of_day < 43200 then 'morning' "
    "when second_of_day < 64800 then 'afternoon' else 'evening' end as time_of_day_bucket",
]


class Star:
    """The star tables, each built when first asked for."""

    tables = (
        "customers", "sellers", "products", "orders", "payment_types", "dates", "times",
        "review_content", "items", "payments", "reviews",
    )

    def __init__(self, spark: SparkSession, **frames: DataFrame):
        self.spark = spark
        self.__dict__.update(frames)

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)

    @cached_property
    def lines(self) -> DataFrame:
        """Items without the customer, for whom the raw tables must ask the orders."""
        return self.items.drop("customer_key")

    def sold(self, cols: list, placed: DataFrame, persons: DataFrame) -> DataFrame:
        """Items (order_key and ``cols``) with ``placed`` of their order and ``persons`` of their customer."""
        lines = self.items.select("order_key", "customer_key", *cols)
        return lines.join(placed, "order_key").join(persons, "customer_key")


class RawStar(Star):
    """Star tables derived from the raw Parquet tables in one folder."""

    def __init__(self, spark: SparkSession, root: str):
        super().__init__(spark)
        self.root = root
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = self.spark.read.parquet(f"{self.root}/{name}.parquet")
        return self._raw[name]

    @cached_property
    def customers(self) -> DataFrame:
        nation = self.raw("nation")
        raw = self.raw("customer")
        return raw.join(nation, raw.c_nationkey == nation.n_nationkey).selectExpr(*CUSTOMERS)

    @cached_property
    def sellers(self) -> DataFrame:
        nation = self.raw("nation")
        raw = self.raw("supplier")
        return raw.join(nation, raw.s_nationkey == nation.n_nationkey).selectExpr(*SELLERS)

    @cached_property
    def products(self) -> DataFrame:
        return self.raw("part").selectExpr(*PRODUCTS)

    @cached_property
    def orders(self) -> DataFrame:
        return self.raw("orders").selectExpr(*ORDERS)

    @cached_property
    def payment_types(self) -> DataFrame:
        rows = ", ".join(f"({key}, '{name}')" for key, name in PAYMENT_TYPES)
        return self.spark.sql(f"select * from values {rows} as v(payment_type_key, payment_type)")

    @cached_property
    def dates(self) -> DataFrame:
        """Whole years around all dates of the facts; the span is read once, as two dates."""
        first, last = self.raw("orders").agg(
            F.trunc(F.min("o_orderdate").cast("date"), "year"),
            F.last_day(F.add_months(F.trunc(
                F.date_add(F.max("o_orderdate").cast("date"), LATEST_DAYS), "year"), 11)),
        ).first()
        if first is None:
            return calendar_dim(self.spark, "2000-01-01", "2000-01-01").limit(0)
        return calendar_dim(self.spark, str(first), str(last))

    @cached_property
    def times(self) -> DataFrame:
        return clock_dim(self.spark)

    @cached_property
    def review_content(self) -> DataFrame:
        return self.raw("documents").selectExpr(*REVIEW_CONTENT)

    @cached_property
    def items(self) -> DataFrame:
        lines, orders = self.raw("lineitem"), self.raw("orders")
        # A line without its order stays, so that the quality rules can see it.
        return lines.join(orders, lines.l_orderkey == orders.o_orderkey, "left").selectExpr(*ITEMS)

    @cached_property
    def lines(self) -> DataFrame:
        return self.raw("lineitem").selectExpr(*LINES)

    def sold(self, cols: list, placed: DataFrame, persons: DataFrame) -> DataFrame:
        """Orders meet their customers before the lines do, so that a line crosses the network once."""
        buyers = self.raw("orders").selectExpr("o_orderkey as order_key", "o_custkey as customer_key")
        known = buyers.join(placed, "order_key").join(persons, "customer_key")
        return self.lines.select("order_key", *cols).join(known, "order_key")

    @cached_property
    def payments(self) -> DataFrame:
        orders = self.raw("orders")
        second = orders.filter(SECOND_PAYMENT_RULE).selectExpr(*SECOND_PAYMENTS)
        return orders.selectExpr(*PAYMENTS).unionByName(second)

    @cached_property
    def reviews(self) -> DataFrame:
        n_documents = self.raw("documents").count()
        orders = self.raw("orders").withColumn("n_documents", F.lit(n_documents).cast("long"))
        second = orders.filter(SECOND_REVIEW_RULE).selectExpr(*SECOND_REVIEWS)
        return orders.filter(REVIEW_RULE).selectExpr(*REVIEWS).unionByName(second)


def calendar_dim(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row per day; ``day_of_week`` counts Monday as 1."""
    days = spark.sql(
        f"select explode(sequence(date '{first}', date '{last}')) as full_date"
    )
    return with_date_parts(days)


def with_date_parts(days: DataFrame) -> DataFrame:
    return days.selectExpr(*DATES, "cast(weekday(full_date) + 1 as int) as day_of_week")


def clock_dim(spark: SparkSession) -> DataFrame:
    """One row per second of the day."""
    seconds = spark.range(86400).withColumnRenamed("id", "second_of_day")
    return seconds.selectExpr(*TIMES, "timestamp_seconds(second_of_day) as full_time")


def load_star(spark: SparkSession, root: str) -> Star:
    return RawStar(spark, root)


def read_gold(spark: SparkSession, root: str) -> Star:
    """The star from a folder of materialised gold tables."""
    return Star(spark, **{n: spark.read.parquet(f"{root}/{n}") for n in Star.tables})


def write_gold(star: Star, root: str) -> None:
    """Materialise the star; items carry their purchase year as a partition column."""
    for name in Star.tables:
        frame = star[name]
        if name == "items":
            placed = star.orders.select(
                "order_key",
                (F.col("order_purchase_date_key") / 10000).cast("int").alias("purchase_year"),
            )
            frame.join(placed, "order_key", "left").write.partitionBy("purchase_year").parquet(
                f"{root}/{name}"
            )
        else:
            frame.write.parquet(f"{root}/{name}")
