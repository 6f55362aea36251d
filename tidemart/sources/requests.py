"""Scoring requests as JSON lists of named one-element tensors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Model inputs in payload order with their wire types.
MODEL_INPUTS = {
    "customer_tenure": "INT64", "frequency_orders": "INT64", "monetary_value": "FP64",
    "sum_freight": "FP64", "avg_order_price": "FP64", "avg_freight": "FP64",
    "avg_delivery_delay": "FP64", "late_delivery_rate": "FP64",
    "avg_delivery_overdue_days": "FP64", "avg_internal_processing_days": "FP64",
    "avg_promised_window_days": "FP64", "holiday_purchase_rate": "FP64",
    "avg_overdue_days_on_holidays": "FP64", "avg_overdue_days_on_non_holidays": "FP64",
    "avg_review_score": "FP64", "distinct_payment_methods": "FP64", "avg_installments": "FP64",
    "distinct_categories": "FP64", "distinct_products": "FP64", "distinct_sellers": "FP64",
    "category_concentration": "FP64", "most_purchased_product": "FP64",
    "most_used_payment_type": "BYTES", "review_with_comment": "FP64",
    "avg_review_response_time": "FP64",
}
_TYPES = {"INT64": "bigint", "FP64": "double", "BYTES": "string"}
_PAYLOAD = "inputs array<struct<name string, shape array<int>, datatype string, data array<string>>>"


def encode_request(columns: dict[str, str] = MODEL_INPUTS) -> Column:
    """One row's model inputs as payload text."""
    tensors = [
        F.concat(
            F.lit(f'{{"name":"{name}","shape":[1],"datatype":"{wire}","data":['),
            F.coalesce(_wire_value(name, wire), F.lit("null")),
            F.lit("]}"),
        )
        for name, wire in columns.items()
    ]
    return F.concat(F.lit('{"inputs":['), F.concat_ws(",", *tensors), F.lit("]}"))


def _wire_value(name: str, wire: str) -> Column:
    value = F.col(name).cast(_TYPES[wire]).cast("string")
    return F.concat(F.lit('"'), value, F.lit('"')) if wire == "BYTES" else value


def json_requests(df: DataFrame, col: str, columns: dict[str, str] = MODEL_INPUTS) -> DataFrame:
    """Decode payload text to typed model inputs; the other columns stay.

    A payload that does not parse gives nulls. Of a repeated name the first tensor counts.
    """
    parsed = F.from_json(F.col(col), _PAYLOAD)["inputs"]
    rows = df.withColumn("_inputs", parsed)

    def read(name: str, wire: str) -> Column:
        named = F.filter("_inputs", lambda x: x["name"] == name)
        first = F.get(named, F.lit(0))["data"]
        return F.get(first, F.lit(0)).try_cast(_TYPES[wire]).alias(name)

    keep = [c for c in df.columns if c != col]
    return rows.select(*keep, *[read(n, w) for n, w in columns.items()])
