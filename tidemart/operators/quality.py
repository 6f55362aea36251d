"""Data-quality rules: not-null, unique, relationships, and row-level gates."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemart.operators.relational import orphans
from tidemart.sources.star import Star

# Key column per dimension, and child column -> parent per fact.
DIMENSION_KEYS = {
    "customers": "customer_key", "sellers": "seller_key", "products": "product_key",
    "orders": "order_key", "payment_types": "payment_type_key", "dates": "date_key",
    "times": "time_key",
}
RELATIONSHIPS = {
    "items": {"order_key": "orders", "customer_key": "customers", "seller_key": "sellers",
              "product_key": "products"},
    "payments": {"order_key": "orders", "customer_key": "customers",
                 "payment_type_key": "payment_types"},
    "reviews": {"order_key": "orders", "customer_key": "customers"},
}


def _report(table: str, column: str, rule: str, failing: Column) -> list[Column]:
    return [
        F.lit(table).alias("table"), F.lit(column).alias("column"), F.lit(rule).alias("rule"),
        F.coalesce(failing, F.lit(0)).cast("bigint").alias("failing_rows"),
    ]


def dq_key(df: DataFrame, table: str, col: str) -> DataFrame:
    """not_null and unique for one column, both read from one count per value."""
    per_value = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    row = per_value.agg(
        F.sum(F.when(F.col(col).isNull(), F.col("n"))).alias("nulls"),
        F.count(F.when(F.col(col).isNotNull() & (F.col("n") > 1), 1)).alias("repeated"),
    )
    return row.select(F.inline(F.array(
        F.struct(*_report(table, col, "not_null", F.col("nulls"))),
        F.struct(*_report(table, col, "unique", F.col("repeated"))),
    )))


def dq_not_null(df: DataFrame, table: str, *cols: str) -> DataFrame:
    """Null counts of several columns in one pass."""
    row = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols])
    return row.select(F.inline(F.array(*[
        F.struct(*_report(table, c, "not_null", F.col(c))) for c in cols
    ])))


def dq_relationships(child: DataFrame, parent: DataFrame, table: str, col: str, field: str
                     ) -> DataFrame:
    missing = orphans(child, parent, col, field)
    return missing.agg(F.sum("n_rows").alias("n")).select(
        *_report(table, col, "relationships", F.col("n"))
    )


def _union(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole


def dq_keys_report(t: Star) -> DataFrame:
    return _union([dq_key(t[name], name, key) for name, key in DIMENSION_KEYS.items()])


def dq_relationships_report(t: Star) -> DataFrame:
    return _union([
        dq_relationships(t[child].select(col), t[parent].select(col), child, col, col)
        for child, edges in RELATIONSHIPS.items() for col, parent in edges.items()
    ])


def dq_report(t: Star) -> DataFrame:
    return dq_keys_report(t).unionByName(dq_relationships_report(t))


def dq_revenue_model(revenue: DataFrame, dates: DataFrame) -> DataFrame:
    """The revenue mart's own rules: revenue set, month known to the calendar."""
    return dq_not_null(revenue, "revenue_by_month", "revenue").unionByName(
        dq_relationships(revenue, dates, "revenue_by_month", "month", "month")
    )


class Gate(NamedTuple):
    passed: DataFrame
    quarantined: DataFrame


def failed_rules(rules: Mapping[str, Column]) -> Column:
    """Names of the rules a row breaks; a null outcome counts as broken."""
    return F.filter(
        F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(n)) for n, ok in rules.items()]),
        lambda name: name.isNotNull(),
    )


def quality_gate(df: DataFrame, rules: Mapping[str, Column], mode: str = "drop") -> Gate:
    """Split rows by expectations.

    ``warn`` passes every row, ``drop`` passes the clean ones, ``fail`` stops the job at the
    first broken row. The broken rows carry ``failed_rules`` in the second frame.
    """
    tagged = df.withColumn("failed_rules", failed_rules(rules))
    clean = F.size("failed_rules") == 0
    bad = tagged.filter(~clean)
    if mode == "warn":
        return Gate(df, bad)
    if mode == "drop":
        return Gate(tagged.filter(clean).drop("failed_rules"), bad)
    if mode == "fail":
        stop = F.raise_error(
            F.concat(F.lit("quality gate: "), F.array_join("failed_rules", ", "))
        )
        checked = tagged.filter(F.when(clean, True).otherwise(stop.cast("boolean")))
        return Gate(checked.drop("failed_rules"), bad)
    raise ValueError(f"unknown gate mode: {mode}")


def rule_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows that break each rule, all rules in one pass."""
    row = df.agg(*[
        F.count(F.when(~F.coalesce(ok, F.lit(False)), 1)).alias(n) for n, ok in rules.items()
    ])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("rule"), F.col(n).alias("failing_rows")) for n in rules
    ])))


ROWS_SEEN = "rows_seen"


def _counts(rules: Mapping[str, Column]) -> list[Column]:
    return [F.count(F.lit(1)).alias(ROWS_SEEN)] + [
        F.count(F.when(~F.coalesce(ok, F.lit(False)), 1)).alias(n) for n, ok in rules.items()
    ]


def observed_gate(df: DataFrame, rules: Mapping[str, Column], name: str, mode: str = "drop"
                  ) -> tuple[Gate, Observation | None]:
    """The gate whose passing frame also counts what it reads, without a pass of its own.

    A batch gives an ``Observation``, filled by the first action on the passing frame. A stream
    reports the counts in each progress under ``name``. A stage run again after a lost executor may
    count its rows twice; ``rule_counts`` is exact at the price of its own pass.
    """
    seen = None if df.isStreaming else Observation(name)
    counted = df.observe(seen or name, *_counts(rules))
    gate = quality_gate(counted, rules, mode)
    return Gate(gate.passed, quality_gate(df, rules, mode).quarantined), seen
