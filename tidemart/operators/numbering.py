"""Gap-free numbers for distinct values, without a single-task window over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.session import written


def dense_ids(df: DataFrame, col: str, ordered: bool = False) -> DataFrame:
    """(col, idx): each distinct value with a number from 0 without gaps.

    Spark's own increasing ids hold the task and the position in it; adding up the task sizes
    closes the gaps. The values are written first so the numbers cannot change. ``ordered``
    numbers the values in their order, which a range-partitioned sort keeps across tasks.
    """
    values = df.select(col).distinct()
    if ordered:
        values = values.orderBy(col)
    base = written(values.withColumn("_at", F.monotonically_increasing_id()), "ids")
    task = F.shiftright("_at", 33)
    sizes = base.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_n"))
    # One row per task that wrote values: small whatever the data.
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_from"))
    position = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return base.withColumn("_task", task).join(F.broadcast(starts), "_task").select(
        col, (F.col("_from") + position).cast("int").alias("idx")
    )
