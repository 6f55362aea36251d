"""Run a stream to the end of its present input and read what it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemart.session import shared_dir


def drain(stream: DataFrame, label: str) -> DataFrame:
    """Append-mode stream to Parquet in the shared folder, then a batch read of it."""
    spark = stream.sparkSession
    root = shared_dir(spark, label)
    stream.writeStream.format("parquet").outputMode("append").option(
        "checkpointLocation", f"{root}/checkpoint"
    ).option("path", f"{root}/data").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/data")


def drain_updates(stream: DataFrame, label: str, mode: str = "update") -> DataFrame:
    """Update- or complete-mode stream; each batch overwrites its own folder, so a repeated
    batch is harmless. The batches are read back with their ``batch_id``."""
    spark = stream.sparkSession
    root = shared_dir(spark, label)

    batches = []

    def keep(batch: DataFrame, batch_id: int) -> None:
        batches.append(batch_id)
        batch.write.mode("overwrite").parquet(f"{root}/data/batch_id={batch_id}")

    stream.writeStream.outputMode(mode).option(
        "checkpointLocation", f"{root}/checkpoint"
    ).foreachBatch(keep).trigger(availableNow=True).start().awaitTermination()
    if not batches:  # nothing has arrived
        return spark.createDataFrame([], f"{stream.schema.simpleString()[7:-1]}, batch_id: int")
    return spark.read.parquet(f"{root}/data")
