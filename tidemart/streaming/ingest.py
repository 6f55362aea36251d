"""Bronze and silver: incremental file ingest, rescue of bad rows, cleaning, gold keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemart.functions.scalars import surrogate_key
from tidemart.operators.quality import Gate, quality_gate
from tidemart.operators.relational import latest_by

INGEST_COLUMNS = ("source_file", "ingested_at")


def autoload(spark: SparkSession, folder: str, schema: StructType | str, fmt: str = "parquet",
             pattern: str = "*", **options: str) -> DataFrame:
    """A stream over the files of a folder that match a pattern; new files are found by Spark."""
    reader = spark.readStream.format(fmt).schema(schema).option("pathGlobFilter", pattern)
    return reader.options(**options).load(folder)


def with_origin(df: DataFrame) -> DataFrame:
    """Add the source file and the ingest time."""
    return df.withColumn("source_file", F.col("_metadata.file_path")).withColumn(
        "ingested_at", F.current_timestamp()
    )


@dataclass
class Increment:
    """What one run of an incremental load did."""

    rows: int
    total: int


def bronze_append(stream: DataFrame, out: str, checkpoint: str) -> int:
    """Append what arrived since the last run; returns the rows read in this run.

    ``availableNow`` drains the backlog in bounded batches and stops; the checkpoint makes a
    repeated or interrupted run pick up where the last one ended.
    """
    # All progress entries are kept, not the last hundred: the rows of every batch count.
    stream.sparkSession.conf.set("spark.sql.streaming.numRecentProgressUpdates", str(1 << 24))
    query = (
        with_origin(stream).writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).option("path", out)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return sum(p["numInputRows"] for p in query.recentProgress)


def incremental_load(spark: SparkSession, folder: str, schema: StructType | str, out: str,
                     checkpoint: str, **how: str) -> Increment:
    rows = bronze_append(autoload(spark, folder, schema, **how), out, checkpoint)
    return Increment(rows, spark.read.parquet(out).count())


def parse_rescued(df: DataFrame, col: str, schema: str, into: str = "parsed") -> DataFrame:
    """Parse JSON text; text that does not fit goes to ``rescued`` instead of failing the load."""
    whole = F.from_json(F.col(col), f"{schema}, _bad string", {
        "columnNameOfCorruptRecord": "_bad", "mode": "PERMISSIVE",
    })
    return df.withColumn(into, whole).withColumn(
        "rescued", F.when(F.col(f"{into}._bad").isNotNull(), F.col(col))
    )


def silver_clean(df: DataFrame, casts: Mapping[str, Column], rules: Mapping[str, Column],
                 keys: Sequence[str], sequence: Sequence[str]) -> Gate:
    """Cast and trim, split off rows that break a rule, keep the newest row per business key."""
    gate = quality_gate(df.withColumns(dict(casts)), rules, "drop")
    return Gate(latest_by(gate.passed, keys, sequence), gate.quarantined)


def silver_clean_stream(stream: DataFrame, casts: Mapping[str, Column],
                        rules: Mapping[str, Column], keys: Sequence[str], event_time: str,
                        delay: str) -> DataFrame:
    """The streaming form: duplicates of a key within the delay are dropped."""
    clean = quality_gate(stream.withColumns(dict(casts)), rules, "drop").passed
    return clean.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def gold_dimension(df: DataFrame, key: str, business: Sequence[str]) -> DataFrame:
    """Put a stable surrogate key in front of a dimension."""
    return df.select(surrogate_key(*business).alias(key), *df.columns)
