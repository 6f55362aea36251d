"""Session settings and the shared folder used for written intermediates."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the plans rely on: AQE merges small shuffle partitions and splits
# skewed ones even when that costs one more exchange further up.
_RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in _RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def sized_for(input_bytes: int) -> dict[str, str]:
    """Shuffle settings for an input of this size.

    Partitions start at about 128 MB of input each, so that a task fits in memory without
    spilling much; adaptive execution merges those that come out small.
    """
    partitions = max(200, input_bytes // (128 << 20))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.files.maxPartitionBytes": "256m" if input_bytes >= 1 << 40 else "128m",
    }


def build_session(app: str = "tidemart", master: str | None = None,
                  input_bytes: int | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    sized = sized_for(input_bytes) if input_bytes else {}
    for key, value in {**_RUNTIME, **sized, **conf}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder that every executor can reach.

    The cluster names the root in ``spark.checkpoint.dir``. Only a single local process may
    fall back to the machine's own temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
        root = tempfile.mkdtemp(prefix="tidemart-")
        spark.conf.set("spark.checkpoint.dir", root)
    return os.path.join(root, f"{label}-{uuid.uuid4().hex}")


def checkpoint_ready(spark: SparkSession) -> None:
    """Let iterative fits cut their lineage: point Spark's checkpoints at the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark, "checkpoints"))


def written(df: DataFrame, label: str) -> DataFrame:
    """Write a frame once to the shared folder and read it back.

    Used where a result feeds several later jobs: it cuts the lineage, and losing an
    executor costs a re-read instead of a re-run.
    """
    spark = df.sparkSession
    path = shared_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows with lists per Arrow batch.
LIST_ROWS = 512


def few_at_once(df: DataFrame) -> DataFrame:
    """Rows with lists, to be handed to Python in small batches.

    The time of a batch with list columns grows faster than its rows, it seems because its size is
    asked for after each row.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(LIST_ROWS))
    return df
