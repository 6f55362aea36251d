"""Published views, SQL text, and table versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def run_sql(spark: SparkSession, text: str, **params) -> DataFrame:
    """Run SQL text; values enter as named parameters, never by string building."""
    return spark.sql(text, args=params)


def publish_mart(df: DataFrame, name: str, path: str | None = None) -> None:
    """Offer a mart as a view, backed by Parquet when a path is given."""
    if path:
        df.write.mode("overwrite").parquet(path)
        df = df.sparkSession.read.parquet(path)
    df.createOrReplaceTempView(name)


def write_version(df: DataFrame, root: str, version: int) -> DataFrame:
    """Write a whole version of a table to a folder of its own and read it back.

    A version is named by the caller and never overwritten: writing it again fails, so a rewrite
    that broke off must be repeated under the next number, and readers keep what they read.
    """
    df.write.mode("errorifexists").parquet(f"{root}/v{version}")
    return read_version(df.sparkSession, root, version)


def read_version(spark: SparkSession, root: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{root}/v{version}")
