"""The sample tables as keyspaces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed(df: DataFrame, prefix: str, key: str) -> DataFrame:
    """Typed fields under _key = prefix:key."""
    return df.withColumn("_key", F.concat(F.lit(f"{prefix}:"), F.col(key).cast("string")))


def hashes(df: DataFrame, prefix: str, key: str) -> DataFrame:
    """Fields as text, as a keyspace stores them."""
    return df.select(F.concat(F.lit(f"{prefix}:"), F.col(key).cast("string")).alias("_key"), *(F.col(c).cast("string").alias(c) for c in df.columns))


def millis(ts: str) -> F.Column:
    """Epoch milliseconds of a timestamp without zone, whatever the session's zone is."""
    return F.floor(F.unix_micros(F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col(ts)).cast("timestamp")) / 1000).cast("long")


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as logs: a stream for each user, entry id = epoch ms - event id."""
    e = table(spark, sf_dir, "events")
    return e.select(F.concat(F.lit("user:"), F.col("user_id").cast("string")).alias("_key"), millis("ts").alias("ms"), F.col("event_id").alias("seq"), "event_type", F.col("value").cast("string").alias("value"), "props")


def event_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as time series: one for each user."""
    e = table(spark, sf_dir, "events")
    return e.select(F.concat(F.lit("ts:"), F.col("user_id").cast("string")).alias("_key"), millis("ts").alias("ts"), "value")


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """suppliers as a geo set, at coordinates made from their keys."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return s.select(F.concat(F.lit("supplier:"), k.cast("string")).alias("member"), ((k * 37 % 3600) / 10.0 - 180.0).alias("lon"), ((k * 53 % 1700) / 10.0 - 85.0).alias("lat"))
