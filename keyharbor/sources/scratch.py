"""Tables that a job writes on its way: in the folder that the driver and all executors see."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Only where a local session names no spark.checkpoint.dir (tests, a laptop).
LOCAL_FALLBACK = "/tmp/checkpoints/keyharbor"


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. Without one, a local session takes LOCAL_FALLBACK; a cluster has no folder to guess, so there it is an error."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir names no folder: on a cluster it has to, and all executors have to see it")
    return LOCAL_FALLBACK


def run_dir(spark: SparkSession) -> str:
    """The folder of this application's tables, below the shared one."""
    return f"{shared_dir(spark)}/tables/{spark.sparkContext.applicationId}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: computed once, lineage cut, safe when executors go."""
    spark = df.sparkSession
    path = f"{run_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def deleted(spark: SparkSession, path: str) -> None:
    """Deletes a folder, wherever Spark reads it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def purge(spark: SparkSession) -> None:
    """Deletes the tables that this application wrote: for when its results are saved. Those of other runs stay."""
    deleted(spark, run_dir(spark))
