"""Intermediate tables in the folder that all executors share.

A job that needs an intermediate result more than once writes it as Parquet under ``spark.checkpoint.dir``,
so a lost executor costs the running tasks only. Large tables of a job are dropped as soon as nothing reads
them; what the returned DataFrame reads stays.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from reelgap.sources.shared import shared_dir


class Scratch:
    """Parquet tables of one job, in a folder of their own."""

    def __init__(self, spark: SparkSession, job: str) -> None:
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{job}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return it as read back, with its lineage cut."""
        df.write.mode("overwrite").option("compression", "zstd").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of plans that nobody refers to any more."""
    import gc

    gc.collect()
    spark._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
