"""Stored steps of one operator in the shared folder, and the disk that finished steps still hold."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

from textloom.session import shared_folder


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with underscores behind it until no column of `df` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


class Steps:
    """Tables of an operator's run, each written once; a step that nothing reads any more is dropped."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"

    def store(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.root}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def drop(self, *names: str) -> None:
        """Delete stored steps, and let Spark clean the shuffle files of plans that are out of use.

        Spark cleans them when the driver's garbage collector finds the plans, which may be long after.
        """
        jvm = self.spark.sparkContext._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        gc.collect()
        jvm.System.gc()
