"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Only a local session, whose executors are one process, may do without one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "/tmp/checkpoints"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


class Scratch:
    """Tables that one piece of work writes and reads again; drop() deletes them all."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.n = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}", 0

    def put(self, df: DataFrame) -> DataFrame:
        """Write and read back: whatever is lost later, nothing is worked out again."""
        self.n += 1
        path = f"{self.root}/{self.n}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.root)
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
