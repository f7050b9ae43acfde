"""Intermediate tables in the folder that driver and executors share.

A written table cuts lineage: after the loss of an executor its rows are read
again, not computed again.  The folder is ``spark.checkpoint.dir``; only where
that is unset (tests on one machine) a local one is made.  Tables are deleted
when the application ends.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    made = "file://" + tempfile.mkdtemp(prefix="tidewatch-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


class Scratch:
    """A folder of tables for one run of an operator."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.n = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}", 0
        path = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        self._fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        self._fs.deleteOnExit(path)

    def keep(self, frame: DataFrame, name: str = "t", partition_by: str | None = None) -> DataFrame:
        """Writes ``frame`` and reads it back."""
        self.n += 1
        path = f"{self.root}/{self.n}-{name}"
        frame.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(frame.schema).parquet(path)
        out.scratch_path = path
        return out

    def drop(self, kept: DataFrame) -> None:
        """Deletes a table that nothing reads any more."""
        self._fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(kept.scratch_path), True)
