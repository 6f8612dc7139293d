"""Tables written once in the shared folder of the cluster, to cut lineage and share results between consumers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Spark's own setting: shuffle files go when the execution that made them ends.
FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Writes tables under `spark.checkpoint.dir`, which all executors share.

    Without that setting a local master gets a temporary folder; a cluster without it is an error. With `free_shuffles`
    the shuffle files of a table's job are deleted once the table is written, as nothing reads them again.
    """

    def __init__(self, spark: SparkSession, free_shuffles: bool = False) -> None:
        self.spark = spark
        self.free_shuffles = free_shuffles
        base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
        if not base:
            if not spark.sparkContext.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            base = f"{tempfile.gettempdir()}/checkpoints"
        self.base = f"{base.rstrip('/')}/{uuid.uuid4().hex}"
        self.count = 0

    def keep(self, df: DataFrame) -> DataFrame:
        """The rows of `df`, computed once and read from a table from now on."""
        self.count += 1
        path = f"{self.base}/{self.count}"
        before = self.spark.conf.get(FREE)
        self.spark.conf.set(FREE, str(self.free_shuffles or before == "true").lower())
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.set(FREE, before)
        kept = self.spark.read.schema(df.schema).parquet(path)
        kept.scratch_path = path
        return kept

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables of `keep` that nothing reads any more."""
        jvm = self.spark.sparkContext._jvm
        for t in tables:
            path = jvm.org.apache.hadoop.fs.Path(t.scratch_path)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
