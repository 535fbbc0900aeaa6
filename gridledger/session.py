"""Session settings and the shared work folder for staged tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # DATE and TIMESTAMP columns are compared in UTC throughout.
    "spark.sql.session.timeZone": "UTC",
    # A third of all rows may share one key: let the optimizer split such
    # partitions at run time even when that costs one more exchange.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Packed sources stay one struct through the joins of wide rows.
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "false",
}


#: Removes a query's shuffle files when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time SQL settings the plans are written for."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


class Workspace:
    """Written, columnar intermediate tables that cut lineage.

    The folder is the one the cluster names in ``spark.checkpoint.dir``, else the one
    set by ``SparkContext.setCheckpointDir``; a session with neither raises. What is
    left in it goes when the session's JVM ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
        if not root:
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        self.path = f"{root.rstrip('/')}/gridledger-{uuid.uuid4().hex}"
        folder, files = self._folder()
        files.mkdirs(folder)
        files.deleteOnExit(folder)

    def _folder(self):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return folder, folder.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once and return a scan of it. Zstandard takes less disk than the default codec."""
        path = f"{self.path}/{name}"
        old = self.spark.conf.get(CLEANUP)
        # Nothing reads the shuffle files of a table once it is written; they would stay until a collection.
        self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        finally:
            self.spark.conf.set(CLEANUP, old)
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self, *names: str) -> None:
        """Remove staged tables that no later step reads."""
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
            self._folder()[1].delete(path, True)

    def drop(self) -> None:
        """Remove all staged tables once the final result has been written."""
        folder, files = self._folder()
        files.delete(folder, True)
