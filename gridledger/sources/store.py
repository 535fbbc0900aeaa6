"""Reading and writing Parquet tables."""

from __future__ import annotations

import datetime as dt
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_table(
    spark: SparkSession, root: str, name: str, schema: StructType | str | None = None, suffix: str = ""
) -> DataFrame:
    """Scan a table; a given schema saves the reader from opening files to infer one."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{root.rstrip('/')}/{name}{suffix}")


def append_snapshot(df: DataFrame, path: str, as_of: dt.date, name: str = "DATA_LANCIO") -> None:
    """Add a run to the history, one folder per run date, columns aligned by name.

    Only the folder of the run date is replaced, so a run that is repeated has its rows once and
    other dates stay. A run without rows leaves what its date already has.
    """
    writer = df.withColumn(name, F.lit(as_of)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(name).parquet(path)


def rotate(root: str, name: str, run: str, previous: str) -> tuple[str, str]:
    """Paths of the version to write and of the version it replaces.

    A run writes a fresh folder and leaves the former one for comparison, so there
    is neither a copy of the old rows nor a delete.
    """
    base = f"{root.rstrip('/')}/{name}"
    return f"{base}/run={run}", f"{base}/run={previous}"


def reset_status(df: DataFrame, name: str = "STATO") -> DataFrame:
    return df.withColumn(name, F.when(F.col(name) == 1, F.lit(0)).otherwise(F.col(name)))
