"""Data checks between two versions of a table."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def diff_tables(
    old: DataFrame,
    new: DataFrame,
    key: Sequence[str],
    measures: Sequence[str],
    decimals: int = 0,
    failing: str | None = None,
) -> DataFrame:
    """Old and new value, rounded difference and OK/KO per measure, by key.

    With ``failing``, only rows where that measure is KO, smallest difference first.
    A null difference counts as OK.
    """
    a = old.select(*key, *[F.col(m).alias(f"{m}_OLD") for m in measures])
    b = new.select(*key, *[F.col(m).alias(f"{m}_NEW") for m in measures])
    out = a.join(b, list(key), "left")
    for_each = {}
    for m in measures:
        delta = F.round(F.col(f"{m}_OLD") - F.col(f"{m}_NEW"), decimals)
        for_each[f"DELTA_{m}"] = delta
        for_each[f"CHECK_{m}"] = F.when(delta != 0, "KO").otherwise("OK")
    out = out.withColumns(for_each)
    if failing is not None:
        out = out.where(F.col(f"CHECK_{failing}") == "KO").orderBy(f"DELTA_{failing}", *key)
    return out


def control_total(df: DataFrame, measure: str, name: str = "TOTALE") -> DataFrame:
    return df.agg(F.sum(measure).alias(name))


def assert_unique(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key counts that raise on a repeated key; run it to check a table's row key."""
    n = F.count(F.lit(1))
    message = F.raise_error(F.concat_ws(" ", F.lit("repeated key:"), *[F.col(k).cast("string") for k in key]))
    counts = df.groupBy(*key).agg(n.alias("n"))
    return counts.withColumn("n", F.when(F.col("n") > 1, message.cast("bigint")).otherwise(F.col("n")))


def row_digests(columns: Iterable[str]) -> tuple[Column, Column]:
    """Two independent 64-bit hashes of a row, whatever the order of its columns.

    Nulls are marked, and zeros of either sign are equal.
    """
    names = sorted(columns)
    values = [F.col(c) for c in names] + [F.isnull(c) for c in names]
    return F.xxhash64(*values), F.xxhash64(F.lit("second"), *values)
