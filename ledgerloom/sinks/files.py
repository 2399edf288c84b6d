"""File sinks: CSV, partitioned Parquet, laid-out Parquet, single-partition overwrite."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.ordered import running


def write_csv(df: DataFrame, path: str) -> None:
    """Headed CSV that `sources.files.load_csv` reads back."""
    df.write.mode("overwrite").options(header=True, quote='"', escape='"').csv(path)


def write_partitioned(df: DataFrame, path: str, columns: Sequence[str], mode: str = "overwrite") -> None:
    """One folder per value of the partition columns.

    Rebalancing gathers each value in few tasks and splits a value that is too
    large for one.
    """
    df.hint("rebalance", *columns).write.mode(mode).partitionBy(*columns).parquet(path)


def write_layout(
    df: DataFrame,
    path: str,
    partition: str,
    sort: Sequence[str],
    max_records: int = 1_000_000,
    compression: str = "snappy",
) -> None:
    """Partitioned Parquet sorted inside each task, with bounded file sizes."""
    (
        df.hint("rebalance", partition)
        .sortWithinPartitions(partition, *sort)
        .write.mode("overwrite")
        .partitionBy(partition)
        .option("compression", compression)
        .option("maxRecordsPerFile", max_records)
        .parquet(path)
    )


def overwrite_partitions(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Replace only the partitions that occur in `df`."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def with_surrogate_key(df: DataFrame, order: Sequence[str], name: str = "id", existing: str | None = None) -> DataFrame:
    """Sequential key 1..n in the given order, without sorting everything in one task.

    With `existing`, rows that have a key keep it and the others continue after
    the largest one.
    """
    if existing is None:
        return running(df, [], order, rank=name)
    missing = F.col(existing).isNull()
    ranked = running(df.withColumn("__has", ~missing), [], ["__has", *order], rank="__rank")
    top = df.agg(F.coalesce(F.max(existing), F.lit(0))).scalar()
    return ranked.withColumn(existing, F.coalesce(F.col(existing), top + F.col("__rank"))).select(*df.columns)
