"""Options of range-partitioned JDBC reads and batched JDBC writes.

Connection settings come from the caller; nothing is kept here.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def projection(table: str, columns: Mapping[str, str] | Sequence[str], alias: str = "t") -> str:
    """A SELECT list that the database evaluates, usable as `dbtable`."""
    if not isinstance(columns, Mapping):
        columns = {name: name for name in columns}
    listed = ", ".join(new if new == old else f"{old} AS {new}" for new, old in columns.items())
    return f"(SELECT {listed} FROM {table}) {alias}"


def read_options(
    url: str,
    table: str,
    key: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **(extra or {})}
    if key is not None:
        if bounds is None:
            raise ValueError("a partitioned read needs the bounds of its key")
        low, high = bounds
        # Spark wants lower < upper; the upper end is exclusive for the stride only
        options.update(
            partitionColumn=key,
            lowerBound=str(low),
            upperBound=str(max(high, low + 1)),
            numPartitions=str(partitions),
        )
    return options


def write_options(
    url: str, table: str, truncate: bool = True, batch_size: int = 10_000, extra: Mapping[str, str] | None = None
) -> dict[str, str]:
    return {
        "url": url,
        "dbtable": table,
        "truncate": str(truncate).lower(),
        "batchsize": str(batch_size),
        "reWriteBatchedInserts": "true",
        **(extra or {}),
    }


def read_table(spark: SparkSession, **settings) -> DataFrame:
    return spark.read.format("jdbc").options(**read_options(**settings)).load()


def write_table(df: DataFrame, mode: str = "overwrite", **settings) -> None:
    df.write.format("jdbc").options(**write_options(**settings)).mode(mode).save()


def key_bounds(df: DataFrame, key: str) -> tuple[int, int]:
    """Bounds of a key for `read_options`, measured instead of guessed."""
    row = df.agg(F.min(key).cast("long"), F.max(key).cast("long")).first()
    if row[0] is None:
        raise ValueError(f"no value of {key} to take bounds from")
    return row[0], row[1]
