"""Keyed upserts of nodes and edges against an existing snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.runtime import stage, unstage
from ledgerloom.sinks.files import overwrite_partitions, write_partitioned

BUCKET = "__bucket"


def latest(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The last row per key by the given order."""
    whole = F.max_by(F.struct(*df.columns), F.struct(*order))
    return df.groupBy(F.col(key).alias("__key")).agg(whole.alias("row")).select("row.*")


def merge_nodes(existing: DataFrame, incoming: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Existing nodes with the properties of incoming ones set, plus the new nodes.

    Properties that only the existing nodes have are kept.
    """
    newest = latest(incoming, key, order).withColumn("__new", F.lit(True))
    renamed = newest.withColumnsRenamed({name: f"__i_{name}" for name in incoming.columns})
    joined = existing.join(renamed, F.col(key) == F.col(f"__i_{key}"), "full")
    columns = [F.coalesce(F.col(key), F.col(f"__i_{key}")).alias(key)]
    for name in dict.fromkeys([*existing.columns, *incoming.columns]):
        if name == key:
            continue
        if name not in incoming.columns:
            columns.append(F.col(name))
        elif name not in existing.columns:
            columns.append(F.col(f"__i_{name}").alias(name))
        else:
            columns.append(F.when(F.col("__new"), F.col(f"__i_{name}")).otherwise(F.col(name)).alias(name))
    return joined.select(*columns)


def _bucketed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int"))


def create_snapshot(nodes: DataFrame, path: str, key: str, buckets: int = 64) -> None:
    """A snapshot of nodes with one folder for each bucket of keys."""
    write_partitioned(_bucketed(nodes, key, buckets), path, [BUCKET])


def read_snapshot(spark, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(path).drop(BUCKET)


def upsert_snapshot(incoming: DataFrame, path: str, key: str, order: Sequence[str], buckets: int = 64) -> None:
    """`merge_nodes` into a stored snapshot, writing only the buckets that incoming keys fall into.

    The key is hashed as text, so a batch with another integer width meets the
    same buckets. Properties new to the snapshot are absent from the files of
    other buckets and read as null there. Without order columns of its own, the
    snapshot keeps those of the last batch out.
    """
    spark = incoming.sparkSession
    batch = stage(_bucketed(incoming, key, buckets), "upsert-batch")
    touched = [r[BUCKET] for r in batch.select(BUCKET).distinct().collect()]  # no more than `buckets`
    existing = spark.read.option("mergeSchema", True).parquet(path)
    mine = existing.filter(F.col(BUCKET).isin(touched)).drop(BUCKET)
    merged = merge_nodes(mine, batch.drop(BUCKET), key, order).drop(*[c for c in order if c not in existing.columns])
    merged = stage(_bucketed(merged, key, buckets), "upsert-merged")
    overwrite_partitions(merged.hint("rebalance", BUCKET), path, [BUCKET])
    unstage(batch, merged)


def match_edges(
    edges: DataFrame, nodes: DataFrame, order: Sequence[str], properties: Sequence[str], key: str = "id"
) -> DataFrame:
    """Edges whose both end points exist, last one per key, with the listed properties."""
    known = nodes.select("account_number").distinct()
    matched = edges.join(known, F.col("src") == F.col("account_number"), "left_semi").join(
        known, F.col("dst") == F.col("account_number"), "left_semi"
    )
    return latest(matched, key, order).select(key, "src", "dst", *[name for name in properties if name in edges.columns])
