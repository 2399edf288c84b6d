"""Bucketed export that can be resumed: finished buckets are rows of a manifest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.hashing import hash_bucket

MANIFEST = "bucket int, rows long"


def with_bucket(df: DataFrame, key: str, buckets: int, bucket: Column | None = None) -> DataFrame:
    return df.withColumn("bucket", hash_bucket(key, buckets) if bucket is None else bucket)


def bucket_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("bucket").agg(F.count("*").alias("rows"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(MANIFEST).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def pending_buckets(sizes: DataFrame, manifest: DataFrame) -> DataFrame:
    return sizes.join(manifest.select("bucket"), "bucket", "left_anti")


def export_buckets(
    df: DataFrame, path: str, manifest_path: str, sort: Sequence[str] = (), at_once: int = 8
) -> DataFrame:
    """Write the buckets the manifest does not list, sorted inside each file, and list them.

    `at_once` buckets are written by a job and listed when their files are
    committed, with counts read from those files. If a job dies, earlier buckets
    stay listed and the next run replaces what the dead one left behind.
    """
    spark = df.sparkSession
    listed = {row["bucket"] for row in read_manifest(spark, manifest_path).select("bucket").distinct().collect()}
    todo = sorted(row[0] for row in df.select("bucket").distinct().collect() if row[0] not in listed)
    done = []
    for start in range(0, len(todo), at_once):
        batch = todo[start : start + at_once]
        (
            df.filter(F.col("bucket").isin(batch))
            .hint("rebalance", "bucket")
            .sortWithinPartitions("bucket", *sort)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("bucket")
            .parquet(path)
        )
        stored = spark.read.schema(df.schema).parquet(path).filter(F.col("bucket").isin(batch))
        rows = [(row["bucket"], row["rows"]) for row in bucket_sizes(stored).collect()]
        spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(manifest_path)
        done += rows
    return spark.createDataFrame(done, MANIFEST)
