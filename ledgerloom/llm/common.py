"""What the corpus operators share: reading, staging, words and Arrow helpers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.runtime import stage  # noqa: F401

Query = Callable[[SparkSession, str], DataFrame]

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def texts(docs: DataFrame, *extra: str) -> DataFrame:
    """doc_id, text (null: empty) and the named columns; other columns stay out of the way."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *extra)


def as_bytes(column: str = "text") -> Column:
    return F.col(column).cast("binary").alias(column)


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that `column` has about `limit` bytes in each (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        slot = np.cumsum(size, dtype=np.int64) // limit
        cuts = np.flatnonzero(np.diff(slot)) + 1
        for start, stop in zip([0, *cuts], [*cuts, batch.num_rows]):
            if stop > start:
                yield batch.slice(start, stop - start)


def list_array(offsets: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))
