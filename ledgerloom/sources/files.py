"""File scans: delimited text, Parquet with date pruning, JSON lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.functions.text import normalize_columns


def load_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    partitions: int | None = None,
    max_field_chars: int | None = None,
) -> DataFrame:
    """Headed CSV with doubled quotes, empty fields as NULL and snake_case columns.

    Pass a schema where it is known: without one the file is read twice.
    """
    reader = spark.read.options(
        header=True, quote='"', escape='"', nullValue="", mode="PERMISSIVE"
    )
    if max_field_chars is not None:
        reader = reader.option("maxCharsPerColumn", max_field_chars)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    df = normalize_columns(reader.csv(path))
    return df.repartition(partitions) if partitions else df


def load_transfers(
    spark: SparkSession,
    path: str,
    start: str | None = None,
    end: str | None = None,
    columns: Sequence[str] | None = None,
    flagged_only: bool = False,
) -> DataFrame:
    """Transfers of an inclusive date range from a table partitioned by event_year and event_month.

    The range is also put as a bound on the partition columns, so folders outside
    it are never listed for reading.
    """
    df = spark.read.parquet(path)
    month = F.col("event_year") * 12 + F.col("event_month")
    for limit, compare in ((start, "__ge__"), (end, "__le__")):
        if limit:
            year, number = (int(part) for part in limit.split("-")[:2])
            day = F.lit(limit).cast("date")
            df = df.filter(getattr(month, compare)(F.lit(year * 12 + number)))
            df = df.filter(getattr(F.col("event_date"), compare)(day))
    if flagged_only:
        df = df.filter("is_laundering = 1")
    return df.select(*columns) if columns else df


def stored_bytes(df: DataFrame) -> DataFrame:
    """Size on disk of the files behind a file-based scan."""
    files = df.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"))
    return files.distinct().agg(F.count("*").alias("n_files"), F.sum("size").alias("total_bytes"))
