"""Where intermediate tables live, and how large a group one task may hold."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can read, named by spark.checkpoint.dir."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="ledgerloom-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once as a shared table and read it back.

    Unlike a cache, the copy outlives a lost executor, and values that depend
    on the physical layout (such as partition ids) become plain data.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    staged.staged_at = path
    return staged


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate data."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def unstage(*tables: DataFrame) -> None:
    """Delete tables made by `stage` that nothing reads any more."""
    for table in tables:
        discard(table.sparkSession, table.staged_at)


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Keep all shuffle partitions: few rows with much arithmetic each would
    otherwise be merged into one task. Hashing the columns once more keeps this
    apart from the partitioning the rows already have.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, F.xxhash64(*columns))
