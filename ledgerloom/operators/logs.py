"""JSON log lines of different layouts brought into one shape."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Alternative field names, the level and logger given to a line that
# is not JSON, how much of such a line becomes the message, and the time format.
FIELDS = {
    "level": ["level", "levelStr"],
    "logger": ["logger", "loggerName"],
    "thread": ["thread", "threadName"],
    "message": ["message", "formattedMessage"],
}
BAD_LEVEL = "ERROR"
BAD_LOGGER = "etl.parser"
BAD_MESSAGE_CHARS = 8000
APP_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ssZ"

APP_RECORD = "ts string, level string, logger string, thread string, message string, __corrupt string"


def _first_present(df: DataFrame, names: list[str]) -> Column:
    present = [F.col(name).cast("string") for name in names if name in df.columns]
    return F.coalesce(*present) if present else F.lit(None).cast("string")


def read_engine_logs(spark: SparkSession, path: str, schema=None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def normalize_engine_logs(df: DataFrame, app: str, node: str) -> DataFrame:
    """ts, level, logger, thread, node, app, message and the whole record as JSON.

    Fields the records lack are skipped; records without a time are dropped.
    """
    times = []
    if "timestamp" in df.columns:
        times.append(F.try_to_timestamp(F.col("timestamp").cast("string")))
    if "timeMillis" in df.columns:
        times.append(F.timestamp_millis(F.col("timeMillis").cast("long")))
    ts = F.coalesce(*times) if times else F.lit(None).cast("timestamp")
    named = {name: _first_present(df, options).alias(name) for name, options in FIELDS.items()}
    return df.select(
        ts.alias("ts"),
        named["level"],
        named["logger"],
        named["thread"],
        F.lit(node).alias("node"),
        F.lit(app).alias("app"),
        named["message"],
        F.to_json(F.struct(*[F.col(f"`{name}`") for name in df.columns])).alias("kv"),
    ).filter("ts is not null")


def read_app_logs(spark: SparkSession, path: str, app: str, node: str) -> DataFrame:
    """JSON-lines application logs. A line that is not JSON is kept as an ERROR record."""
    return parse_app_lines(spark.read.text(path), app, node)


def parse_app_lines(lines: DataFrame, app: str, node: str) -> DataFrame:
    line = F.trim(F.col("value"))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__corrupt"}
    parsed = lines.select(line.alias("line")).filter("line <> ''").withColumn(
        "r", F.from_json("line", APP_RECORD, options)
    )
    bad = F.col("r.__corrupt").isNotNull()
    raw = F.to_json(F.struct(F.col("line").alias("raw")))
    return parsed.select(
        F.when(~bad, F.try_to_timestamp("r.ts", F.lit(APP_TIME_FORMAT))).alias("ts"),
        F.when(bad, BAD_LEVEL).otherwise(F.col("r.level")).alias("level"),
        F.when(bad, BAD_LOGGER).otherwise(F.col("r.logger")).alias("logger"),
        F.when(~bad, F.col("r.thread")).alias("thread"),
        F.lit(node).alias("node"),
        F.lit(app).alias("app"),
        F.when(bad, F.left("line", F.lit(BAD_MESSAGE_CHARS))).otherwise(F.col("r.message")).alias("message"),
        F.when(bad, raw).otherwise(F.col("line")).alias("kv"),
    )


def append_records(records: DataFrame, path: str, batch: str | None = None) -> int:
    """Append normalised records to a log table and return how many were written.

    Each call fills a batch folder of its own, so the count comes from the footers
    of the files just written. Writing a named batch again replaces it.
    """
    batch = batch or uuid.uuid4().hex
    marked = records.withColumn("batch", F.lit(batch))
    (
        marked.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch")
        .parquet(path)
    )
    table = records.sparkSession.read.schema(marked.schema).parquet(path)
    return table.filter(F.col("batch") == batch).count()
