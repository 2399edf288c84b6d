"""The tumbling-window aggregate over a stream of transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.operators.timeseries import pair_windows
from ledgerloom.runtime import fresh_path


def stream_pair_windows(stream: DataFrame, width: str, delay: str = "1 hour") -> DataFrame:
    """Windows per directed pair; a window is emitted once the watermark has passed it."""
    timed = stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    return pair_windows(timed, width)


def write_windows(windows: DataFrame, path: str, checkpoint: str | None = None) -> StreamingQuery:
    """Append finished windows to Parquet, processing what is available and stopping.

    Pass the same `checkpoint` folder again to go on where the last run ended.
    """
    return (
        windows.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint or fresh_path(windows.sparkSession, "stream-state"))
        .trigger(availableNow=True)
        .format("parquet")
        .start(path)
    )
