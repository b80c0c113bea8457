"""Events without repetitions and sessions by inactivity, as streams over event files.

State is bounded by time: an event id is remembered for as long as ``lateness`` allows a repetition,
and a session until the watermark has passed its end. Events later than that are left out. A run
with ``available_now`` reads what has arrived since the last one and stops; sessions that may still
go on stay in the state, which is kept with the offsets under ``checkpoint``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartlens.schemas import EVENTS

LATENESS = "1 hour"
#: Seconds without an event after which the next one opens a session.
TIMEOUT = 1800


def event_stream(
    spark: SparkSession, folder: str, schema: T.StructType = EVENTS, files_per_batch: int | None = 1000
) -> DataFrame:
    """The files ``events_*.parquet`` of a folder, oldest first.

    The watermark moves between batches, so files of the same time belong in one; with None all that
    a run finds are one batch.
    """
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{folder}/events_*.parquet")


def deduplicated(events: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """The first of each event id, as long as repetitions come within ``lateness``.

    Rows without id, user or time are left out, as staging does. The time of the stream is
    ``moment``, with the session's zone, because watermarks need one.
    """
    usable = events.filter("event_id is not null and user_id is not null and timestamp is not null")
    timed = usable.withColumn("moment", F.col("timestamp").cast("timestamp"))
    return timed.withWatermark("moment", lateness).dropDuplicatesWithinWatermark(["event_id"])


def closed_sessions(events: DataFrame, timeout: int = TIMEOUT) -> DataFrame:
    """user_id, session_start, session_end, event_count of sessions that nothing can extend any more.

    ``events`` has a watermark on ``moment``. An event that follows the last one by ``timeout`` seconds
    or more opens a session.
    """
    # Spark joins windows that touch, so an event exactly at the timeout must not reach the last one
    gap = f"{timeout * 1_000_000 - 1} microseconds"
    return (
        events.groupBy("user_id", F.session_window("moment", gap).alias("window"))
        .agg(
            F.min("moment").cast("timestamp_ntz").alias("session_start"),
            F.max("moment").cast("timestamp_ntz").alias("session_end"),
            F.count(F.lit(1)).alias("event_count"),
        )
        .drop("window")
    )


def run_available(stream: DataFrame, target: str, checkpoint: str) -> DataFrame:
    """Append what has arrived to the Parquet files of ``target``; returns all of them."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    # the sink's own list of complete files is read, not the folder
    return stream.sparkSession.read.schema(stream.schema).parquet(target)
