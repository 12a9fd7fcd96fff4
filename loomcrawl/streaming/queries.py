"""Queries that run a stream to its end and read what it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcrawl.operators.scratch import scratch_path
from loomcrawl.streaming.entities import windowed_counts


def stream_event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by type in windows of six hours, from a stream of the table's files; windows the watermark has not passed are still open."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/events.parquet*")
    timed = events.select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    counts = windowed_counts(timed, "ts", "event_type", "6 hours", "1 hour")
    out, state = scratch_path(spark, "windows"), scratch_path(spark, "windows-state")
    q = counts.select(F.col("window.start").alias("start"), "event_type", "n").writeStream.format("parquet").option("path", out).option("checkpointLocation", state).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema("start timestamp, event_type string, n long").parquet(out)


QUERIES = {"stream_event_windows": stream_event_windows}
ORACLE_SQL = {
    "stream_event_windows": """select time_bucket(interval 6 hours, ts, timestamp '2000-01-01') as start, event_type, count(*) as n from events
        group by 1, 2 having time_bucket(interval 6 hours, any_value(ts), timestamp '2000-01-01') + interval 6 hours <= (select max(ts) from events) - interval 1 hour""",
}
