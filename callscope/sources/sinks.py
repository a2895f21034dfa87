"""Sinks: event bodies (K1) and feedback bodies (K2) as JSON lines.

Bodies are written as text partitioned by event day into the given folder
(on a cluster, a shared file system). Spark's file commit protocol makes
each write all-or-nothing, so a lost executor only reruns its task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callscope.operators.events import event_body
from callscope.operators.feedback import feedback_body


def event_bodies(events: DataFrame) -> DataFrame:
    """K1: (call_id, event_day, body) with one JSON object per event."""
    return events.select("call_id", F.to_date("started_at").cast("string").alias("event_day"),
                         event_body(events).alias("body"))


def write_event_bodies(events: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K1: JSON lines under `path/event_day=YYYY-MM-DD/` (undated events
    under `event_day=__HIVE_DEFAULT_PARTITION__`)."""
    (event_bodies(events).select("event_day", F.concat_ws("\t", "call_id", "body").alias("value"))
     .write.mode(mode).partitionBy("event_day").text(path))


def read_event_bodies(spark, path: str) -> DataFrame:
    t = spark.read.text(path)
    parts = F.split(F.col("value"), "\t", 2)
    return t.select(parts[0].alias("call_id"), parts[1].alias("body"))


def write_feedback_bodies(feedback: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K2: feedback bodies with the wire names, one JSON object per line."""
    feedback.select(feedback_body(feedback).alias("value")).write.mode(mode).text(path)


def stream_event_bodies(events: DataFrame, path: str, checkpoint: str, available_now: bool = True):
    """K1 on a stream: the same bodies through a checkpointed file sink
    (exactly once), partitioned by event day. Returns the started query."""
    rows = event_bodies(events).select("event_day", F.concat_ws("\t", "call_id", "body").alias("value"))
    w = (rows.writeStream.format("text").partitionBy("event_day").outputMode("append")
         .option("checkpointLocation", checkpoint).option("path", path))
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()
