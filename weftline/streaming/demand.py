"""Monthly demand of a stream of lines, kept current by watermarked windows and versioned upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weftline.sources.sinks import upsert


def windowed(events: DataFrame, time: str = "ts", key: str = "event_type", value: str = "value", width: str = "1 day", late: str = "2 days") -> DataFrame:
    """Counts and sums by key and time window; rows later than `late` are dropped. Works on streams and tables."""
    timed = events.withColumn("_time", F.col(time).cast("timestamp")).withWatermark("_time", late)
    sums = timed.groupBy(F.window("_time", width), F.col(key).alias("key")).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return sums.select(F.col("window.start").alias("start"), "key", "n", "total")


def start_upsert(stream: DataFrame, path: str, checkpoint: str, key: tuple[str, ...] = ("start", "key")) -> StreamingQuery:
    """Each micro-batch becomes the next version of the table at `path`."""

    def merge(batch: DataFrame, number: int) -> None:
        upsert(batch.sparkSession, path, batch, number, key)

    return stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(merge).start()
