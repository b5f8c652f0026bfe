"""Structured Streaming jobs over a folder of event files.

Every job takes an events stream (``user_id, event_type, ts, value, event_id``) and returns a
started query that stops when the available input is read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from shelfrank.sources.served import ServedTable

# Executors need no copy of this package: its functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FILE_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def events_stream(spark: SparkSession, folder: str, glob: str = "events*.parquet") -> DataFrame:
    """Event files as a stream. Watermarks need a zoned timestamp, hence the cast."""
    stream = spark.readStream.schema(FILE_SCHEMA).option("pathGlobFilter", glob).parquet(folder)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def popularity(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Running count, positive share and value per event type; the served table is replaced per batch."""
    totals = stream.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.sum(F.when(F.col("event_type") == "purchase", F.col("value")).otherwise(0.0)).alias("revenue"),
    )
    return (
        totals.writeStream.outputMode("complete")
        .foreachBatch(lambda batch, number: ServedTable(batch.sparkSession, target, ["event_type"]).replace(batch, number))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def latest_popularity(spark: SparkSession, target: str) -> DataFrame:
    return ServedTable(spark, target, ["event_type"]).read()


def windowed(stream: DataFrame, width: str = "1 day", delay: str = "1 day") -> DataFrame:
    """Counts and values per tumbling window and event type; later rows are dropped."""
    return (
        stream.withWatermark("ts", delay)
        .groupBy(F.window("ts", width).alias("w"), "event_type")
        .agg(F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("total_value"))
        .select(F.col("w.start").alias("window_start"), "event_type", "n_events", "total_value")
    )


WINDOW_KEYS = ["window_start", "event_type"]


def window_metrics(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Windows in update mode: every batch adds its changed rows to a served table."""
    return (
        windowed(stream)
        .writeStream.outputMode("update")
        .foreachBatch(lambda batch, number: ServedTable(batch.sparkSession, target, WINDOW_KEYS).upsert(batch, number))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def latest_windows(spark: SparkSession, target: str) -> DataFrame:
    return ServedTable(spark, target, WINDOW_KEYS).read()


def append_log(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Events appended to a log partitioned by batch, exactly once: a batch that runs again
    replaces its own partition and nothing else."""

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumn("iter", F.lit(str(batch_id)))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("iter")
            .parquet(target)
        )

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


LAST_N_OUT = "user_id long, events array<string>, deleted boolean"
RECENT = "ts_us long, event_type string"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def _in_time(row: tuple) -> tuple:
    """Order of kept events: time, then type; a missing type first."""
    return row[0], row[1] is not None, row[1] or ""


class LastEvents(StatefulProcessor):
    """The last ``n`` events of a user as a list in the state store, never more than ``n`` entries.

    With ``idle_ms`` a timer removes users once the watermark is that far past their newest event.
    """

    def __init__(self, n: int, idle_ms: int | None = None):
        self.n, self.idle_ms = n, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.recent = handle.getListState("recent", RECENT)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        kept = [tuple(row) for row in self.recent.get()] if self.recent.exists() else []
        before = kept[-1][0] if kept else None
        # Arrow hands a large group over in pieces; only n entries are ever kept.
        for frame in rows:
            new = zip(frame["ts_us"].tolist(), frame["event_type"].tolist(), strict=True)
            kept = sorted([*kept, *new], key=_in_time)[-self.n :]
        self.recent.put(kept)
        if self.idle_ms is not None and kept[-1][0] != before:
            if before is not None:
                self.handle.deleteTimer(before // 1000 + self.idle_ms)
            self.handle.registerTimer(kept[-1][0] // 1000 + self.idle_ms)
        yield pd.DataFrame({"user_id": [key[0]], "events": [[e for _, e in kept]], "deleted": [False]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.recent.clear()
        yield pd.DataFrame({"user_id": [key[0]], "events": [[]], "deleted": [True]})

    def close(self) -> None:
        pass


def last_n_events(
    stream: DataFrame, n: int, target: str, checkpoint: str, idle: timedelta | None = None, delay: str = "1 day"
) -> StreamingQuery:
    """The last ``n`` event types of each user as keyed state of at most ``n`` entries, in RocksDB.

    Late events take their place in time order. With ``idle``, users whose newest event lies that far
    behind the watermark (``delay`` behind the newest event of all) leave the state and the served table, and events
    behind the watermark are dropped. Events without a time take no part.
    """
    timed = stream.where(F.col("ts").isNotNull())
    if idle is not None:
        timed = timed.withWatermark("ts", delay)
    slim = timed.select("user_id", "ts", F.unix_micros("ts").alias("ts_us"), "event_type")
    idle_ms = None if idle is None else int(idle.total_seconds() * 1000)
    spark = stream.sparkSession
    before = spark.conf.get(PROVIDER, None)
    # The setting is read when the query starts.
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        states = slim.groupBy("user_id").transformWithStateInPandas(
            LastEvents(n, idle_ms), LAST_N_OUT, "Update", "None" if idle is None else "EventTime"
        )
        return (
            states.writeStream.outputMode("update")
            .foreachBatch(lambda batch, number: ServedTable(batch.sparkSession, target, ["user_id"]).upsert(batch, number))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def latest_states(spark: SparkSession, target: str) -> DataFrame:
    return ServedTable(spark, target, ["user_id"]).read()
