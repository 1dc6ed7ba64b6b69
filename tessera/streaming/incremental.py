"""Records as a stream: landed or polled, older versions skipped, merged into the tables batch by batch.

This extends the batch plan; it has the same rules for what is new (latest wins, older versions are skipped). :func:`unseen`
keeps the last version of each key as state (RocksDB), so that a batch costs what it brings and never a join with the store.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import timedelta
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tessera.operators.records import latest

RECORD = "key string, fields string, attachments array<struct<id:string,filename:string,content:string,mimeType:string,size:bigint,created:string>>"


ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def versions(rows: DataFrame) -> DataFrame:
    """Records with the timestamp of their version, null where it can't be read."""
    return rows.withColumn("updated", F.try_to_timestamp(F.get_json_object("fields", "$.updated")))


def landed(spark: SparkSession, path: str, watermark: str = "1 day", files: int = 100) -> DataFrame:
    """New files of a folder as (key, fields, attachments, updated); a version that came before isn't given again."""
    rows = versions(spark.readStream.schema(RECORD).option("maxFilesPerTrigger", files).json(path))
    rows = rows.withColumn("updated", F.coalesce("updated", F.lit("1970-01-01 00:00:00").cast("timestamp")))
    return rows.withWatermark("updated", watermark).dropDuplicatesWithinWatermark(["key", "updated"])


class Newer(StatefulProcessor):
    """Gives, of a key's rows in a batch, the newest if it is newer than the last one given.

    Rows without a version are always given: nothing tells that they were seen. A key that brings nothing for ``idle`` after
    its last arrival is forgotten, by a timer that each of its batches moves on.
    """

    def __init__(self, idle: timedelta, names: list[str]):
        self.idle, self.names = int(idle.total_seconds() * 1000), names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "version long, timer long")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        known, timer = self.last.get() if self.last.exists() else (None, None)
        best, arrived = None, None
        for row in rows:
            arrived = row["_arrived_ms"]
            if row["_version"] is None:
                yield self._given(row)
            elif known is None or row["_version"] > known:
                best, known = row, row["_version"]
        if known is not None and arrived is not None:
            if timer is not None:
                self.handle.deleteTimer(timer)
            timer = arrived + self.idle
            self.last.update((known, timer))
            self.handle.registerTimer(timer)
        if best is not None:
            yield self._given(best)

    def _given(self, row: Row) -> Row:
        return Row(**{n: row[n] for n in self.names})

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def unseen(stream: DataFrame, idle: timedelta = timedelta(days=90), delay: str = "1 minute") -> DataFrame:
    """Rows (key, updated, ...) of a stream that are newer than all that came before for their key, one a key and batch.

    The stream's clock is the arrival of rows, never their version: an old record that comes for the first time isn't late. A null
    key is a key of its own. State needs RocksDB, which this sets for the session.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    arriving = stream.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", delay)
    # numbers, as timestamps come to Python with or without a zone
    arriving = arriving.withColumns({"_arrived_ms": F.unix_millis("_arrived"), "_version": F.unix_micros("updated")})
    return arriving.groupBy("key").transformWithState(statefulProcessor=Newer(idle, stream.columns), outputStructType=stream.schema, outputMode="Append", timeMode="EventTime")


def run(stream: DataFrame, process: Callable[[DataFrame], None], checkpoint: str, once: bool = False) -> StreamingQuery:
    """Hands the latest version of each key of every batch to ``process``, which must bear being run again."""

    def each(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            process(latest(batch, ["key"], ["updated"]))

    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer).start()


def event_rates(events: DataFrame, window: str = "1 hour", watermark: str = "2 hours") -> DataFrame:
    """Events (ts, event_type) counted by window and type; late ones beyond the watermark are left out."""
    rows = events.withWatermark("ts", watermark) if events.isStreaming else events
    return rows.groupBy(F.window("ts", window).alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")
