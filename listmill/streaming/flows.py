"""Streaming flows: raw lake, cleaned served tables, duplicate suppression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from listmill.operators.records import with_ingest_date
from listmill.operators.routing import by_topic
from listmill.sources.tables import append_versions, write_batch


def _trigger(writer, once: bool):
    return writer.trigger(availableNow=True) if once else writer


def append_lake(stream: DataFrame, path: str, checkpoint: str, moment: Column, once: bool = False) -> StreamingQuery:
    """Append raw rows to Parquet, partitioned by topic and ingest day."""
    rows = with_ingest_date(stream, moment)
    writer = (
        rows.writeStream.format("parquet").outputMode("append").partitionBy("topic", "year", "month", "day")
        .option("path", path).option("checkpointLocation", checkpoint)
    )
    return _trigger(writer, once).start()


def publish_stream(
    stream: DataFrame, clean: Callable[[DataFrame], DataFrame], served: str, lake: str, checkpoint: str,
    moment: Column, once: bool = False,
) -> StreamingQuery:
    """Lake and served tables from one reading of the source.

    Each micro-batch is read once, written raw, then cleaned and upserted into all tables in a single write. A repeated
    batch replaces its own folders as a whole, also on another day, so a restart neither loses nor doubles rows.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            write_batch(with_ingest_date(batch, moment), lake, number, "topic", "year", "month", "day")
            append_versions(by_topic(clean(batch)), served, "id", number)
        finally:
            batch.unpersist()

    return _trigger(stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint), once).start()


def debug_stream(stream: DataFrame, form: str = "console", name: str | None = None, once: bool = False) -> StreamingQuery:
    writer = stream.writeStream.format(form).outputMode("append")
    if name:
        writer = writer.queryName(name)
    return _trigger(writer, once).start()


def suppress_repeats(stream: DataFrame, keys: list[str], event_time: str, delay: str) -> DataFrame:
    """Drop repeats of a key within ``delay``; the state holds no key for longer."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def run_until_any_ends(spark: SparkSession) -> None:
    """Block until one query ends, then stop the others and hand on its error."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for query in spark.streams.active:
            query.stop()
