"""Message topics as streams and as a sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listmill.functions.jsontext import decode, encode
from listmill.schema import LISTING_MESSAGE


def topic_stream(
    spark: SparkSession, servers: str, topics: list[str], max_per_trigger: int | None = None, **options: str
) -> DataFrame:
    """Several topics from their earliest offset. Needs the Kafka connector on the class path."""
    reader = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics)).option("startingOffsets", "earliest").options(**options)
    )
    if max_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load()


def file_stream(
    spark: SparkSession, path: str, schema, form: str = "json", max_files: int | None = None, **options: str
) -> DataFrame:
    """New files of a folder as a stream; stands in for topics where there is no broker."""
    reader = spark.readStream.format(form).schema(schema).options(**options)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def decode_messages(stream: DataFrame, schema: T.StructType = LISTING_MESSAGE) -> DataFrame:
    """Payload columns plus ``topic`` and ``kafka_timestamp``; malformed payloads give nulls.

    Partition and offset go along where the source has them: they order messages of one time.
    """
    body = decode(F.col("value"), schema).alias("data")
    place = [F.col(c).alias(f"kafka_{c}") for c in ("partition", "offset") if c in stream.columns]
    return stream.select(body, "topic", F.col("timestamp").alias("kafka_timestamp"), *place).select(
        "data.*", "topic", "kafka_timestamp", *[f"kafka_{c}" for c in ("partition", "offset") if c in stream.columns]
    )


def raw_copy(stream: DataFrame) -> DataFrame:
    return stream.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def as_messages(df: DataFrame, topic: str = "topic", key: str | None = None) -> DataFrame:
    """Rows as ``(topic, key, value)`` with the row as JSON, nulls written out."""
    fields = [c for c in df.columns if c != topic]
    keyed = F.col(key).cast("string") if key else F.lit(None).cast("string")
    return df.select(F.col(topic).alias("topic"), keyed.alias("key"), encode(*fields).alias("value"))


def publish(messages: DataFrame, servers: str) -> None:
    """Write messages to their topics; the connector batches and retries per task."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).save()
