"""Served tables on plain Parquet: partitioned by table, written per partition, upserted by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listmill.operators.records import first_per_key, typed
from listmill.session import fresh_dir


# Where a row stands in its source, the most telling first: message time, then partition and offset.
ARRIVAL = ("kafka_timestamp", "kafka_offset", "kafka_partition")


def newest_first(df: DataFrame, version: str = "created_at") -> list:
    """Order in which the last version of a key comes first; versions of one stamp go by their arrival."""
    return [F.col(c).desc_nulls_last() for c in (version, *ARRIVAL) if c in df.columns]


def write_by_category(df: DataFrame, path: str, key: str = "id", table: str = "table", version: str = "created_at") -> None:
    """Keyed batch write: the last version per key, replacing only the tables present in ``df``."""
    rows = first_per_key(df, [table, key], *newest_first(df, version))
    (
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(table).parquet(path)
    )


def write_typed(df: DataFrame, path: str, partition_by: list[str] | None = None, key: str | None = None) -> None:
    """Typed document load: columns cast to the served types.

    With ``key`` the last version of each key is the document; rows without a key are documents of their own.
    """
    if key:
        last = first_per_key(df.where(F.col(key).isNotNull()), [key], *newest_first(df))
        df = last.unionByName(df.where(F.col(key).isNull()))
    writer = typed(df).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_crawl_files(df: DataFrame, root: str) -> None:
    """Crawl output as JSON lines, one folder per province slug and category."""
    df.write.mode("overwrite").partitionBy("slug", "category").json(root)


def append_versions(df: DataFrame, path: str, key: str, batch: int) -> None:
    """Keyed upsert as one immutable folder per batch: last row per key, rewritten whole when a batch is repeated.

    All rows of a batch have its stamp, so the last row is that of the last message: by message time, offset, partition.
    Nothing already written is read or moved, so the cost of an upsert is the size of the batch. Readers take the
    newest version per key (:func:`read_latest`); :func:`compact` folds the folders from time to time.
    """
    rows = first_per_key(df, ["table", key], *newest_first(df))
    write_batch(rows, path, batch, "table")


def write_batch(df: DataFrame, path: str, batch: int, *partition_by: str) -> None:
    """The folder of a batch, replaced as a whole, whichever partitions an earlier attempt left in it."""
    (
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition_by)
        .parquet(f"{path}/batch={batch}")
    )


def read_latest(spark: SparkSession, path: str, key: str = "id") -> DataFrame:
    """The newest version of each key over all batches."""
    rows = spark.read.parquet(path)
    return first_per_key(
        rows, ["table", key], F.col("created_at").desc_nulls_last(), F.desc("batch")
    ).drop("batch")


def compact(spark: SparkSession, path: str, key: str = "id") -> str:
    """Write the newest versions to a new folder and return its name."""
    target = fresh_dir(spark, "compacted")
    latest = read_latest(spark, path, key)
    latest.withColumn("batch", F.lit(-1)).write.partitionBy("batch", "table").parquet(target)
    return target
