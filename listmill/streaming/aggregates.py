"""Market aggregates kept up to date from the upserts of a stream, without reading the served tables anew.

A cell is the finest group that the market questions ask for: table, rent or buy, province, district and day. Each micro-batch looks up
the versions that its rows replace, takes them off their cells and adds the new ones, and appends these differences as one folder,
which a repeated batch replaces as a whole. Sums of the differences are the aggregates of the served view at any time; a version
that is older than the served one changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from listmill.functions.predicates import is_rent
from listmill.operators.market import complete, fill_days
from listmill.operators.records import first_per_key
from listmill.session import fresh_dir, settle, small
from listmill.sources.tables import append_versions, newest_first, write_batch

METRICS = ("price", "price_per_m2", "square")
CELL = ["table", "kind", "province", "district", "post_date"]


def differences(before: DataFrame, after: DataFrame) -> DataFrame:
    """What taking the rows of ``before`` off and adding those of ``after`` changes in each cell: counts and sums."""
    signed = before.withColumn("sign", F.lit(-1)).unionByName(after.withColumn("sign", F.lit(1)), allowMissingColumns=True)
    kind = F.when(is_rent(F.col("estate_type")), "rent").otherwise("buy")
    sums: list[Column] = [F.sum("sign").alias("n")]
    for m in METRICS:
        sums += [F.sum(F.when(F.col(m).isNotNull(), F.col("sign"))).alias(f"n_{m}"), F.sum(F.col("sign") * F.col(m)).alias(f"sum_{m}")]
    return signed.withColumn("kind", kind).groupBy(*CELL).agg(*sums).where(" OR ".join(f"n_{m} <> 0 OR sum_{m} <> 0" for m in METRICS) + " OR n <> 0")


def _named(key: str) -> Column:
    """Table and key as one value, in which nulls are equal, as they are for an upsert."""
    return F.struct("table", key)


def replaced(spark: SparkSession, served: str, rows: DataFrame, key: str, batch: int) -> DataFrame:
    """The served versions, written before ``batch``, of the keys of ``rows``."""
    earlier = spark.read.parquet(served).where(F.col("batch") < batch).withColumn("_key", _named(key))
    asked = small(rows.select(_named(key).alias("_key")))
    return first_per_key(
        earlier.join(asked, "_key", "left_semi").drop("_key"), ["table", key], F.col("created_at").desc_nulls_last(), F.desc("batch")
    ).drop("batch")


def publish_with_cells(stream: DataFrame, served: str, cells: str, checkpoint: str, key: str = "id", once: bool = False) -> StreamingQuery:
    """Upsert the rows (table, key, created_at, ...) into the served tables and their differences into the cells."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = settle(first_per_key(batch, ["table", key], *newest_first(batch)))
        # the first batch has nothing before it
        old = settle(replaced(spark, served, rows, key, number)) if number else rows.limit(0)
        if old.isEmpty():
            before, after = rows.limit(0), rows
        else:
            stamps = old.select(_named(key).alias("_key"), F.col("created_at").alias("was"))
            held = rows.withColumn("_key", _named(key)).join(stamps, "_key", "left")
            held = held.where("was IS NULL OR created_at >= was")
            before = old.withColumn("_key", _named(key)).join(held.select("_key"), "_key", "left_semi").drop("_key")
            after = held.drop("was", "_key")
        write_batch(differences(before, after), cells, number)
        append_versions(rows, served, key, number)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def read_cells(spark: SparkSession, cells: str) -> DataFrame:
    """Counts and sums of every cell."""
    rows = spark.read.parquet(cells)
    names = [c for c in rows.columns if c == "n" or c.startswith(("n_", "sum_"))]
    return rows.groupBy(*CELL).agg(*(F.sum(c).alias(c) for c in names)).where("n > 0")


def fold(spark: SparkSession, cells: str) -> str:
    """Write the sums of all differences to a new folder, to which the stream's next ones may be added, and return its name."""
    target = fresh_dir(spark, "cells")
    write_batch(read_cells(spark, cells), target, -1)
    return target


def _average(rows: DataFrame, keys: list, metric: str) -> DataFrame:
    total, n = F.sum(f"sum_{metric}"), F.sum(f"n_{metric}")
    return rows.groupBy(*keys).agg(F.when(n > 0, total / n).alias(f"avg_{metric}"))


def by_district(cells: DataFrame, domain: DataFrame, metric: str, kind: str = "buy", category: str | None = None) -> DataFrame:
    """Average of ``metric`` per valid district, as :func:`listmill.operators.market.by_district` gives it from the listings."""
    rows = cells.where(F.col("kind") == kind)
    if category is not None:
        rows = rows.where(F.col("table") == category)
    return complete(_average(rows, ["district"], metric), domain.select("district").distinct(), ["district"], f"avg_{metric}")


def by_day(cells: DataFrame, metric: str, district: str, start: str, end: str, kind: str = "buy") -> DataFrame:
    """Average of ``metric`` per day of one district, as :func:`listmill.operators.market.by_day` gives it from the listings."""
    days = F.col("post_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    rows = cells.where((F.col("kind") == kind) & (F.col("district") == district) & days)
    return fill_days(_average(rows, [F.col("post_date").alias("day")], metric), "day", f"avg_{metric}")
