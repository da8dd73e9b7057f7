"""Heat-map layers over district coordinates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listmill import fixed
from listmill.session import small


def min_max(df: DataFrame, value: str) -> Column:
    """``value`` scaled to 0..1 over the whole frame, 0.5 when all are equal.

    The two extremes are scalar subqueries, so no row moves.
    """
    low = df.select(F.min(value)).scalar()
    high = df.select(F.max(value)).scalar()
    return F.when(high > low, (F.col(value) - low) / (high - low)).otherwise(F.lit(0.5))


def heat_layer(metric: DataFrame, coordinates: DataFrame, value: str) -> DataFrame:
    """Scaled metric per district that has coordinates. The scale spans all districts, mapped or not."""
    scaled = metric.withColumn("weight", min_max(metric, value))
    located = coordinates.where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    return scaled.join(small(located), ["province", "district"]).select(
        "province", "district", "lat", "lon", value, "weight"
    )


def map_extent(layer: DataFrame) -> DataFrame:
    """Centre and bounding box of a layer; the default centre when it is empty."""
    lat, lon = fixed.DEFAULT_CENTRE
    return layer.agg(
        F.coalesce(F.avg("lat"), F.lit(lat)).alias("centre_lat"),
        F.coalesce(F.avg("lon"), F.lit(lon)).alias("centre_lon"),
        F.min("lat").alias("min_lat"),
        F.max("lat").alias("max_lat"),
        F.min("lon").alias("min_lon"),
        F.max("lon").alias("max_lon"),
    )
