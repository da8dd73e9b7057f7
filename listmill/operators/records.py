"""Record identity, ingest columns, versions and shaping of served rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from listmill.functions.fields import stamp
from listmill.schema import SERVED_TYPES


def with_id(df: DataFrame) -> DataFrame:
    """``id``: the given id, else the post id, else the hash of the link."""
    sources = [F.col(c).cast("string") for c in ("id", "post_id") if c in df.columns]
    return df.withColumn("id", F.coalesce(*sources, F.md5("link")))


def with_ingest_date(df: DataFrame, moment: Column) -> DataFrame:
    return df.withColumns(
        {"year": F.year(moment), "month": F.month(moment), "day": F.dayofmonth(moment)}
    )


def with_created_at(df: DataFrame, moment: Column) -> DataFrame:
    return df.withColumn("created_at", stamp(moment))


def flatten_address(df: DataFrame) -> DataFrame:
    return df.withColumns({part: F.col(f"address.{part}") for part in ("province", "district", "ward")})


def first_per_key(df: DataFrame, keys: list[str], *order: Column | str) -> DataFrame:
    """The first row of each key in the given order; null keys count as equal.

    ``row_number() = 1`` is limited per key before the shuffle, so a hot key sends one row per task.
    """
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def latest_per_id(df: DataFrame, key: str, version: str, *ties: Column | str) -> DataFrame:
    return first_per_key(df, [key], F.col(version).desc_nulls_last(), *ties)


def merge_views(batch: DataFrame, speed: DataFrame, key: str = "id", version: str = "created_at") -> DataFrame:
    """Batch view and speed view as one: the newest version of each id, the speed layer first among equals."""
    layered = batch.withColumn("_layer", F.lit(1)).unionByName(
        speed.withColumn("_layer", F.lit(0)), allowMissingColumns=True
    )
    return latest_per_id(layered, key, version, "_layer").drop("_layer")


def remove_ids(df: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    return df.join(ids.select(key).distinct(), key, "left_anti")


def typed(df: DataFrame) -> DataFrame:
    """Cast the served columns to their declared types; text that is no number becomes null."""
    casts = {c: F.col(c).try_cast(t) for c, t in SERVED_TYPES.items() if c in df.columns}
    return df.withColumns(casts)


def reader_record(df: DataFrame) -> DataFrame:
    """Served rows as the nested record that readers expect, with their fillers for missing values."""

    def have(name: str, kind: str) -> Column:
        return F.col(name) if name in df.columns else F.lit(None).cast(kind)

    phones = "array<string>"
    contact = F.col("contact_info") if "contact_info" in df.columns else None
    return df.select(
        F.struct(
            have("district", "string").alias("district"),
            have("full_address", "string").alias("full_address"),
            have("province", "string").alias("province"),
            F.coalesce(have("ward", "string"), F.lit("")).alias("ward"),
        ).alias("address"),
        F.struct(
            (contact["name"] if contact is not None else F.lit(None).cast("string")).alias("name"),
            F.coalesce(
                contact["phone"] if contact is not None else F.lit(None).cast(phones), F.array().cast(phones)
            ).alias("phone"),
        ).alias("contact_info"),
        have("description", "string").alias("description"),
        have("estate_type", "string").alias("estate_type"),
        F.struct(
            *[
                have(n, t).alias(n)
                for n, t in {
                    "direction": "string", "front_face": "double", "front_road": "double", "no_bathrooms": "int",
                    "no_bedrooms": "int", "no_floors": "int", "ultilization_square": "double",
                    "yo_construction": "int", "legal": "string",
                }.items()
            ]
        ).alias("extra_infos"),
        have("id", "string").cast("string").alias("id"),
        have("link", "string").alias("link"),
        have("post_date", "string").cast("string").alias("post_date"),
        have("created_at", "string").cast("string").alias("created_at"),
        F.coalesce(have("post_id", "string").cast("string"), F.lit("")).alias("post_id"),
        F.coalesce(have("price", "double"), F.lit(0.0)).alias("price"),
        F.coalesce(have("price_per_m2", "double"), F.lit(0.0)).alias("price_per_square"),
        F.coalesce(have("square", "double").cast("double"), F.lit(0.0)).alias("square"),
        have("title", "string").alias("title"),
    )


def context_line(number: Column, title: Column, price: Column, address: Column, link: Column) -> Column:
    """One listing as the lines shown to a reader."""
    return F.concat(
        F.lit("\n#"), number.cast("string"), F.lit(". "), F.coalesce(title, F.lit("N/A")),
        F.lit("\n   - Giá: "), F.format_number(F.coalesce(price, F.lit(0.0)), 2), F.lit(" VNĐ"),
        F.lit("\n   - Đ/C: "), F.coalesce(address, F.lit("")),
        F.lit("\n   - Link: "), F.coalesce(link, F.lit("")), F.lit("\n"),
    )
