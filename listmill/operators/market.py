"""Market questions: a metric by district and by day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from listmill.functions.predicates import day_between, listing_type
from listmill.session import small


def complete(metric: DataFrame, domain: DataFrame, on: list[str], value: str) -> DataFrame:
    """Every row of the domain, with zero where the metric has none."""
    return domain.join(metric, on, "left").withColumn(value, F.coalesce(F.col(value), F.lit(0.0)))


def by_district(
    listings: DataFrame, domain: DataFrame, metric: str, kind: str = "buy", category: str | None = None,
    with_province: bool = False,
) -> DataFrame:
    """Average of ``metric`` per valid district.

    The filters reach the scan, the average is combined before the shuffle, and the domain joins the aggregate only.
    Without ``with_province`` districts of one name are one group, whatever their province.
    """
    keys = ["province", "district"] if with_province else ["district"]
    rows = listings.where(listing_type(F.col("estate_type"), kind))
    if category is not None:
        rows = rows.where(F.col("category") == category)
    rows = rows.join(small(domain.select(*keys).distinct()), keys, "left_semi")
    averages = rows.groupBy(*keys).agg(F.avg(metric).alias(f"avg_{metric}"))
    return complete(averages, domain, keys, f"avg_{metric}")


def by_day(
    listings: DataFrame, metric: str, district: str, start: str, end: str, kind: str = "buy",
    category: str | None = None,
) -> DataFrame:
    """Average of ``metric`` per calendar day of one district; days without listings inside the span are zero."""
    rows = listings.where(
        (F.col("district") == district)
        & day_between(F.col("post_date"), F.lit(start), F.lit(end))
        & listing_type(F.col("estate_type"), kind)
    )
    if category is not None:
        rows = rows.where(F.col("category") == category)
    daily = rows.groupBy(F.col("post_date").alias("day")).agg(F.avg(metric).alias(f"avg_{metric}"))
    return fill_days(daily, "day", f"avg_{metric}")


def fill_days(daily: DataFrame, day: str, value: str) -> DataFrame:
    """Add the missing days between the first and the last one, and read null as zero."""
    span = daily.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    spine = span.where(F.col("first").isNotNull()).select(F.explode(F.sequence("first", "last")).alias(day))
    return spine.join(daily, day, "left").withColumn(value, F.coalesce(F.col(value), F.lit(0.0)))


def numbered(df: DataFrame, *order: Column | str) -> DataFrame:
    """Sequence number 1..n in display order.

    For displayed aggregates only: one row per district or day, so the single ordering task stays small.
    """
    return df.withColumn("seq", F.row_number().over(W.orderBy(*order)))


def counts_per_category(df: DataFrame, category: str) -> DataFrame:
    return df.groupBy(category).agg(F.count(F.lit(1)).alias("n"))


def distinct_categories(df: DataFrame, category: str) -> DataFrame:
    return df.where(F.col(category).isNotNull()).select(category).distinct()


def special_characters(df: DataFrame, *texts: str) -> DataFrame:
    """Distinct special characters of the given text columns; only distinct ones are shuffled."""
    from listmill.functions.text import SPECIAL

    found = F.regexp_extract_all(F.concat_ws(" ", *texts), F.lit(f"({SPECIAL})"))
    return df.select(F.explode(found).alias("ch")).distinct()
