"""Quantile bounds per category and the trimming of outliers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from listmill.session import settle, small

LOWER, UPPER, SPREADS = 0.05, 0.95, 5.0
ACCURACY = 10_000


def _bounds(low: Column, high: Column, spreads: float) -> list[Column]:
    reach = (high - low) * spreads
    return [F.greatest(low - reach, F.lit(0.0)).alias("lower_bound"), (high + reach).alias("upper_bound")]


def approx_bounds(
    df: DataFrame, group: str | None, value: str, lower: float = LOWER, upper: float = UPPER,
    spreads: float = SPREADS, accuracy: int = ACCURACY,
) -> DataFrame:
    """Bounds from mergeable quantile sketches: one pass, one small sketch per task and group."""
    grouped = df.groupBy(group) if group else df.groupBy()
    sketch = grouped.agg(F.percentile_approx(value, [lower, upper], accuracy).alias("q"))
    keys = [group] if group else []
    return sketch.select(*keys, *_bounds(F.col("q")[0], F.col("q")[1], spreads))


def exact_quantiles(
    df: DataFrame, group: str, value: str, probabilities: list[float], accuracy: int = ACCURACY
) -> DataFrame:
    """Interpolated quantiles per group, ``(group, n, q0, q1, ...)``, without gathering a group in one task.

    A sketch of bounded size brackets each wanted rank. Rows below a bracket are only counted, rows above are dropped,
    so the ordered part of a group is about ``10 / accuracy`` of its distinct values, or all of a group of fewer than
    ``accuracy`` rows. The counted rank is compared with the bracket; a sketch that missed it stops the job instead of
    giving a wrong value.
    """
    # read twice from here on: two columns are settled, rather than all that leads to them computed twice
    rows = settle(df.select(F.col(group).alias("g"), F.col(value).cast("double").alias("v")).where(F.col("v").isNotNull()))
    margin = 4.0 / accuracy
    wanted = [min(1.0, max(0.0, p + d)) for p in probabilities for d in (-margin, margin)]
    sketch = settle(
        rows.groupBy("g").agg(F.count("v").alias("n"), F.percentile_approx("v", wanted, accuracy).alias("s"))
    )
    bracketed = rows.join(small(sketch), rows["g"].eqNullSafe(sketch["g"])).select(rows["g"], "n", "v", "s")
    marks = []
    for i, p in enumerate(probabilities):
        # a group this small is ordered whole
        open_ = F.col("n") * margin < 4
        low = F.when(open_ | F.lit(p <= margin), F.lit(float("-inf"))).otherwise(F.col("s")[2 * i])
        high = F.when(open_ | F.lit(p >= 1 - margin), F.lit(float("inf"))).otherwise(F.col("s")[2 * i + 1])
        key = F.when(F.col("v") >= low, F.col("v"))
        marks.append(F.when(F.col("v") <= high, F.struct(F.lit(i).alias("i"), key.alias("key"))))
    counted = (
        bracketed.select("g", "n", F.explode(F.array_compact(F.array(*marks))).alias("m"))
        .groupBy("g", "n", "m.i", "m.key")
        .agg(F.count(F.lit(1)).alias("c"))
    )
    # the null key carries the rows below the bracket and sorts first
    upto = F.sum("c").over(W.partitionBy("g", "i").orderBy(F.col("key").asc_nulls_first()))
    rank = (F.col("n") - 1) * F.element_at(F.array(*map(F.lit, probabilities)), F.col("i") + 1)
    ranked = counted.select("*", upto.alias("upto"), rank.alias("rank"))
    reached = F.min(F.when(F.col("upto") > F.floor("rank"), F.struct("upto", "key")))
    picked = ranked.groupBy("g", "n", "i", "rank").agg(
        reached.alias("at_floor"),
        F.min(F.when(F.col("upto") > F.ceil("rank"), F.col("key"))).alias("at_ceil"),
    )
    low_value = F.col("at_floor.key")
    checked = F.when(
        low_value.isNull() | F.col("at_ceil").isNull(), F.raise_error(F.lit("quantile sketch missed its bracket"))
    ).otherwise(low_value + (F.col("at_ceil") - low_value) * (F.col("rank") - F.floor("rank")))
    per_group = picked.select("g", "n", "i", checked.cast("double").alias("q")).groupBy("g", "n")
    columns = [F.max(F.when(F.col("i") == i, F.col("q"))).alias(f"q{i}") for i in range(len(probabilities))]
    return per_group.agg(*columns).withColumnRenamed("g", group)


def exact_bounds(
    df: DataFrame, group: str, value: str, lower: float = LOWER, upper: float = UPPER, spreads: float = SPREADS,
    min_rows: int = 0,
) -> DataFrame:
    """Exact bounds of the groups with more than ``min_rows`` filled values."""
    quantiles = exact_quantiles(df, group, value, [lower, upper]).where(F.col("n") > min_rows)
    return quantiles.select(group, *_bounds(F.col("q0"), F.col("q1"), spreads))


def trim(df: DataFrame, bounds: DataFrame, group: str, value: str, keep_null: bool = True) -> DataFrame:
    """Keep rows whose value lies within the bounds of their group.

    ``keep_null`` also keeps rows without a value and groups without bounds, the null group included; otherwise both
    go, as in an inner join.
    """
    side = small(settle(bounds)).withColumnRenamed(group, "_group")
    inside = F.col(value).between(F.col("lower_bound"), F.col("upper_bound"))
    if keep_null:
        joined = df.join(side, F.col(group).eqNullSafe(F.col("_group")), "left")
        inside = F.col(value).isNull() | F.col("lower_bound").isNull() | inside
    else:
        joined = df.join(side, F.col(group) == F.col("_group"), "inner")
    return joined.where(inside).drop("_group", "lower_bound", "upper_bound")


def trim_global(df: DataFrame, value: str) -> DataFrame:
    """Keep rows within the approximate bounds of the whole table, which enter as a scalar subquery."""
    bounds = approx_bounds(df, None, value)
    low = bounds.select("lower_bound").scalar()
    high = bounds.select("upper_bound").scalar()
    return df.where(F.col(value).between(low, high))
