"""Chat history: context windows, transcripts, keyed upsert, newest first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def context_window(df: DataFrame, key: str, position: str, columns: list[str], size: int = 4, block: int = 256) -> DataFrame:
    """The ``size`` rows before each row of a conversation, as an array; positions may have gaps.

    A long conversation is cut into blocks of positions. A block starts with what the blocks before it end with: the last
    ``size`` rows of each block are enough to find that, so only they of a conversation meet in one task.
    """
    rows = df.withColumn("_block", F.floor(F.col(position) / block))
    item = F.struct(*columns)
    last = F.row_number().over(W.partitionBy(key, "_block").orderBy(F.desc(position)))
    ends = rows.withColumn("_last", last).where(F.col("_last") <= size)
    ends = ends.select(key, "_block", F.col(position).alias("_at"), item.alias("_item"))
    whole = W.partitionBy(key).orderBy("_at")
    # at the first of a block's last rows, the rows before it belong to other blocks
    carried = ends.withColumn("_carried", F.collect_list("_item").over(whole.rowsBetween(-size, -1)))
    carried = carried.withColumn("_before", F.lag("_block").over(whole)).where(F.col("_before") != F.col("_block"))
    before = W.partitionBy(key, "_block").orderBy(position).rowsBetween(-size, -1)
    out = rows.withColumn("context", F.collect_list(item).over(before))
    out = out.join(carried.select(key, "_block", "_carried"), [key, "_block"], "left")
    short = F.greatest(F.lit(0), F.lit(size) - F.size("context"))
    filled = F.coalesce("_carried", F.filter("context", lambda c: F.lit(False)))
    filled = F.slice(filled, F.greatest(F.lit(1), F.size(filled) - short + 1), short)
    return out.withColumn("context", F.concat(filled, "context")).select(*df.columns, "context")


def transcript_lines(df: DataFrame, key: str, position: str, role: str, text: str) -> DataFrame:
    """``(key, position, line)`` with a turn as ``role: text`` and a line end: the form without any bound."""
    line = F.concat(F.coalesce(F.col(role), F.lit("unknown")), F.lit(": "), F.coalesce(F.col(text), F.lit("")), F.lit("\n"))
    return df.select(key, position, line.alias("line"))


def transcript_blocks(df: DataFrame, key: str, position: str, role: str, text: str, block: int = 256) -> DataFrame:
    """``(key, _block, _text)``: the lines of each block of positions in order, as one text."""
    line = F.struct(F.col(position).alias("p"), "line")
    lines = transcript_lines(df, key, position, role, text).withColumn("_block", F.floor(F.col(position) / block))
    grouped = lines.groupBy(key, "_block").agg(F.array_sort(F.collect_list(line)).alias("l"))
    return grouped.select(key, "_block", F.array_join(F.col("l.line"), "").alias("_text"))


def transcript(df: DataFrame, key: str, position: str, role: str, text: str) -> DataFrame:
    """One text per conversation, ``(key, transcript)``: its lines in order, however many there are.

    Lines are joined by block of positions first, so a long conversation is spread over tasks, and only its blocks meet in one.
    """
    blocks = transcript_blocks(df, key, position, role, text)
    grouped = blocks.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_block", "_text"))).alias("l"))
    return grouped.select(key, F.array_join(F.col("l._text"), "").alias("transcript"))


def upsert(current: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Updates replace rows of their key, other updates are added; ``is_new`` is null for untouched rows."""
    columns = [c for c in current.columns if c != key]
    old = current.select(key, *[F.col(c).alias(f"_old_{c}") for c in columns], F.lit(True).alias("_has_old"))
    new = updates.select(key, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_has_new"))
    joined = old.join(new, key, "full_outer")
    has_new = F.col("_has_new").isNotNull()
    return joined.select(
        key,
        *[F.when(has_new, F.col(f"_new_{c}")).otherwise(F.col(f"_old_{c}")).alias(c) for c in columns],
        F.when(has_new, F.col("_has_old").isNull()).alias("is_new"),
    )


def newest_first(df: DataFrame, user: str, user_id, sequence: str) -> DataFrame:
    """One user's history in reverse insertion order, without the user column."""
    return df.where(F.col(user) == user_id).orderBy(F.desc(sequence)).drop(user)
