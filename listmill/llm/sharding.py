"""Shards by a permutation of global row numbers (operator 1).

Rows are numbered by their place in the order of the given columns over the whole table. A Feistel network permutes the numbers
below the next even power of two; a result at or beyond the number of rows goes through the network again until it is a
row number (cycle walking), which makes a permutation of the rows. The permuted number divided by the number of shards gives
slot and shard, so shards differ by at most one row, and either direction is computed without looking at other rows.

Defined results: nulls in the order come first; rows that are equal in all columns of the order take neighbouring numbers, in
whichever order, so the result as a whole is the same for any layout of the table; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listmill.llm.arrays import mix
from listmill.session import settle

ROUNDS = 6
SEED = 2024
_IN_PARTITION = 33  # bits that monotonically_increasing_id keeps for the row in its partition


def _keys(seed: int) -> np.ndarray:
    return mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


def _half(n: int) -> int:
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def _network(x: np.ndarray, n: int, keys: np.ndarray, back: bool) -> np.ndarray:
    bits = np.uint64(_half(n))
    mask = np.uint64((1 << _half(n)) - 1)
    left, right = x >> bits, x & mask
    for key in keys[::-1] if back else keys:
        if back:
            left, right = right ^ (mix(left + key) & mask), left
        else:
            left, right = right, left ^ (mix(right + key) & mask)
    return (left << bits) | right


def _walk(rows, n: int, seed: int, back: bool) -> np.ndarray:
    x = np.asarray(rows, np.uint64)
    if x.size and int(x.max()) >= n:
        raise ValueError("row number beyond the number of rows")
    keys = _keys(seed)
    out = _network(x, n, keys, back)
    beyond = np.flatnonzero(out >= n)
    while len(beyond):
        out[beyond] = _network(out[beyond], n, keys, back)
        beyond = beyond[out[beyond] >= n]
    return out.astype(np.int64)


def permute(rows, n: int, seed: int = SEED) -> np.ndarray:
    """The permuted number of each row number below ``n``."""
    return _walk(rows, n, seed, back=False)


def restore(numbers, n: int, seed: int = SEED) -> np.ndarray:
    """The row number that each permuted number comes from."""
    return _walk(numbers, n, seed, back=True)


def place_of(rows, n: int, shards: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Shard and slot of row numbers."""
    number = permute(rows, n, seed)
    return number % shards, number // shards


def row_at(shard, slot, n: int, shards: int, seed: int = SEED) -> np.ndarray:
    """The row number in a slot of a shard."""
    return restore(np.asarray(slot) * shards + np.asarray(shard), n, seed)


def numbered(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` with row_number (from 0) in the global order of the columns ``order``; give it narrow rows.

    Rows are dealt out by ranges of the order, sorted within their range and numbered from the counts of the ranges. Rows equal
    in the whole order may be dealt to several ranges, so no key is too frequent.
    """
    salted = df.withColumn("_salt", F.monotonically_increasing_id())
    by = [*order, "_salt"]
    placed = salted.repartitionByRange(*by).sortWithinPartitions(*by).drop("_salt")
    settled = settle(placed.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", _IN_PARTITION)
    sizes = settled.groupBy(part.alias("_part")).count().collect()
    # one row for each partition of the table: bounded by the number of partitions
    starts, total = [], 0
    for r in sorted(sizes):
        starts.append((r["_part"], total))
        total += r["count"]
    starts = df.sparkSession.createDataFrame(starts, "_part long, _start long")
    inside = F.col("_at").bitwiseAND((1 << _IN_PARTITION) - 1)
    joined = settled.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return joined.withColumn("row_number", F.col("_start") + inside).drop("_at", "_part", "_start")


def assign(df: DataFrame, order: list[str], shards: int = 8, seed: int = SEED) -> DataFrame:
    """``df`` with row_number, shard and slot; columns of these names that are not in the order are replaced."""
    df = df.drop(*(c for c in ("row_number", "shard", "slot", "_number") if c not in order))
    rows = numbered(df, order)
    total = df.count()

    @F.pandas_udf("long")
    def number(row: pd.Series) -> pd.Series:
        return pd.Series(permute(row.to_numpy(), total, seed))

    dealt = rows.withColumn("_number", number("row_number"))
    return dealt.select(
        *rows.columns,
        (F.col("_number") % shards).cast("int").alias("shard"),
        F.expr(f"_number div {shards}").alias("slot"),
    )


def report(docs: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, CRC-32 of the text, the law that holds, shard and slot; documents are in order of id, CRC and size."""
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    return assign(narrow, ["doc_id", "text_crc32", "size"], shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
