"""Comparison of each item with a bounded look-back: the last items before it, or the last items that were kept."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from listmill.session import fresh_dir, settle

LOOK_BACK = 4000


def _positioned(df: DataFrame, position: str, title: str, vector: str, block_rows: int, *more) -> DataFrame:
    """pos, title, vec and the block of positions of each row."""
    return df.select(
        F.col(position).cast("long").alias("pos"), F.col(title).cast("string").alias("title"),
        F.col(vector).cast("array<double>").alias("vec"),
        F.floor(F.col(position) / block_rows).cast("long").alias("own"), *more,
    )


class _Vectors:
    """Unit vectors of an Arrow list column by length; rows without a vector, or with a null in it, have none."""

    def __init__(self, column: pa.ChunkedArray):
        lists = column.combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        flat, begin = lists.flatten(), lists.offsets.to_numpy()[:-1] - lists.offsets.to_numpy()[0]
        sizes = np.where(np.array(lists.is_null()), 0, sizes)
        values = flat.to_numpy(zero_copy_only=False)
        if flat.null_count:
            broken = np.add.reduceat(np.append(np.array(flat.is_null()), False), begin, dtype=np.int64) > 0
            sizes = np.where(broken & (sizes > 0), 0, sizes)
        self.length = sizes
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size in np.unique(sizes[sizes > 0]):
            rows = np.flatnonzero(sizes == size)
            x = values[begin[rows][:, None] + np.arange(size)].astype(np.float64)
            norm = np.sqrt((x * x).sum(axis=1))
            self.by_length[int(size)] = rows, x / np.where(norm == 0, 1.0, norm)[:, None]


def _codes(titles: pa.ChunkedArray) -> np.ndarray:
    """Equal titles as equal numbers; null is a title of its own."""
    codes = titles.combine_chunks().dictionary_encode()
    return codes.indices.fill_null(-1).to_numpy(zero_copy_only=False)


def similar_pairs(
    df: DataFrame, position: str, title: str, vector: str, same_title: float = 0.95, any_title: float = 0.99,
    look_back: int = LOOK_BACK,
) -> DataFrame:
    """``(later, earlier, cosine)`` for items at most ``look_back`` positions apart.

    ``position`` is the unique arrival number. Items are cut into blocks of ``look_back`` positions; a block is compared
    with itself and the one before, so a task holds at most two blocks, whatever the table's size, and each item
    travels twice. The products of two blocks are one matrix multiplication. Items without a vector, or with a null in
    it, are like nothing; vectors of different lengths are not compared.
    """
    rows = _positioned(df, position, title, vector, look_back)
    # every block is the "later" side once and the "earlier" side for itself and for the next block
    spread = rows.withColumn("block", F.explode(F.array(F.col("own"), F.col("own") + 1)))

    def compare(data: pa.Table) -> pa.Table:
        number = data.column("block")[0].as_py()
        pos, own, titles = data.column("pos").to_numpy(), data.column("own").to_numpy(), _codes(data.column("title"))
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        for rows_of, unit in _Vectors(data.column("vec")).by_length.values():
            at_pos, at_title = pos[rows_of], titles[rows_of]
            mine = np.flatnonzero(own[rows_of] == number)
            for at in range(0, len(mine), 512):
                some = mine[at : at + 512]
                cos = unit[some] @ unit.T
                a, b = np.nonzero(cos > same_title)
                value, i = cos[a, b], some[a]
                apart = at_pos[i] - at_pos[b]
                keep = (apart > 0) & (apart <= look_back) & ((value > any_title) | (at_title[i] == at_title[b]))
                found.append((at_pos[i][keep], at_pos[b][keep], value[keep]))
        later, earlier, cosine = (np.concatenate(c) for c in zip(*found, strict=True))
        return pa.table({"later": later, "earlier": earlier, "cosine": cosine})

    narrow = spread.select("block", "pos", "own", "title", "vec")
    return narrow.groupBy("block").applyInArrow(compare, "later long, earlier long, cosine double")


# ---------------------------------------------------------------- the last kept items


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` from files in the shared folder: unlike a checkpoint it carries no constraints on from round to round."""
    folder = fresh_dir(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def first_held(count, look_back: int = LOOK_BACK):
    """Number of the oldest kept item still held when ``count`` items were kept.

    The list grows to one more than ``look_back``; the next item that comes first takes its oldest quarter away.
    """
    quarter = look_back // 4
    return np.where(np.asarray(count) <= look_back, 0, quarter * (1 + (np.asarray(count) - look_back - 1) // max(1, quarter)))


def _decide(titles, vectors, tail: int, kept_before: int, same_title: float, any_title: float, look_back: int):
    """Which rows behind the first ``tail`` (kept before, the last of them number ``kept_before - 1``) are kept."""
    n = len(titles)
    number = np.full(n, -1, np.int64)
    number[:tail] = kept_before - tail + np.arange(tail)
    count = kept_before
    # rows of one vector length are compared with the held rows of that length, a stretch at a time
    place, group = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    for size, (rows, _) in vectors.by_length.items():
        place[rows], group[rows] = np.arange(len(rows)), size
    step = 256
    for low in range(tail, n, step):
        high = min(low + step, n)
        like: dict[int, list[int]] = {}
        oldest = int(first_held(count, look_back))
        for size, (rows, unit) in vectors.by_length.items():
            some = rows[(rows >= low) & (rows < high)]
            held = rows[(rows < high) & ((number[rows] >= oldest) | (rows >= low))]
            if not len(some) or not len(held):
                continue
            cos = unit[place[some]] @ unit[place[held]].T
            a, b = np.nonzero(cos > same_title)
            i, j = some[a], held[b]
            keep = (j < i) & ((cos[a, b] > any_title) | (titles[i] == titles[j]))
            for later, earlier in zip(i[keep].tolist(), j[keep].tolist(), strict=True):
                like.setdefault(later, []).append(earlier)
        for row in range(low, high):
            before = like.get(row)
            if before is not None:
                numbers = number[before]
                if (numbers >= int(first_held(count, look_back))).any():
                    continue
            number[row] = count
            count += 1
    return number, count


def keep(
    df: DataFrame, position: str, title: str, vector: str, same_title: float = 0.95, any_title: float = 0.99,
    look_back: int = LOOK_BACK, block_rows: int | None = None, source: str | None = None,
) -> DataFrame:
    """``(position, kept)``: an item is dropped when it is like one of the last kept items before it.

    With ``source`` each source (a crawl run, a site) has a list of its own, and the column is returned in front.

    A list of kept items grows to ``look_back`` + 1, then loses its oldest quarter when the next item comes. Who is compared
    thus depends on who was kept, so the answer is a fixpoint: blocks of ``block_rows`` positions are decided side by side, each
    behind the kept tail and the number of kept items that the block before handed on in the round before. A round decides
    only blocks whose tail or number has changed; after round ``r`` at least the first ``r`` blocks of a source are final. Where
    little is dropped two or three rounds do. As every eviction depends on the number kept since the start, a list is a chain
    in the worst case, with a round for every block; large blocks and separate sources keep it short.

    A task holds one block and one tail. One narrow row a block is ordered by source; the driver holds nothing.

    Items without a vector, with a null in it, or all zero are like nothing, but are kept and take a place in the list;
    vectors of different lengths are not compared; two null titles are equal. ``position`` is the unique arrival number.
    """
    if look_back < 4:
        raise ValueError("look_back needs a quarter of at least one item")
    block_rows = block_rows or 32 * look_back
    named = F.col(source) if source else F.lit(None).cast("string")
    rows = _positioned(df, position, title, vector, block_rows, named.alias("source")).where(F.col("pos").isNotNull())
    # a block's number, whichever source it belongs to
    rows = settle(rows.withColumn("block", F.xxhash64("source", "own")))
    shape = "block long, pos long, title string, vec array<double>, number long, tail boolean"

    def decide(data: pa.Table, tail: pa.Table) -> pa.Table:
        tail, data, names = tail.sort_by("number"), data.sort_by("pos"), ["pos", "title", "vec"]
        both = pa.concat_tables([tail.select(names).cast(data.select(names).schema), data.select(names)]).combine_chunks()
        number, count = _decide(
            _codes(both.column("title")), _Vectors(both.column("vec")), len(tail), data.column("kept_before")[0].as_py(),
            same_title, any_title, look_back,
        )
        handed = number >= int(first_held(count, look_back))
        # a row before the block comes back only as part of the tail; only the tail needs more than its number
        shown = np.flatnonzero(handed | (np.arange(len(number)) >= len(tail)))
        wanted = pa.array(np.where(handed[shown], shown, -1), mask=~handed[shown])
        return pa.table({
            "block": pa.array(np.full(len(shown), data.column("block")[0].as_py())), "pos": both.column("pos").take(pa.array(shown)),
            "title": both.column("title").take(wanted), "vec": both.column("vec").take(wanted),
            "number": pa.array(number[shown]), "tail": pa.array(handed[shown]),
        })

    order = W.partitionBy("source").orderBy("own")
    blocks = rows.groupBy("source", "own", "block").agg(F.count(F.lit(1)).alias("kept"))
    zero, unknown = F.lit(0).cast("long"), F.lit(-1).cast("long")
    # kept: how many the block keeps, all until it is decided; mark: of its tail; had: what it was decided behind
    blocks = settle(blocks.withColumns({
        "next": F.lead("block").over(order), "mark": zero, "had_before": unknown, "had_mark": zero,
    }))
    decided = df.sparkSession.createDataFrame([], shape)
    while True:
        ahead = F.coalesce(F.sum("kept").over(order.rowsBetween(W.unboundedPreceding, -1)), zero)
        mark = F.coalesce(F.lag("mark").over(order), zero)
        blocks = _written(blocks.withColumns({"kept_before": ahead, "mark_before": mark}), "blocks")
        changed = blocks.where("kept_before <> had_before OR mark_before <> had_mark").select("block", "kept_before")
        if changed.isEmpty():
            break
        # the tail of the block before, numbered back from what is now known to be kept before
        newest = F.max("number").over(W.partitionBy("block"))
        tails = decided.where("tail").withColumn("back", newest - F.col("number")).join(blocks.select("block", F.col("next").alias("behind")), "block")
        tails = tails.join(changed.withColumnRenamed("block", "behind"), "behind").select(
            "behind", "pos", "title", "vec", (F.col("kept_before") - 1 - F.col("back")).alias("number")
        )
        again = rows.drop("source", "own").join(changed, "block").groupBy("block").cogroup(tails.groupBy("behind")).applyInArrow(decide, shape)
        decided = _written(decided.join(changed.select("block"), "block", "left_anti").select(again.columns).union(again), "decided")
        told = decided.join(changed, "block").groupBy("block").agg(
            F.count_if(F.col("number") >= F.col("kept_before")).alias("now"),
            F.coalesce(F.bit_xor(F.when(F.col("tail"), F.xxhash64("pos"))), zero).alias("now_mark"),
        )
        blocks = blocks.join(told, "block", "left").select(
            "source", "own", "block", "next", F.coalesce("now", "kept").alias("kept"), F.coalesce("now_mark", "mark").alias("mark"),
            F.col("kept_before").alias("had_before"), F.col("mark_before").alias("had_mark"),
        )
    own = decided.join(blocks.select("block", "source", "own"), "block").where(F.floor(F.col("pos") / block_rows) == F.col("own"))
    given = [F.col("source").alias(source)] if source else []
    return own.select(*given, F.col("pos").alias(position), (F.col("number") >= 0).alias("kept"))
