"""Near-duplicate vectors by random-hyperplane hashing, exact cosine and connected components (operator 2).

Equal vectors are one representative with a weight. Every representative gets a signature of sign bits in each of several
tables; those that share a bucket are compared exactly, in double precision, by matrix products. A bucket of more than
BLOCK vectors is cut into blocks and each pair of blocks is a group of its own. A group returns, for each vector, how many
others it is linked with for the first time (in the first table where the two meet), and a spanning forest of its links: the
pairs themselves are never listed. Components are then found over the forests of all groups.

The bits of a signature follow the number of vectors, so that buckets stay small, and the tables follow the bits, so
that two vectors at the threshold meet somewhere with probability RECALL at least; the more alike, the surer.

Defined results: a vector that is null, empty, zero or holds a null or non-finite component has no links and is its own
component; a row without an id has no links, a null component and is not kept; vectors of different lengths are never linked;
rows that repeat an id are vectors of their own, and share a component only by links or as their ids are the smallest of theirs;
other columns are not looked at.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listmill.llm.arrays import small_batches
from listmill.llm.components import components
from listmill.session import settle

COSINE = 0.9
RECALL = 0.997
# Vectors a bucket should hold on average, and those of a block.
BUCKET, BLOCK = 256, 1024
SEED = 5


def plan(n: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int]:
    """Bits of a signature and number of tables for ``n`` vectors."""
    bits = min(30, max(8, math.ceil(math.log2(max(n, 1) / BUCKET))))
    meet = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - meet))


def planes(length: int, bits: int, tables: int, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng([seed, length]).standard_normal((length, tables * bits))


def signatures(vectors: np.ndarray, bits: int, tables: int, normals: np.ndarray) -> np.ndarray:
    """The bucket of each vector in each table."""
    signs = (vectors @ normals >= 0).reshape(len(vectors), tables, bits)
    return (signs * (1 << np.arange(bits))).sum(axis=2).astype(np.int32)


def _hashed(column: str):
    """Two 64-bit hashes: a key of 128 bits for equal vectors."""
    return F.xxhash64(F.lit(1), column).alias("h1"), F.xxhash64(F.lit(2), column).alias("h2")


def _sound(column: str):
    wrong = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col("id").isNotNull() & F.col(column).isNotNull() & ~wrong & F.exists(column, lambda x: x != 0)


def _unit(raw: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest member of the component of each of ``n`` nodes linked by a - b."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        after = root.copy()
        np.minimum.at(after, root[a], low)
        np.minimum.at(after, root[b], low)
        after = after[after]
        if (after == root).all():
            return root
        root = after


def linked(x: np.ndarray, table: int, marks: np.ndarray, weight: np.ndarray, side: np.ndarray | None, cosine: float):
    """Links met first in this table, summed by weight for each vector, and the roots of the components of all links.

    ``side``: null to compare all with all, else False and True for the two blocks to compare with each other.
    """
    n = len(x)
    rows = np.arange(n) if side is None else np.flatnonzero(~side)
    columns = rows if side is None else np.flatnonzero(side)
    total = np.zeros(n, np.int64)
    roots = np.arange(n)
    for low in range(0, len(rows), 512):
        some = rows[low : low + 512]
        i, j = np.nonzero(x[some] @ x[columns].T >= cosine)
        i, j = some[i], columns[j]
        if side is None:
            i, j = i[i < j], j[i < j]
        if not len(i):
            continue
        new = np.ones(len(i), bool)
        for t in range(table):
            new &= marks[i, t] != marks[j, t]
        np.add.at(total, i[new], weight[j[new]])
        np.add.at(total, j[new], weight[i[new]])
        roots = _roots(n, np.concatenate([i, np.arange(n)]), np.concatenate([j, roots]))
    return total, roots


def near_duplicates(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE, recall: float = RECALL
) -> DataFrame:
    """key, n_links, component_id and kept of every row of ``df``."""
    rows = df.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.withColumn("v", F.when(_sound("v"), F.transform("v", lambda x: F.when(x == 0, 0.0).otherwise(x))))
    distinct = rows.filter(F.col("v").isNotNull()).groupBy("v").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("weight"))
    # a vector is named by a number of its own, as an id may stand for several
    distinct = settle(distinct.withColumn("rep", F.monotonically_increasing_id()))
    bits, tables = plan(distinct.count(), cosine, recall)

    def sign(batches):
        normals: dict[int, np.ndarray] = {}
        for batch in batches:
            values = batch.column("v")
            sizes = np.diff(values.offsets.to_numpy())
            flat = values.flatten().to_numpy()
            ends = np.cumsum(sizes)
            raw = [flat[e - s : e].tobytes() for s, e in zip(sizes, ends, strict=True)]
            marks = np.zeros((len(sizes), tables), np.int32)
            for size in np.unique(sizes):
                if size not in normals:
                    normals[size] = planes(int(size), bits, tables)
                at = np.flatnonzero(sizes == size)
                marks[at] = signatures(_unit([raw[k] for k in at]), bits, tables, normals[size])
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), batch.column("weight"), pa.array(sizes, pa.int32()), pa.array(raw, pa.binary()),
                 pa.array(list(marks), pa.list_(pa.int32()))],
                names=["rep", "weight", "size", "raw", "marks"],
            )

    signed = small_batches(distinct).select("rep", "weight", "v").mapInArrow(
        sign, "rep long, weight long, size int, raw binary, marks array<int>"
    )
    signed = settle(signed)
    bucket = ["size", "table", "bucket"]
    crowded = signed.select("size", F.posexplode("marks").alias("table", "bucket")).groupBy(*bucket).count()
    crowded = crowded.filter(F.col("count") > 1).withColumn("blocks", F.ceil(F.col("count") / BLOCK).cast("int"))
    met = signed.select("rep", "weight", "size", "raw", "marks", F.posexplode("marks").alias("table", "bucket"))
    met = met.join(settle(crowded.drop("count")), bucket)
    met = met.withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    group = [*bucket, "low", "high"]
    met = met.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})

    def compare(data: pa.Table) -> pa.Table:
        own, low, high = (data.column(c).to_numpy() for c in ("own", "low", "high"))
        reps = data.column("rep").to_numpy()
        order = np.argsort(reps)
        marks = np.array(data.column("marks").to_pylist(), np.int32)[order]
        weight = data.column("weight").to_numpy()[order]
        x = _unit(data.column("raw").to_pylist())[order]
        side = None if low[0] == high[0] else own[order] == high[0]
        reps = reps[order]
        total, roots = linked(x, int(data.column("table")[0].as_py()), marks, weight, side, cosine)
        some, joined = np.flatnonzero(total), np.flatnonzero(roots != np.arange(len(roots)))
        return pa.table({
            "a": pa.array(np.concatenate([reps[some], reps[joined]]), pa.int64()),
            "b": pa.array(np.concatenate([np.zeros(len(some), np.int64), reps[roots[joined]]]), pa.int64(),
                          mask=np.concatenate([np.ones(len(some), bool), np.zeros(len(joined), bool)])),
            "n": pa.array(np.concatenate([total[some], np.zeros(len(joined), np.int64)]), pa.int64()),
        })

    narrow = met.select(*group, "own", "rep", "weight", "raw", "marks")
    found = settle(narrow.groupBy(*group).applyInArrow(compare, "a long, b long, n long"))
    links = found.filter(F.col("b").isNull()).groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    forest = components(found.filter(F.col("b").isNotNull()))
    classes = distinct.select("rep", "id", "weight", *_hashed("v")).join(links, "rep", "left")
    classes = classes.join(forest.withColumnRenamed("node", "rep"), "rep", "left")
    classes = settle(classes.select(
        "h1", "h2", "id", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("links"), F.coalesce("root", "rep").alias("top")
    ))
    lowest = classes.groupBy("top").agg(F.min("id").alias("root"))
    classes = classes.drop("id").join(lowest, "top")
    # rows without a sound vector have a null key and meet no class
    keyed = rows.select("id", *(F.when(F.col("v").isNotNull(), h).alias(n) for h, n in zip(_hashed("v"), ("h1", "h2"), strict=True)))
    joined = keyed.join(classes, ["h1", "h2"], "left").withColumn("root", F.coalesce("root", "id"))
    return joined.select(
        F.col("id").alias(key),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.col("root").alias("component_id"),
        F.coalesce(F.col("id") == F.col("root"), F.lit(False)).alias("kept"),
    )
