"""Ranked lexical search over a length-stratified index (operator 13).

Documents with an equal normaliser ``m`` are a stratum, cut into blocks of bounded size. A block's index row holds its documents and,
for every term, one posting list for each number of occurrences ``tf``. Within a stratum the impact of a posting depends on tf
alone, so impacts are computed once for each tf of a block, and the best that a stratum can give an item follows from the largest tf
of each term.

These bounds order the visits of an item: strata are visited from the highest bound on until they hold OPENING documents. The k-th
best score found so far is the item's threshold, and then all strata, and blocks within them, whose bound reaches it are visited.
No document that could be among the best is left out.

Items are a stated query set, taken in blocks of a bounded number of terms whose terms go to all tasks; the documents are read once
for each such block. Only numbers of terms, occurrences and documents are shuffled, never texts.

Defined results: a null or empty text holds no term and is never found; repeated documents are documents of their own, in either
order where their ids are equal; a null doc_id comes first among equal scores; items that share an id are one item with the terms of
all their texts, the null id included; an item without terms has no rows, nor has one whose terms no document holds; columns beside
ids and texts are not looked at.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listmill.llm.arrays import bytes_of, expand, pieces, slice_hashes, small_batches
from listmill.session import fresh_dir, settle

BEST = 50
# Terms of items that are searched together, documents of an index row, and documents of an item's opening visits.
TERMS, BLOCK, OPENING = 1 << 18, 4096, 2000
# Fixed value: what a term is.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_TERM = np.zeros(256, bool)
_IN_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def term_slices(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text of every term of the concatenated texts."""
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    inside = _IN_TERM[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begin, end = inside & edge[:-1], inside & edge[1:]
    begin[1:] |= inside[1:] & ~inside[:-1]
    end[:-1] |= inside[:-1] & ~inside[1:]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


class Vocabulary:
    """The terms asked for, found by hash and then by their bytes."""

    def __init__(self, terms: list[str]):
        raw = [t.encode() for t in terms]
        sizes = np.array([len(t) for t in raw], np.int64)
        ends = np.cumsum(sizes)
        self.data = np.frombuffer(b"".join(raw), np.uint8)
        hashes = slice_hashes(self.data, ends - sizes, ends)
        self.order = np.argsort(hashes, kind="stable")
        self.hashes, self.starts, self.sizes = hashes[self.order], (ends - sizes)[self.order], sizes[self.order]
        if (self.hashes[1:] == self.hashes[:-1]).any():
            raise ValueError("two terms share a hash")

    def look(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which slices are terms, and the number of the term."""
        hashes = slice_hashes(data, starts, ends)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        hit = np.flatnonzero((self.hashes[at] == hashes) & (self.sizes[at] == ends - starts))
        at = at[hit]
        if not len(hit):
            return hit, at
        sizes = self.sizes[at]
        same = data[expand(starts[hit], sizes)] == self.data[expand(self.starts[at], sizes)]
        whole = np.logical_and.reduceat(same, np.cumsum(sizes) - sizes)
        return hit[whole], self.order[at[whole]]


@dataclass
class Items:
    """Items of one block: the terms of item i are ``terms[bounds[i]:bounds[i + 1]]`` with their weights."""

    terms: np.ndarray
    weights: np.ndarray
    bounds: np.ndarray

    def best(self, impacts: np.ndarray) -> np.ndarray:
        """The sum of weight and impact over the terms of each item; impacts: by number of term."""
        total = np.concatenate(([0], np.cumsum(self.weights * impacts[self.terms])))
        return np.diff(total[self.bounds])


def impact(tf, m):
    """What a term of weight 1 gives a document; exact in 64-bit integers."""
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


@dataclass
class Index:
    """Folder of the index rows, the vocabulary's document frequencies, and the numbers of documents and of terms."""

    spark: SparkSession
    folder: str
    df: np.ndarray
    documents: int
    length: int

    def rows(self) -> DataFrame:
        return self.spark.read.parquet(self.folder)

    def weights(self) -> np.ndarray:
        return np.array([math.floor(1000 * math.log((2 * self.documents + 2) / (2 * int(d) + 1))) for d in self.df], np.int64)


_FORWARD = "doc_id long, n long, terms array<int>, tfs array<int>"


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum(counts)))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))


def forward(docs: DataFrame, terms: list[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, the number of its terms, and the numbers and occurrences of those that are asked for, of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(Vocabulary(terms))
    narrow = small_batches(docs).select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    most = len(terms)

    def task(batches):
        known = sent.value
        for batch in batches:
            data, offsets = bytes_of(batch.column("text"))
            for low, high in pieces(offsets):
                at = offsets[low : high + 1]
                piece, at = _LOWER[data[at[0] : at[-1]]], at - at[0]
                starts, ends, row = term_slices(piece, at)
                hit, number = known.look(piece, starts, ends)
                pairs, tfs = np.unique(row[hit] * most + number, return_counts=True)
                held = np.bincount(pairs // most, minlength=high - low)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(low, high - low),
                        pa.array(np.bincount(row, minlength=high - low), pa.int64()),
                        _lists(pairs % most, held), _lists(tfs, held),
                    ],
                    names=["doc_id", "n", "terms", "tfs"],
                )

    return narrow.mapInArrow(task, _FORWARD)


_INDEX = (
    "m long, part int, docs array<long>, places array<int>, terms array<int>, tfs array<int>, sizes array<int>, "
    "asked array<int>, most array<int>"
)


def _indexed(data: pa.Table) -> pa.Table:
    """The index row of a block: runs of documents by term and tf, and the largest tf of each term."""
    lists = data.column("terms").combine_chunks()
    counts = np.diff(lists.offsets.to_numpy())
    terms = lists.flatten().to_numpy().astype(np.int64)
    tfs = data.column("tfs").combine_chunks().flatten().to_numpy().astype(np.int64)
    places = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((places, tfs, terms))
    terms, tfs, places = terms[order], tfs[order], places[order]
    begin = np.flatnonzero(np.concatenate(([True], (terms[1:] != terms[:-1]) | (tfs[1:] != tfs[:-1]))))
    sizes = np.diff(np.append(begin, len(terms)))
    run_terms, run_tfs = terms[begin], tfs[begin]
    last = np.flatnonzero(np.concatenate((run_terms[1:] != run_terms[:-1], [True])))
    one = lambda x: pa.array([x.astype(np.int32)], pa.list_(pa.int32()))
    return pa.table({
        "m": data.column("m").slice(0, 1), "part": data.column("part").slice(0, 1),
        "docs": pa.array([data.column("doc_id").to_pylist()], pa.list_(pa.int64())), "places": one(places),
        "terms": one(run_terms), "tfs": one(run_tfs), "sizes": one(sizes), "asked": one(run_terms[last]), "most": one(run_tfs[last]),
    })


def build(docs: DataFrame, terms: list[str], key: str = "doc_id", text: str = "text") -> Index:
    """Index every document by its length and the occurrences of ``terms``."""
    spark = docs.sparkSession
    narrow = fresh_dir(spark, "forward")
    forward(docs, terms, key, text).write.parquet(narrow)
    rows = spark.read.schema(_FORWARD).parquet(narrow)
    documents, length = rows.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(terms), np.int64)
    for r in rows.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[r["term"]] = r["count"]
    folder = fresh_dir(spark, "index")
    m = F.expr(f"50 + ((50 * n * {documents}L) div {max(length, 1)}L)")
    # the place in the stored table spreads equal documents over the blocks of their stratum
    placed = rows.withColumns({"m": m, "salt": F.xxhash64(F.monotonically_increasing_id())}).filter(F.size("terms") > 0)
    strata = placed.groupBy("m").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts"))
    placed = placed.join(strata, "m").withColumn("part", F.pmod("salt", F.col("parts")).cast("int"))
    blocks = placed.select("m", "part", "doc_id", "terms", "tfs").groupBy("m", "part")
    blocks.applyInArrow(_indexed, _INDEX).write.parquet(folder)
    return Index(spark, folder, df, documents, length)


_FOUND = "item int, doc_id long, score long"


def _visited(visits: DataFrame, index: Index, asked, k: int) -> DataFrame:
    """The k best documents of each visited block that reach the item's threshold; visits: m, item and least."""
    per = visits.groupBy("m").agg(F.sort_array(F.collect_list(F.struct("item", "least"))).alias("visits"))
    rows = index.rows().join(per, "m").select(
        "m", "docs", "places", "terms", "tfs", "sizes", "asked", "most",
        F.col("visits.item").alias("items"), F.col("visits.least").alias("least"),
    )
    small_batches(rows)
    index.spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")

    def task(batches):
        items = asked.value
        impacts = np.zeros(int(items.terms.max()) + 1, np.int64)
        for batch in batches:
            columns = {c: batch.column(c) for c in batch.schema.names}
            for k_row in range(batch.num_rows):
                row = {c: columns[c][k_row].values for c in columns if c not in ("m", "docs")}
                row = {c: v.to_numpy(zero_copy_only=False).astype(np.int64) for c, v in row.items()}
                m, docs = columns["m"][k_row].as_py(), columns["docs"][k_row].values
                impacts[:] = 0
                impacts[row["asked"]] = impact(row["most"], m)
                bound = items.best(impacts)[row["items"]]
                # once for each tf of the block
                kinds, back = np.unique(row["tfs"], return_inverse=True)
                gain = impact(kinds, m)[back]
                begin = np.cumsum(row["sizes"]) - row["sizes"]
                low = np.searchsorted(row["terms"], row["asked"])
                high = np.append(low[1:], len(row["terms"]))
                null = np.array(docs.is_null())
                ids = docs.fill_null(0).to_numpy()
                out = []
                for item, least, most in zip(row["items"].tolist(), row["least"].tolist(), bound.tolist(), strict=True):
                    if most < max(least, 1):
                        continue
                    span = slice(items.bounds[item], items.bounds[item + 1])
                    terms = items.terms[span]
                    at = np.minimum(np.searchsorted(row["asked"], terms), len(low) - 1)
                    there = row["asked"][at] == terms
                    at, weight = at[there], items.weights[span][there]
                    runs = expand(low[at], high[at] - low[at])
                    value = gain[runs] * np.repeat(weight, high[at] - low[at])
                    score = np.zeros(len(ids), np.int64)
                    np.add.at(score, row["places"][expand(begin[runs], row["sizes"][runs])], np.repeat(value, row["sizes"][runs]))
                    some = np.flatnonzero(score >= max(least, 1))
                    if len(some) > k:
                        some = some[score[some] >= np.partition(score[some], len(some) - k)[len(some) - k]]
                    if len(some):
                        some = some[np.lexsort((ids[some], ~null[some], -score[some]))][:k]
                        out.append((np.full(len(some), item), ids[some], null[some], score[some]))
                if out:
                    item, ids, null, score = (np.concatenate(x) for x in zip(*out, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(item, pa.int32()), pa.array(ids, pa.int64(), mask=null), pa.array(score, pa.int64())],
                        names=["item", "doc_id", "score"],
                    )

    return rows.mapInArrow(task, _FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search_block(docs: DataFrame, terms_of: list[list[str]], k: int = BEST, key: str = "doc_id", text: str = "text") -> DataFrame:
    """item (its number in ``terms_of``), rank, doc_id and score of the best documents of each item."""
    spark = docs.sparkSession
    terms = sorted({t for some in terms_of for t in some})
    number = {t: n for n, t in enumerate(terms)}
    index = build(docs, terms, key, text)
    flat = np.array([number[t] for some in terms_of for t in sorted(some)], np.int64)
    bounds = np.concatenate(([0], np.cumsum([len(some) for some in terms_of]))).astype(np.int64)
    asked = spark.sparkContext.broadcast(Items(flat, index.weights()[flat], bounds))

    def bound(data: pa.Table) -> pa.Table:
        items, m = asked.value, data.column("m")[0].as_py()
        impacts = np.zeros(int(items.terms.max()) + 1, np.int64)
        impacts[data.column("term").to_numpy()] = impact(data.column("most").to_numpy().astype(np.int64), m)
        best = items.best(impacts)
        some = np.flatnonzero(best)
        return pa.table({"m": pa.array(np.full(len(some), m)), "item": pa.array(some, pa.int32()), "bound": pa.array(best[some], pa.int64())})

    stored = index.rows()
    largest = stored.select("m", F.explode(F.arrays_zip("asked", "most")).alias("t"))
    largest = largest.groupBy("m", F.col("t.asked").alias("term")).agg(F.max("t.most").alias("most"))
    bounds_of = largest.groupBy("m").applyInArrow(bound, "m long, item int, bound long")
    sizes = stored.groupBy("m").agg(F.sum(F.size("docs")).alias("docs"))
    strata = settle(bounds_of.join(sizes, "m"))
    # an item has one row for each stratum, of which there are as many as different lengths
    ahead = Window.partitionBy("item").orderBy(F.col("bound").desc(), "m").rowsBetween(Window.unboundedPreceding, -1)
    strata = settle(strata.withColumn("opening", F.coalesce(F.sum("docs").over(ahead), F.lit(0)) < OPENING))
    first = settle(_visited(strata.filter("opening").select("m", "item", F.lit(1).cast("long").alias("least")), index, asked, k))
    least = _ranked(first, k).filter(F.col("rank") == k).select("item", F.col("score").alias("least"))
    rest = strata.filter("not opening").join(least, "item", "left").withColumn("least", F.coalesce("least", F.lit(1)).cast("long"))
    rest = rest.filter(F.col("bound") >= F.col("least")).select("m", "item", "least")
    second = _visited(rest, index, asked, k)
    return _ranked(first.union(second), k).select("item", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(
    docs: DataFrame, items: DataFrame, k: int = BEST, item: str = "item_id", key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """item, rank, doc_id and score of the ``k`` best documents of each item, best first."""
    spark = docs.sparkSession
    lowered = F.translate(F.coalesce(F.col(text).cast("string"), F.lit("")), UPPER, LOWER)
    terms = F.array_distinct(F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0)))
    asked = items.select(F.col(item).alias("item_id"), terms.alias("terms")).groupBy("item_id")
    asked = asked.agg(F.array_distinct(F.flatten(F.collect_list("terms"))).alias("terms")).filter(F.size("terms") > 0)
    asked = settle(asked)
    parts = -(-(asked.agg(F.sum(F.size("terms"))).first()[0] or 0) // TERMS)
    schema = T.StructType([T.StructField("item", T.IntegerType()), asked.schema["item_id"]])
    found = None
    for part in range(max(1, parts)):
        # at most about TERMS terms
        rows = asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(max(1, parts))) == part).collect()
        names = spark.createDataFrame([(n, r["item_id"]) for n, r in enumerate(rows)], schema)
        if rows:
            best = search_block(docs, [r["terms"] for r in rows], k, key, text)
        else:
            best = spark.createDataFrame([], "item int, rank int, doc_id long, score long")
        best = best.join(F.broadcast(names), "item").select(F.col("item_id").alias(item), "rank", "doc_id", "score")
        found = best if found is None else found.union(best)
    return found


SQL = rf"""
WITH words AS (
    SELECT row_number() OVER () AS row, doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term
    FROM documents
), counted AS (
    SELECT row, any_value(doc_id) AS doc_id, term, count(*) AS tf, sum(count(*)) OVER (PARTITION BY row)::BIGINT AS n
    FROM words GROUP BY row, term
), whole AS (
    SELECT count(DISTINCT row) AS documents, count(*) AS length FROM words
), asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term FROM benchmark
), weights AS (
    SELECT term, floor(1000 * ln((2 * any_value(documents) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
    FROM counted, whole GROUP BY term
), scored AS (
    SELECT item_id, row, any_value(doc_id) AS doc_id,
        sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * documents) // length))))::BIGINT AS score
    FROM asked JOIN weights USING (term) JOIN counted USING (term), whole
    GROUP BY item_id, row
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY rank <= {BEST}
"""
