"""Byte-level BPE encoding and decoding (operator 7).

Pre-tokens are located by ``pretokens.split``. Each distinct pre-token of a piece is looked up in a bounded cache; those not
there are merged together as ragged arrays and enter the cache. Token offsets come with the ids, so that a slice of ids
decodes to the bytes it was made from.

Defined results: a null text counts as empty and has no ids; repeated rows are encoded as often as they occur; columns beside
the key and the text are not looked at, and a text column of any name can be given.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listmill.llm.arrays import bytes_of, differing, distinct_slices, expand, pieces, slice_hashes, small_batches
from listmill.llm.pretokens import Merges, merge, split

# Distinct pre-tokens a worker remembers, and their bytes; beyond that it starts afresh. Only speed depends on it.
CACHE_ENTRIES, CACHE_BYTES = 200_000, 8 << 20
# A vocabulary is sent to every worker; a larger file than this is refused.
VOCABULARY_BYTES = 64 << 20


def read_file(path: str) -> bytes:
    """A vocabulary file, read on the driver and refused beyond the size that may be broadcast."""
    with open(path, "rb") as file:
        data = file.read(VOCABULARY_BYTES + 1)
    if len(data) > VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {VOCABULARY_BYTES} bytes")
    return data


def ranks_of(data: bytes) -> dict[bytes, int]:
    """Token bytes and rank of each line of a rank file."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


class Growing:
    """An array that is appended to."""

    def __init__(self, kind):
        self.data, self.size = np.zeros(1 << 12, kind), 0

    def add(self, values: np.ndarray) -> None:
        if self.size + len(values) > len(self.data):
            self.data = np.concatenate([self.data[: self.size], np.zeros(self.size + 2 * len(values), self.data.dtype)])
        self.data[self.size : self.size + len(values)] = values
        self.size += len(values)


class Remembered:
    """Numbers of slices seen before, by hash and then by their bytes; to be emptied when full."""

    def __init__(self, most: int = CACHE_ENTRIES, bytes_held: int = CACHE_BYTES):
        self.most, self.bytes_held = most, bytes_held
        # an open-addressed table of numbers, by the leading bits of the hash, and the hash of each
        self.table, self.hashes = np.full(1 << 12, -1, np.int32), Growing(np.uint64)
        self.raw, self.begin, self.length = Growing(np.uint8), Growing(np.int64), Growing(np.int64)

    def _home(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(65 - len(self.table).bit_length())).astype(np.int64)

    def look(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of each slice, -1 where it is not there."""
        place = self._home(hashes)
        out = self.table[place]
        rest = np.flatnonzero((out >= 0) & (self.hashes.data[out] != hashes))
        while len(rest):
            place[rest] = (place[rest] + 1) & (len(self.table) - 1)
            out[rest] = there = self.table[place[rest]]
            rest = rest[(there >= 0) & (self.hashes.data[there] != hashes[rest])]
        out = out.astype(np.int64)
        hit = np.flatnonzero(out >= 0)
        if len(hit):
            sizes = ends[hit] - starts[hit]
            same = self.length.data[out[hit]] == sizes
            out[hit[~same]] = -1
            hit, sizes = hit[same], sizes[same]
            wrong = differing(data, starts[hit], sizes, self.raw.data[: self.raw.size], self.begin.data[out[hit]])
            out[hit[wrong]] = -1
        return out

    def _enter(self, numbers: np.ndarray) -> None:
        """Numbers go to the next free place; one whose hash another number has is left out, as only the first would be found."""
        hashes = self.hashes.data[numbers]
        place = self._home(hashes)
        while len(numbers):
            free = self.table[place] < 0
            self.table[place[free]] = numbers[free]
            rest = np.flatnonzero(self.hashes.data[self.table[place]] != hashes)
            numbers, hashes, place = numbers[rest], hashes[rest], (place[rest] + 1) & (len(self.table) - 1)

    def add(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Remember the slices and return their numbers, which follow those before."""
        numbers = self.begin.size + np.arange(len(hashes))
        sizes = ends - starts
        self.begin.add(self.raw.size + np.cumsum(sizes) - sizes)
        self.length.add(sizes)
        self.raw.add(data[expand(starts, sizes)])
        self.hashes.add(hashes)
        if 2 * self.hashes.size > len(self.table):
            self.table = np.full(1 << (3 * self.hashes.size).bit_length(), -1, np.int32)
            self._enter(np.arange(self.hashes.size))
        else:
            self._enter(numbers)
        return numbers

    def full(self, more: int) -> bool:
        return self.begin.size + more > self.most or self.raw.size > self.bytes_held


class Codec:
    """Encodes and decodes by a table of ranks."""

    def __init__(self, ranks: dict[bytes, int]):
        self.tokens = [b""] * (max(ranks.values()) + 1)
        left, right, rank = [], [], []
        for token, r in ranks.items():
            self.tokens[r] = token
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), rank.append(r)
        self.lengths = np.array([len(t) for t in self.tokens], np.int64)
        self.decimal = [str(i) for i in range(len(self.tokens))]
        self.merges = Merges(left, right, rank, rank)
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        ends = np.cumsum(self.lengths)
        self.letters, self.begins = np.frombuffer(b"".join(self.tokens), np.uint8), ends - self.lengths
        hashes = slice_hashes(self.letters, self.begins, ends)
        order = np.argsort(hashes)
        self.whole = hashes[order], order.astype(np.int32)
        self.forget()

    def forget(self):
        self.cache, self.ids, self.begin, self.size = Remembered(), Growing(np.int32), Growing(np.int64), Growing(np.int64)

    def _fresh(self, data, starts, ends, hashes) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pre-tokens: the token itself where the whole is one, else by merging its bytes."""
        known, ids = self.whole
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        whole = (known[at] == hashes) & (self.lengths[ids[at]] == ends - starts)
        some = np.flatnonzero(whole)
        whole[some[differing(data, starts[some], (ends - starts)[some], self.letters, self.begins[ids[at[some]]])]] = False
        lengths = np.ones(len(starts), np.int64)
        rest = np.flatnonzero(~whole)
        sizes = ends[rest] - starts[rest]
        merged, left = merge(self.byte[data[expand(starts[rest], sizes)]], sizes, self.merges)
        lengths[rest] = left
        out = np.empty(int(lengths.sum()), np.int32)
        begin = np.cumsum(lengths) - lengths
        out[begin[whole]] = ids[at[whole]]
        out[expand(begin[rest], left)] = merged
        return out, lengths

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the concatenated texts and the number of ids of each text."""
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(offsets) - 1, np.int64)
        starts, ends = split(data, offsets)
        hashes, first, back = distinct_slices(data, starts, ends)
        number = self.cache.look(hashes, data, starts[first], ends[first])
        missing = np.flatnonzero(number < 0)
        if len(missing):
            if self.cache.full(len(missing)):
                self.forget()
                missing = np.arange(len(hashes))
            rows = first[missing]
            ids, lengths = self._fresh(data, starts[rows], ends[rows], hashes[missing])
            self.begin.add(self.ids.size + np.cumsum(lengths) - lengths)
            self.size.add(lengths)
            self.ids.add(ids)
            number[missing] = self.cache.add(hashes[missing], data, starts[rows], ends[rows])
        number = number[back]
        lengths = self.size.data[number]
        ids = self.ids.data[expand(self.begin.data[number], lengths)]
        total = np.concatenate(([0], np.cumsum(lengths)))
        bounds = total[np.searchsorted(starts, offsets)]
        return ids, np.diff(bounds)

    def offsets(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The byte at which each token starts in its text."""
        sizes = self.lengths[ids]
        before = np.cumsum(sizes) - sizes
        begin = np.cumsum(counts) - counts
        base = np.zeros(len(counts), np.int64)
        some = counts > 0
        base[some] = before[begin[some]]
        return before - np.repeat(base, counts)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(data: bytes) -> Codec:
    """The codec of a rank file; a worker builds it once."""
    return Codec(ranks_of(data))


def _keyed(df: DataFrame, key: str, text: str) -> DataFrame:
    return small_batches(df).select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))


def _run(df: DataFrame, key: str, text: str, path: str, columns: list[T.StructField], make) -> DataFrame:
    """``make(codec, ids, counts)`` gives the Arrow columns beside the key for a piece of texts."""
    sent = df.sparkSession.sparkContext.broadcast(read_file(path))
    narrow = _keyed(df, key, text)
    schema = T.StructType([T.StructField("key", narrow.schema["key"].dataType), *columns])

    def task(batches):
        own = codec(sent.value)
        for batch in batches:
            data, offsets = bytes_of(batch.column("text"))
            keys = batch.column("key")
            for low, high in pieces(offsets):
                part = offsets[low : high + 1]
                ids, counts = own.encode(data[part[0] : part[-1]], part - part[0])
                arrays = [keys.slice(low, high - low), *make(own, ids, counts)]
                yield pa.RecordBatch.from_arrays(arrays, names=["key", *(c.name for c in columns)])

    return narrow.mapInArrow(task, schema).withColumnRenamed("key", key)


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum(counts)))
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values.astype(np.int32)))


_IDS = T.StructField("ids", T.ArrayType(T.IntegerType(), False))
_OFFSETS = T.StructField("offsets", T.ArrayType(T.IntegerType(), False))


def encode(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, ids and byte offsets of the tokens of each text, by the rank file at ``path``."""
    return _run(df, key, text, path, [_IDS, _OFFSETS], lambda c, ids, n: [_lists(ids, n), _lists(c.offsets(ids, n), n)])


def decode(df: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """key and the bytes that each array of ids stands for; null where the ids are null or one is not in the vocabulary."""
    sent = df.sparkSession.sparkContext.broadcast(read_file(path))
    narrow = small_batches(df).select(F.col(key).alias("key"), F.col(ids).cast("array<int>").alias("ids"))
    schema = T.StructType([narrow.schema["key"], T.StructField("decoded", T.BinaryType())])

    def task(batches):
        own = codec(sent.value)
        most = len(own.tokens)
        for batch in batches:
            rows = batch.column("ids").to_pylist()
            good = [r is not None and all(i is not None and 0 <= i < most for i in r) for r in rows]
            decoded = [own.decode(r) if ok else None for r, ok in zip(rows, good, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(decoded, pa.binary())], names=["key", "decoded"])

    return narrow.mapInArrow(task, schema).withColumnRenamed("key", key)


def round_trip(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, ids, their decimal form joined by blanks, and the bytes they decode to, in one pass over the texts."""

    def make(own, ids, counts):
        flat, ends = ids.tolist(), np.cumsum(counts).tolist()
        spans = list(zip([0, *ends[:-1]], ends, strict=True))
        words = list(map(own.decimal.__getitem__, flat))
        return [
            _lists(ids, counts),
            pa.array([" ".join(words[a:b]) for a, b in spans], pa.string()),
            pa.array([own.decode(flat[a:b]) for a, b in spans], pa.binary()),
        ]

    columns = [_IDS, T.StructField("decimals", T.StringType()), T.StructField("decoded", T.BinaryType())]
    return _run(df, key, text, path, columns, make)


def digests(spark: SparkSession, docs: DataFrame, path: str) -> DataFrame:
    """doc_id, number of ids, and SHA-256 of the ids and of the decoded bytes."""
    coded = round_trip(docs, path)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.col("decimals").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
