"""Token counts by rank-synchronous array merging (operator 10).

Texts become pre-tokens, equal pre-tokens of a piece are merged once, and all of them are merged together: every round
applies to each sequence the pair of lowest rank that it has. What is left of a sequence is its number of tokens.

Defined results: a null text counts as empty, with 0 bytes and 0 tokens; an added token of the vocabulary inside a text (such
as its end-of-text mark) is one token; repeated rows are counted as often as they occur; columns beside the key and the text
are not looked at.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listmill.llm.arrays import bytes_of, distinct_slices, expand, pieces, small_batches
from listmill.llm.bpe import Growing, Remembered, read_file
from listmill.llm.pretokens import Merges, merge, split


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary: itself, or one from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = [""] * 256
    for b in plain:
        letters[b] = chr(b)
    for n, b in enumerate(b for b in range(256) if b not in set(plain)):
        letters[b] = chr(256 + n)
    return letters


class Counter:
    """Counts tokens as the vocabulary file gives them."""

    def __init__(self, data: bytes):
        tokenizer = json.loads(data)
        model, before = tokenizer["model"], tokenizer["pre_tokenizer"]
        if model["type"] != "BPE" or before["type"] != "ByteLevel" or before["add_prefix_space"] or tokenizer["normalizer"]:
            raise ValueError("only byte-level BPE without a prefix space or normalizer is handled")
        vocabulary = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merges = Merges(
            [vocabulary[a] for a, _ in pairs], [vocabulary[b] for _, b in pairs],
            range(len(pairs)), [vocabulary[a + b] for a, b in pairs],
        )
        self.byte = np.array([vocabulary[c] for c in byte_letters()], np.int32)
        if any(t.get(f) for t in tokenizer["added_tokens"] for f in ("lstrip", "rstrip", "single_word", "normalized")):
            raise ValueError("added tokens that take blanks, stand alone or are normalised are not handled")
        self.added = sorted((t["content"].encode() for t in tokenizer["added_tokens"]), key=len, reverse=True)
        self.cache, self.size = Remembered(), Growing(np.int64)

    def _count(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each text, none of which holds an added token."""
        if not len(data):
            return np.zeros(len(offsets) - 1, np.int64)
        starts, ends = split(data, offsets)
        hashes, first, back = distinct_slices(data, starts, ends)
        number = self.cache.look(hashes, data, starts[first], ends[first])
        missing = np.flatnonzero(number < 0)
        if len(missing):
            if self.cache.full(len(missing)):
                self.cache, self.size = Remembered(), Growing(np.int64)
                missing = np.arange(len(hashes))
            rows = first[missing]
            sizes = ends[rows] - starts[rows]
            self.size.add(merge(self.byte[data[expand(starts[rows], sizes)]], sizes, self.merges)[1])
            number[missing] = self.cache.add(hashes[missing], data, starts[rows], ends[rows])
        found = self.size.data[number]
        total = np.concatenate(([0], np.cumsum(found[back])))
        return np.diff(total[np.searchsorted(starts, offsets)])

    def count(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each text; an added token counts one and parts what stands around it."""
        raw = data.tobytes()
        cuts = []
        for token in self.added:
            at = raw.find(token)
            while at >= 0:
                row = int(np.searchsorted(offsets, at, side="right")) - 1
                if at + len(token) <= offsets[row + 1]:
                    cuts.append((at, at + len(token), row))
                at = raw.find(token, at + 1)
        if not cuts:
            return self._count(data, offsets)
        # the leftmost, of those the longest; none inside another
        cuts.sort(key=lambda c: (c[0], -c[1]))
        kept, end = [], 0
        for low, high, row in cuts:
            if low >= end:
                kept.append((low, high, row))
                end = high
        bounds = np.unique(np.concatenate([offsets, [x for low, high, _ in kept for x in (low, high)]]))
        counts = self._count(data, bounds)
        counts[np.searchsorted(bounds, [low for low, _, _ in kept])] = 1
        total = np.concatenate(([0], np.cumsum(counts)))
        return np.diff(total[np.searchsorted(bounds, offsets)])


@lru_cache(maxsize=2)
def counter(data: bytes) -> Counter:
    """The counter of a vocabulary file; a worker builds it once."""
    return Counter(data)


def token_counts(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = 1024) -> DataFrame:
    """key, n_bytes, n_tokens and whether the tokens exceed ``limit``, for every row."""
    sent = df.sparkSession.sparkContext.broadcast(read_file(path))
    narrow = small_batches(df).select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([
        narrow.schema["key"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()),
    ])

    def task(batches):
        own = counter(sent.value)
        for batch in batches:
            data, offsets = bytes_of(batch.column("text"))
            counts = [np.zeros(0, np.int64)]
            for low, high in pieces(offsets):
                part = offsets[low : high + 1]
                counts.append(own.count(data[part[0] : part[-1]], part - part[0]))
            arrays = [batch.column("key"), pa.array(np.diff(offsets)), pa.array(np.concatenate(counts))]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return narrow.mapInArrow(task, schema).select(
        F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
