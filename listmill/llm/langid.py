"""Language identification by rank-order profiles (operator 3).

A profile holds the most frequent n-grams of one to three letters of a language, in order; words are padded with a blank. A
document gets the same list from its whole text, and the language whose profile is least out of place: for each n-gram of the
document the difference of its two ranks, or the length of the profile where that does not have it.

Profiles are learned from a bounded sample of labelled rows; every document is predicted from all of its text.

Defined results: a null text, or one without a letter, is ``und`` with score 0; ties between languages go to the first name
in order, ties between n-grams to the smaller code; repeated rows are predicted as often as they occur; without any labelled
row all is ``und``. Columns beside key, text and (in training) language are not looked at.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listmill.llm.arrays import bytes_of, pieces, small_batches
from listmill.llm.pretokens import LETTER, classes

# Rows that a language's profile is learned from, on average; the labelled rows beyond it are not looked at.
ROWS_PER_LANGUAGE = 3_000
# Length of a profile and of a document's list.
LENGTH = 400
# More languages than this are refused: their profiles are sent to every worker.
LANGUAGES = 1_000
UNDETERMINED = "und"
_BITS = 21


@cache
def lower() -> np.ndarray:
    """The code point of every letter's lower case, blank for all that is no letter."""
    table = np.arange(0x110000, dtype=np.uint32)
    letters = np.flatnonzero(classes() == LETTER)
    for c in letters.tolist():
        small = chr(c).lower()
        if len(small) == 1:
            table[c] = ord(small)
    table[classes() != LETTER] = 0
    return table


def letters_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters of the texts, one 0 between words and around each text, and the text of each."""
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    at = np.searchsorted(lead, offsets)
    lengths = np.diff(at)
    rows = len(lengths)
    # each text gets a blank before it, and the last one after it
    stream = np.zeros(len(points) + rows + 1, np.uint32)
    owner = np.repeat(np.arange(rows, dtype=np.int64), lengths)
    stream[np.arange(len(points)) + owner + 1] = lower()[points]
    row = np.repeat(np.arange(rows, dtype=np.int64), lengths + 1)
    row = np.append(row, rows)
    keep = np.ones(len(stream), bool)
    keep[1:] = (stream[1:] != 0) | (stream[:-1] != 0)
    return stream[keep], row[keep]


def grams(codes: np.ndarray, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For n = 1, 2, 3: the place of a letter of each n-gram and its code. An n-gram lies within one padded word."""
    codes = codes.astype(np.int64)
    one = np.flatnonzero(codes != 0)
    two = np.flatnonzero((codes[1:] != 0) | (codes[:-1] != 0))
    three = np.flatnonzero(codes[1:-1] != 0)
    return [
        (one, codes[one]),
        (two + (codes[two] == 0), (codes[two] << bits) | codes[two + 1]),
        (three + 1, (codes[three] << (2 * bits)) | (codes[three + 1] << bits) | codes[three + 2]),
    ]


def _counted(df: DataFrame, language: str, text: str) -> DataFrame:
    """language, n (length), gram (code), times: counted per piece and then summed."""
    schema = "language string, n int, gram long, times long"

    def task(batches):
        for batch in batches:
            data, offsets = bytes_of(batch.column("text"))
            names, index = np.unique(np.array(batch.column("language").to_pylist(), object), return_inverse=True)
            for low, high in pieces(offsets):
                part = offsets[low : high + 1]
                codes, row = letters_of(data[part[0] : part[-1]], part - part[0])
                owner = np.append(index[low:high], 0)[row]
                for n, (at, gram) in enumerate(grams(codes, _BITS), start=1):
                    for k in np.unique(owner[at]):
                        found, times = np.unique(gram[owner[at] == k], return_counts=True)
                        yield pa.RecordBatch.from_pydict({
                            "language": [names[k]] * len(found), "n": np.full(len(found), n, np.int32),
                            "gram": found, "times": times.astype(np.int64),
                        })

    rows = small_batches(df).select(F.col(language).alias("language"), F.col(text).alias("text"))
    return rows.mapInArrow(task, schema).groupBy("language", "n", "gram").agg(F.sum("times").alias("times"))


class Profiles:
    """Rank lists of all languages, for looking up many n-grams at once."""

    def __init__(self, rows: list[tuple[str, int, int, int]], length: int = LENGTH):
        """rows: language, n, gram code, rank from 0."""
        self.length = length
        self.names = sorted({r[0] for r in rows})
        place = {name: k for k, name in enumerate(self.names)}
        shift = [(gram >> (_BITS * k)) & ((1 << _BITS) - 1) for _, _, gram, _ in rows for k in range(3)]
        self.alphabet = np.array(sorted(set(shift) - {0}), np.int64)
        # codes: 0 blank, 1.. the letters of the profiles, then one for all other letters
        self.bits = int(len(self.alphabet) + 1).bit_length()
        table = {int(c): k + 1 for k, c in enumerate(self.alphabet)} | {0: 0}
        keyed: dict[int, np.ndarray] = {}
        for name, n, gram, rank in rows:
            code = n
            for k in (2, 1, 0):
                code = (code << self.bits) | table[(gram >> (_BITS * k)) & ((1 << _BITS) - 1)]
            ranks = keyed.setdefault(code, np.full(len(self.names), -1, np.int64))
            ranks[place[name]] = rank
        self.keys = np.array(sorted(keyed), np.int64)
        self.ranks = np.array([keyed[int(k)] for k in self.keys], np.int64).reshape(len(keyed), len(self.names))

    def code(self, points: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.alphabet, points), len(self.alphabet) - 1)
        out = np.where(self.alphabet[at] == points, at + 1, len(self.alphabet) + 1)
        return np.where(points == 0, 0, out)

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each text the index of its language, -1 where there is none, and the score."""
        rows = len(offsets) - 1
        best, score = np.full(rows, -1), np.zeros(rows)
        if not self.names or not len(data):
            return best, score
        points, row = letters_of(data, offsets)
        used, back = np.unique(points, return_inverse=True)
        codes = self.code(used.astype(np.int64))[back]
        room = 3 * self.bits + 2
        keys = np.concatenate([
            (row[at] << room) | (n << (3 * self.bits)) | gram
            for n, (at, gram) in enumerate(grams(codes, self.bits), start=1)
        ])
        if not len(keys):
            return best, score
        keys.sort()
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        times = np.diff(np.append(first, len(keys)))
        keys = keys[first]
        owner = keys >> room
        # most frequent first within each text; equal counts stay in the order of their codes
        order = np.argsort((owner << 32) | (0xFFFFFFFF - times), kind="stable")
        keys, owner = keys[order], owner[order]
        begin = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        rank = np.arange(len(keys)) - np.repeat(begin, np.diff(np.append(begin, len(keys))))
        near = rank < self.length
        keys, owner, rank = keys[near] & ((1 << room) - 1), owner[near], rank[near]
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        there = np.where((self.keys[at] == keys)[:, None], self.ranks[at], -1)
        apart = np.where(there >= 0, np.abs(there - rank[:, None]), self.length)
        begin = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        total = np.add.reduceat(apart, begin, axis=0)
        size = np.diff(np.append(begin, len(owner)))
        who = owner[begin]
        best[who] = total.argmin(axis=1)
        score[who] = 1 - total.min(axis=1) / (size * self.length)
        return best, score


def sample(labelled: DataFrame, key: str, language: str, rows: int) -> DataFrame:
    """About ``rows`` rows of each language, chosen by a hash of the key."""
    sizes = labelled.groupBy(language).count().limit(LANGUAGES + 1).collect()
    if len(sizes) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    share = F.lit(0)
    for name, n in sizes:
        share = F.when(F.col(language) == name, int(min(1.0, rows / n) * (1 << 20))).otherwise(share)
    return labelled.filter(F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(1 << 20)) < share)


def learn(
    labelled: DataFrame, key: str = "doc_id", text: str = "text", language: str = "lang",
    rows: int = ROWS_PER_LANGUAGE, length: int = LENGTH,
) -> Profiles:
    """Profiles of the languages of the labelled rows."""
    known = labelled.filter(F.col(language).isNotNull() & F.col(text).isNotNull())
    counted = _counted(sample(known, key, language, rows), language, text)
    order = Window.partitionBy("language").orderBy(F.desc("times"), "n", "gram")
    ranked = counted.withColumn("rank", F.row_number().over(order) - 1).filter(F.col("rank") < length)
    found = ranked.select("language", "n", "gram", "rank").collect()
    return Profiles([tuple(r) for r in found], length)


def predict(df: DataFrame, profiles: Profiles, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, lang_pred and score of every row."""
    sent = df.sparkSession.sparkContext.broadcast(profiles)
    narrow = small_batches(df).select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([
        narrow.schema["key"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
    ])

    def task(batches):
        own = sent.value
        names = np.array([*own.names, UNDETERMINED], object)
        for batch in batches:
            data, offsets = bytes_of(batch.column("text"))
            best, score = [np.zeros(0, np.int64)], [np.zeros(0)]
            for low, high in pieces(offsets):
                part = offsets[low : high + 1]
                b, s = own.predict(data[part[0] : part[-1]], part - part[0])
                best.append(b), score.append(s)
            arrays = [batch.column("key"), pa.array(names[np.concatenate(best)], pa.string()), pa.array(np.concatenate(score))]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return narrow.mapInArrow(task, schema).withColumnRenamed("key", key)


def keep(df: DataFrame, profiles: Profiles, least: float, text: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text has a language with a score of ``least`` or more."""
    sent = df.sparkSession.sparkContext.broadcast(profiles)
    place = df.columns.index(text)

    def task(batches):
        own = sent.value
        for batch in batches:
            data, offsets = bytes_of(batch.column(place))
            good = [np.zeros(0, bool)]
            for low, high in pieces(offsets):
                part = offsets[low : high + 1]
                best, score = own.predict(data[part[0] : part[-1]], part - part[0])
                good.append((best >= 0) & (score >= least))
            yield batch.filter(pa.array(np.concatenate(good)))

    return small_batches(df).mapInArrow(task, df.schema)


def held_out(key: str = "doc_id"):
    """Whether the CRC-32 of the key's text divides by 5; a null key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score, learned from the labelled documents that are not held out."""
    profiles = learn(docs.filter(~held_out()))
    return predict(docs, profiles).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
