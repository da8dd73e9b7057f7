"""Helpers on the Arrow batches that Spark hands to Python: texts as one byte array, in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bytes of text that a worker turns into numpy arrays at once; one longer text makes a piece of its own.
PIECE_BYTES = 1 << 18
# Rows in an Arrow batch; texts of a megabyte each still fit a worker then.
BATCH_ROWS = 512


def small_batches(df: DataFrame) -> DataFrame:
    """Bound the rows that an Arrow batch holds, for the jobs of this session."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column), F.lit("")).alias("text")


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offset of each row, nulls as empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold at most ``limit`` bytes together, or one row."""
    low, rows = 0, len(offsets) - 1
    while low < rows:
        high = int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1
        high = min(max(high, low + 1), rows)
        yield low, high
        low = high


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; a bijection, so it adds no collisions."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# Two polynomials over bytes modulo a Mersenne prime, at random points: texts that collide by construction modulo a power of two
# do not here, and two slices of ``n`` bytes share both values with a probability of about (n / 2**31) ** 2.
_PRIME = (1 << 31) - 1
_POINTS = (1_308_294_071, 870_436_919)
_powers: list[list[np.ndarray]] = [[], []]
# Below this many bytes the products of a byte and a power can be summed before they are reduced.
_UNREDUCED = 1 << 24


def _fold(x: np.ndarray) -> np.ndarray:
    """A number congruent to ``x``: below 2**31 + 2 after two folds of a number below 2**63."""
    return (x & np.uint64(_PRIME)) + (x >> np.uint64(31))


def _reduced(x: np.ndarray) -> np.ndarray:
    x = _fold(_fold(x))
    return np.where(x >= _PRIME, x - np.uint64(_PRIME), x)


def _power(n: int) -> list[list[np.ndarray]]:
    """The first ``n`` powers of each point and of its inverse, by doubling."""
    if not _powers[0] or len(_powers[0][0]) < n:
        for k, point in enumerate(_POINTS):
            _powers[k] = []
            for base in (point, pow(point, -1, _PRIME)):
                found, step = np.ones(1, np.uint64), base
                while len(found) < n:
                    found = np.concatenate([found, _reduced(found * np.uint64(step))])
                    step = step * step % _PRIME
                _powers[k].append(found)
    return _powers


def slice_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every slice ``data[start:end]``: two polynomials and the length, mixed."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    letters = data.astype(np.uint64) + np.uint64(1)
    out = (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for k, (power, inverse) in enumerate(_power(len(data) + 1)):
        total = np.zeros(len(data) + 1, np.uint64)
        terms = letters * power[: len(data)]
        np.cumsum(terms if len(data) < _UNREDUCED else _fold(terms), out=total[1:])
        value = _reduced((total[ends] - total[starts]))
        out += _reduced(value * inverse[starts]) << np.uint64(31 * k)
    return mix(out)


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number, zeros behind the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray(len(data) + 1, np.uint64, padded, strides=(1,))


_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)


def differing(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, other: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Places of the slices of ``data`` that differ from the equally long slices of ``other`` that start at ``others``."""
    mine = _eights(data)
    theirs = mine if other is data else _eights(other)
    wrong = ((mine[starts] ^ theirs[others]) & _MASKS[np.minimum(sizes, 8)]) != 0
    long = np.flatnonzero((sizes > 8) & ~wrong)
    if len(long):
        same = data[expand(starts[long], sizes[long])] == other[expand(others[long], sizes[long])]
        wrong[long] = ~np.logical_and.reduceat(same, np.cumsum(sizes[long]) - sizes[long])
    return np.flatnonzero(wrong)


def _distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first place of each distinct hash, and which of them each hash is.

    The leading bits are a place in a table that keeps the first hash to come there; hashes that find another one are sorted.
    """
    n = len(hashes)
    bits = (2 * n).bit_length()
    every, slot = np.arange(n), (hashes >> np.uint64(64 - bits)).astype(np.int64)
    table = np.empty(1 << bits, np.int64)
    table[slot[::-1]] = every[::-1]
    like = table[slot]
    other = np.flatnonzero(hashes[like] != hashes)
    if len(other):
        _, first, back = np.unique(hashes[other], return_index=True, return_inverse=True)
        like[other] = other[first][back]
    first = np.flatnonzero(like == every)
    number = np.empty(n, np.int64)
    number[first] = np.arange(len(first))
    return first, number[like]


def distinct_slices(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct slices, the first place of each, and which of them each slice is.

    Slices are compared byte by byte with the one they share a hash with; one that differs is an entry of its own, under the
    same hash, behind the others.
    """
    hashes = slice_hashes(data, starts, ends)
    first, back = _distinct(hashes)
    hashes = hashes[first]
    sizes, like = ends - starts, first[back]
    odd = np.flatnonzero(sizes != sizes[like])
    even = np.flatnonzero(sizes == sizes[like])
    odd = np.concatenate([odd, even[differing(data, starts[even], sizes[even], data, starts[like[even]])]])
    if len(odd):
        hashes, first = np.concatenate([hashes, hashes[back[odd]]]), np.concatenate([first, odd])
        back[odd] = len(hashes) - len(odd) + np.arange(len(odd))
    return hashes, first, back


def expand(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions of ragged slices, one after the other."""
    total = int(lengths.sum())
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return np.arange(total, dtype=np.int64) + shift
