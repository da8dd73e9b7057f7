"""Spelling variants by composing finite-state machines (operator 12).

Words are counted over all documents. Two words are near if one edit, an insertion, a deletion or a replacement of one code point,
turns one into the other: the pair is accepted by the vocabulary's acceptor, composed with a transducer of exactly one edit, composed
with the acceptor again.

Partition: an edit stands in a range of places of the shorter word; before and behind it the two words agree. A word is dealt, for
the left and the right half of its places and as the shorter or the longer of a pair, to the state that the letters outside the
half lead to: the state of the acceptor after a prefix, or of its mirror image after a suffix. The words of a state are a partition,
whose half words become a minimised acceptor. A state with more than CROWDED words is parted again, by halving the range of places, until
one place is left, which few words share. So no partition grows with the vocabulary.

Composition: both sides walk together as long as they agree. Where they part, by two letters or by one letter that only the longer
word has, both rests must be common to the languages of the two states reached; whether there is a common rest is remembered for
each pair of states, and as equal languages are one state, whole subtrees are passed on without looking. An edit is
put at the last place where it can stand, so each pair is accepted once, in one partition.

Defined results: a null or empty text has no words, a null doc_id counts as an empty one in the corruption; repeated rows count as often
as they occur; words of any length are handled; a table without words of LEAST_LENGTH and LEAST_TIMES gives no rows; columns
beside id and text are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listmill.llm.arrays import bytes_of, differing, pieces, slice_hashes, small_batches
from listmill.session import settle

LEAST_LENGTH, LEAST_TIMES, STRONGER, RARITY = 6, 5, 5, 199
# Words of a partition beyond which it is parted again.
CROWDED = 20_000
# Distinct words that a task holds before it hands them on.
HELD = 200_000
# Slices up to this many bytes go through the table of the checksum together.
SHORT = 64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), 0xC3]] = True


def _checksum_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_TABLE = _checksum_table()


def checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """The CRC-32 of each slice, continued from the CRC-32 of what stands before it."""
    sizes = ends - starts
    order = np.argsort(-sizes, kind="stable")
    starts, sizes, state = starts[order], sizes[order], before[order].astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    long = int(np.searchsorted(-sizes, -SHORT, side="left"))
    for k in range(long):
        piece = data[starts[k] : starts[k] + sizes[k]].tobytes()
        state[k] = zlib.crc32(piece, int(before[order[k]])) ^ 0xFFFFFFFF
    for place in range(int(sizes[long]) if long < len(sizes) else 0):
        # the slices that have a byte at this place stand first
        high = int(np.searchsorted(-sizes, -place, side="left"))
        now = state[long:high]
        state[long:high] = _TABLE[(now ^ data[starts[long:high] + place]) & np.uint32(255)] ^ (now >> np.uint32(8))
    out = np.empty(len(order), np.uint32)
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    return out.astype(np.int64)


def runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, text and code points of the maximal runs of letters in the concatenated UTF-8 texts."""
    if not len(data):
        return (np.zeros(0, np.int64),) * 4
    inside = _LETTER[data]
    wide = data == 0xC3
    inside[1:] |= wide[:-1]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begin, end = inside & edge[:-1], inside & edge[1:]
    begin[1:] |= inside[1:] & ~inside[:-1]
    end[:-1] |= inside[:-1] & ~inside[1:]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    twos = np.concatenate(([0], np.cumsum(wide)))
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1, ends - starts - (twos[ends] - twos[starts])


def piece_words(data: np.ndarray, offsets: np.ndarray, keys: list[str]) -> dict[str, int]:
    """The corrupted words of LEAST_LENGTH code points and more of a piece of texts, and how often they occur."""
    data = _LOWER[data]
    starts, ends, row, length = runs(data, offsets)
    some = np.flatnonzero(length >= LEAST_LENGTH)
    starts, ends, row, length = starts[some], ends[some], row[some], length[some]
    if not len(some):
        return {}
    before = np.array([zlib.crc32(f"{k}:".encode()) for k in keys], np.int64)
    h = checksums(data, starts, ends, before[row])
    hit = h % RARITY == 0
    text = lambda k: data[starts[k] : ends[k]].tobytes().decode()
    found: dict[str, int] = {}
    for k in np.flatnonzero(hit & (length > LEAST_LENGTH)).tolist():
        word, at = text(k), int(h[k] % length[k])
        word = word[:at] + word[at + 1 :]
        found[word] = found.get(word, 0) + 1
    starts, ends = starts[~hit], ends[~hit]
    _, first, back, times = np.unique(slice_hashes(data, starts, ends), return_index=True, return_inverse=True, return_counts=True)
    same = ends[first][back] - starts[first][back] == ends - starts
    other = np.flatnonzero(~same)
    other = np.concatenate([other, np.flatnonzero(same)[differing(data, starts[same], (ends - starts)[same], data, starts[first][back][same])]])
    for k in other.tolist():
        # a word that shares the hash of another
        times[back[k]] -= 1
        found[text_of := data[starts[k] : ends[k]].tobytes().decode()] = found.get(text_of, 0) + 1
    for k, n in zip(first.tolist(), times.tolist(), strict=True):
        word = data[starts[k] : ends[k]].tobytes().decode()
        found[word] = found.get(word, 0) + n
    return found


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """word and n of all words of LEAST_LENGTH code points and more, corrupted as stated."""

    def batch_of(found: dict[str, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])

    def task(batches):
        held: dict[str, int] = {}
        for batch in batches:
            data, offsets = bytes_of(batch.column("text"))
            keys = batch.column("key").to_pylist()
            for low, high in pieces(offsets):
                at = offsets[low : high + 1]
                for word, n in piece_words(data[at[0] : at[-1]], at - at[0], keys[low:high]).items():
                    held[word] = held.get(word, 0) + n
                if len(held) > HELD:
                    yield batch_of(held)
                    held = {}
        if held:
            yield batch_of(held)

    keyed = F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key")
    rows = small_batches(docs).select(keyed, F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(task, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


# ---------------------------------------------------------------- machines


class Machine:
    """Minimised acceptors of sets of words; equal languages are one state, across all sets added."""

    def __init__(self):
        self.states: dict[tuple, int] = {}
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        self.known: dict[tuple[int, int], bool] = {}

    def _state(self, final: bool, arcs: dict[str, int]) -> int:
        key = (final, *arcs.items())
        found = self.states.get(key)
        if found is None:
            found = self.states[key] = len(self.arcs)
            self.arcs.append(arcs)
            self.final.append(final)
        return found

    def add(self, words: list[str]) -> int:
        """The initial state of the acceptor of ``words``, which are sorted and distinct."""
        path: list[tuple[bool, dict[str, int]]] = [(False, {})]
        last = ""
        for word in words:
            same, most = 0, min(len(word), len(last))
            while same < most and word[same] == last[same]:
                same += 1
            self._close(path, last, same)
            path.extend((False, {}) for _ in range(len(word) - same))
            path[-1] = (True, path[-1][1])
            last = word
        self._close(path, last, 0)
        return self._state(*path[0])

    def _close(self, path, last: str, depth: int):
        """States behind ``depth`` letters get no more arcs and are named."""
        while len(path) - 1 > depth:
            final, arcs = path.pop()
            path[-1][1][last[len(path) - 1]] = self._state(final, arcs)

    def meets(self, a: int, b: int) -> bool:
        """Whether some word is accepted from both states."""
        known, arcs, final = self.known, self.arcs, self.final
        stack = [(a, b)]
        while stack:
            pair = stack[-1]
            if pair in known:
                stack.pop()
                continue
            x, y = pair
            if x == y or (final[x] and final[y]):
                known[pair] = True
                stack.pop()
                continue
            ready, found = True, False
            for letter, x_next in arcs[x].items():
                y_next = arcs[y].get(letter)
                if y_next is None:
                    continue
                told = known.get((x_next, y_next))
                if told:
                    found = True
                    break
                if told is None:
                    stack.append((x_next, y_next))
                    ready = False
                    break
            if found or ready:
                known[pair] = found
                stack.pop()
        return known[a, b]

    def common(self, a: int, b: int, without: str | None = None) -> Iterator[str]:
        """Words accepted from both states, those that start with ``without`` excepted."""
        arcs, final = self.arcs, self.final
        if final[a] and final[b]:
            yield ""
        letters: list[str] = []
        stack = [self._both(a, b, without)]
        while stack:
            step = next(stack[-1], None)
            if step is None:
                stack.pop()
                if letters:
                    letters.pop()
                continue
            letter, x, y = step
            letters.append(letter)
            if final[x] and final[y]:
                yield "".join(letters)
            stack.append(self._both(x, y, None))

    def _both(self, a: int, b: int, without: str | None):
        for letter, x in self.arcs[a].items():
            y = self.arcs[b].get(letter)
            if y is not None and letter != without and (x == y or self.meets(x, y)):
                yield letter, x, y

    def near(self, short: int, long: int | None, end: bool) -> Iterator[tuple[str, str, bool]]:
        """Pairs of words one edit apart, and whether the second is the longer.

        From ``short`` words of one length are accepted, from ``long`` those of one more. ``end``: a letter behind the whole
        shorter word counts; it is left to the partition of the next places otherwise.
        """
        stack = [("", short, long)]
        while stack:
            prefix, s, g = stack.pop()
            arcs = self.arcs[s]
            letters = list(arcs)
            for k, a in enumerate(letters):
                for b in letters[k + 1 :]:
                    if arcs[a] == arcs[b] or self.meets(arcs[a], arcs[b]):
                        for rest in self.common(arcs[a], arcs[b]):
                            yield prefix + a + rest, prefix + b + rest, False
            longer = self.arcs[g] if g is not None else {}
            for a, t in longer.items():
                if (end or not self.final[s]) and self.meets(s, t):
                    for rest in self.common(s, t, a):
                        yield prefix + rest, prefix + a + rest, True
            for a in letters:
                stack.append((prefix + a, arcs[a], longer.get(a)))


def near_in(words: list[tuple[str, int]], size: int, end: bool) -> list[tuple[str, int, int, str]]:
    """Near words of the middles of a partition: middle, how many are near, and the strongest of them with its n.

    ``words``: distinct middles with their n, of ``size`` code points for the shorter side and one more for the longer.
    """
    machine = Machine()
    times = dict(words)
    short, long = (sorted(w for w in times if len(w) == n) for n in (size, size + 1))
    if not short or len(times) < 2:
        return []
    many: dict[str, int] = {}
    best: dict[str, tuple[int, str]] = {}
    for a, b, _ in machine.near(machine.add(short), machine.add(long) if long else None, end):
        for one, other in ((a, b), (b, a)):
            many[one] = many.get(one, 0) + 1
            offered = (-times[other], other)
            if one not in best or offered < best[one]:
                best[one] = offered
    return [(w, n, -best[w][0], best[w][1]) for w, n in many.items()]


# ---------------------------------------------------------------- partitions

def _states(rows: DataFrame) -> DataFrame:
    """``rows`` with the hash of the state that the letters outside the range of places lead to."""
    prefix, suffix = F.expr("substring(word, 1, low)"), F.expr("substring(word, length(word) - (size - high) + 1, size - high)")
    return rows.withColumn("state", F.xxhash64("size", "low", "high", prefix, suffix))


def partitions(words: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """word, n, size, low, high and state: the range of places [low, high) of the shorter word in which the edit stands."""
    own, longer = F.length("word"), F.length("word") - 1
    sizes = F.filter(F.array(own, longer), lambda s: s >= LEAST_LENGTH)
    rows = words.select("word", "n", F.explode(sizes).alias("size"))
    half = F.expr("size div 2").cast("int")
    rows = rows.withColumn("range", F.explode(F.array(
        F.struct(F.lit(0).alias("low"), half.alias("high")), F.struct(half.alias("low"), F.col("size").alias("high"))
    )))
    rows = _states(rows.select("word", "n", "size", "range.low", "range.high"))
    done = None
    while True:
        many = settle(rows.groupBy("state").count().filter(F.col("count") > crowded).select("state"))
        if many.isEmpty():
            return rows if done is None else done.unionByName(rows)
        narrow = F.col("high") - F.col("low") < 2
        full = rows.join(many, "state", "left_semi")
        few = rows.join(many, "state", "left_anti").unionByName(full.filter(narrow))
        done = few if done is None else done.unionByName(few)
        middle = F.expr("(low + high) div 2").cast("int")
        parted = full.filter(~narrow).withColumn("range", F.explode(F.array(
            F.struct("low", middle.alias("high")), F.struct(middle.alias("low"), "high")
        )))
        rows = settle(_states(parted.select("word", "n", "size", "range.low", "range.high")))


_NEAR = "word string, n_near long, best_n long, best string"


def near_words(words: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """word, n_near, and n and word of the strongest near word, for each word that has near words."""
    parted = partitions(words, crowded).repartition("state").sortWithinPartitions("state")

    def composed(rows) -> list[tuple[str, int, int, str]]:
        """The rows of one state, or of several that share a hash."""
        groups: dict[tuple, list[tuple[str, int]]] = {}
        for word, n, size, low, high in rows:
            tail = len(word) - (size - high)
            groups.setdefault((size, low, high, word[:low], word[tail:]), []).append((word[low:tail], n))
        out = []
        for (size, low, high, prefix, suffix), some in groups.items():
            if len(some) > 1:
                out += [(prefix + a + suffix, n, m, prefix + b + suffix) for a, n, m, b in near_in(some, high - low, high == size)]
        return out

    def task(batches):
        waiting, state = [], None
        for batch in batches:
            states = batch.column("state").to_numpy()
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("word", "n", "size", "low", "high")), strict=True))
            cuts = [0, *(np.flatnonzero(states[1:] != states[:-1]) + 1).tolist(), len(rows)]
            found = []
            for low, high in zip(cuts, cuts[1:]):
                if low == high:
                    continue
                if states[low] != state:
                    if len(waiting) > 1:
                        found += composed(waiting)
                    waiting, state = [], states[low]
                waiting += rows[low:high]
            if found:
                yield _batch(found)
        if len(waiting) > 1 and (found := composed(waiting)):
            yield _batch(found)

    def _batch(found):
        columns = list(zip(*found, strict=True))
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["word", "n_near", "best_n", "best"])

    parts = parted.select("word", "n", "size", "low", "high", "state").mapInArrow(task, _NEAR)
    best = F.min(F.struct((-F.col("best_n")).alias("weaker"), F.col("best").alias("best")))
    merged = parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("top"))
    return merged.select("word", "n_near", (-F.col("top.weaker")).alias("best_n"), F.col("top.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """word and root of the rows (word, form) of ``forms``; a form's count is a multiple of its word's, so chains are short."""
    links = settle(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = settle(links.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        links = moved.select("word", "root")
        if not moved.agg(F.count_if("moved")).first()[0]:
            return links


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", crowded: int = CROWDED) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the documents."""
    words = settle(word_counts(docs, key, text).filter(F.col("n") >= LEAST_TIMES))
    near = words.join(near_words(words, crowded), "word", "left")
    strong = F.col("best_n") >= STRONGER * F.col("n")
    told = settle(near.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, F.col("best")).alias("form"), F.when(strong, F.col("best_n")).alias("form_n"),
    ))
    found = told.join(roots(told.filter(F.col("form").isNotNull())), "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
