"""Where a byte-level tokenizer splits a text, from codepoint classes and a scan of transition functions.

The split has seven kinds of pre-tokens: an English contraction after an apostrophe, letters, digits and other signs, each
with one blank before them, and white space in two forms. Only the contraction needs memory of what came before: an
apostrophe opens one unless it follows a blank or another sign. That memory is an automaton of four states, so a class of
characters is a function from states to states that fits one byte, and functions compose in a table of 256 x 256. Prefixes
are composed within rows of 64 characters, all rows at once, and then across rows by doubling.
"""

from __future__ import annotations

import unicodedata
from functools import cache, cached_property
from heapq import heapify, heappop, heappush

import numpy as np

from listmill.llm.arrays import expand

LETTER, DIGIT, SIGN, BLANK, SPACE, SHORT, LONG = range(7)
# State after a character. JOINED: a blank or a sign, which the next sign continues. FREE: anything else.
# ONE, TWO: inside a contraction, of which so many letters are to come.
JOINED, FREE, ONE, TWO = range(4)
WIDTH = 64
# Symbols from which on a sequence is merged by itself.
BY_ITSELF = 512

# Code points of white space, first and last of each range.
WHITE = ((0x9, 0xD), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029),
         (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000))


def _function(to_state) -> int:
    return sum(to_state(s) << (2 * s) for s in range(4))


# What a character of each class does to the state.
_STEP = np.array([
    _function(lambda s: ONE if s == TWO else FREE),
    _function(lambda s: FREE),
    _function(lambda s: JOINED),
    _function(lambda s: JOINED),
    _function(lambda s: FREE),
    _function(lambda s: JOINED if s == JOINED else ONE),
    _function(lambda s: JOINED if s == JOINED else TWO),
], np.uint8)
# The same for the first character of a text, which always meets FREE.
_FIRST = np.array([_function(lambda s, f=int(f): (f >> (2 * FREE)) & 3) for f in _STEP], np.uint8)


@cache
def _compose() -> np.ndarray:
    """COMPOSE[f * 256 + g]: first f, then g."""
    f, g = np.meshgrid(np.arange(256), np.arange(256), indexing="ij")
    out = np.zeros((256, 256), np.int64)
    for s in range(4):
        middle = (f >> (2 * s)) & 3
        out |= ((g >> (2 * middle)) & 3) << (2 * s)
    return out.astype(np.uint8).ravel()


@cache
def classes() -> np.ndarray:
    """The class of every code point."""
    table = np.full(0x110000, SIGN, np.uint8)
    kinds = np.array([ord(unicodedata.category(chr(c))[0]) for c in range(0x110000)], np.uint8)
    table[kinds == ord("L")] = LETTER
    table[kinds == ord("N")] = DIGIT
    for low, high in WHITE:
        table[low : high + 1] = SPACE
    table[0x20] = BLANK
    return table


def states(steps: np.ndarray) -> np.ndarray:
    """The state after each character, from the functions of the characters, by an associative scan."""
    table = _compose()
    n = len(steps)
    rows = -(-n // WIDTH)
    identity = _function(lambda s: s)
    grid = np.full(rows * WIDTH, identity, np.uint8)
    grid[:n] = steps
    grid = np.ascontiguousarray(grid.reshape(rows, WIDTH).T)
    for k in range(1, WIDTH):
        grid[k] = table[(grid[k - 1].astype(np.int32) << 8) | grid[k]]
    # across rows: after the round of 2**k each row holds the composition of up to 2**(k+1) rows
    whole, gap = grid[-1].copy(), 1
    while gap < rows:
        whole[gap:] = table[(whole[:-gap].astype(np.int32) << 8) | whole[gap:]]
        gap *= 2
    entering = np.full(rows, FREE, np.uint8)
    entering[1:] = (whole[:-1] >> (2 * FREE)) & 3
    return ((grid >> (2 * entering)[None, :]) & 3).T.ravel()[:n]


def boundaries(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte offsets at which a pre-token starts in the concatenated UTF-8 texts ``data``, each text split by itself."""
    if not len(data):
        return np.zeros(0, np.int64)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    n = len(points)
    kind = classes()[points]
    first = np.zeros(n + 1, bool)
    first[np.searchsorted(lead, offsets[:-1])] = True
    first[n] = True

    # an apostrophe with the letters of a contraction after it, in the same text
    marks = np.flatnonzero(points == 0x27)
    if len(marks):
        padded = np.concatenate([points, np.zeros(2, np.uint32)])
        ends = np.concatenate([first, [True]])
        one, two = padded[marks + 1], padded[marks + 2]
        inside_one, inside_two = ~ends[marks + 1], ~ends[marks + 1] & ~ends[np.minimum(marks + 2, n)]
        short = inside_one & np.isin(one, np.array([ord(c) for c in "stmd"], np.uint32))
        long = np.zeros(len(marks), bool)
        for pair in ("re", "ve", "ll"):
            long |= (one == ord(pair[0])) & (two == ord(pair[1]))
        kind[marks[short]] = SHORT
        kind[marks[long & inside_two]] = LONG

    first = first[:n]
    after = states(np.where(first, _FIRST[kind], _STEP[kind]))
    before = np.empty(n, np.uint8)
    before[0], before[1:] = FREE, after[:-1]
    previous = np.empty(n, np.uint8)
    previous[0], previous[1:] = SPACE, kind[:-1]
    opened = (kind >= SHORT) & (after >= ONE)
    flat = np.where((kind >= SHORT), SIGN, kind)
    flat_previous = np.where(previous >= SHORT, SIGN, previous)
    white = (kind == BLANK) | (kind == SPACE)
    white_previous = (previous == BLANK) | (previous == SPACE)
    # a letter right after the last letter of a contraction starts anew
    closed = np.zeros(n, bool)
    closed[1:] = (before[:-1] == ONE) & (kind[:-1] == LETTER)
    in_contraction = (before >= ONE) & (kind == LETTER)
    start = (flat != flat_previous) & (previous != BLANK)
    start |= opened | (closed & (kind == LETTER))
    start &= ~in_contraction
    # white space: the run starts, or its last character before something else stands apart
    next_plain = np.zeros(n, bool)
    next_plain[:-1] = ~white[1:] & ~first[1:]
    start = np.where(white, ~white_previous | next_plain, start)
    return lead[start | first]


def hot_cuts(data: np.ndarray, limit: int) -> np.ndarray:
    """Offsets at which a long text may be cut: a blank between two ASCII letters always starts a pre-token."""
    if len(data) <= limit:
        return np.zeros(0, np.int64)
    lower = data | 0x20
    letter = (lower >= 97) & (lower <= 122)
    places = np.flatnonzero((data[1:-1] == 0x20) & letter[:-2] & letter[2:]) + 1
    wanted = np.arange(limit, len(data), limit)
    at = np.searchsorted(places, wanted)
    return np.unique(places[at[at < len(places)]])


def split(data: np.ndarray, offsets: np.ndarray, limit: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (bytes) of all pre-tokens; very long texts are looked at in parts."""
    if len(data) <= 2 * limit:
        starts = boundaries(data, offsets)
    else:
        cuts = np.unique(np.concatenate([offsets[:-1], hot_cuts(data, limit), [len(data)]]))
        cuts = cuts[np.concatenate(([True], np.diff(cuts) > 0))]
        found, low = [], 0
        while low < len(cuts) - 1:
            high = max(int(np.searchsorted(cuts, cuts[low] + limit, side="right")) - 1, low + 1)
            base = cuts[low]
            found.append(boundaries(data[base : cuts[high]], cuts[low : high + 1] - base) + base)
            low = high
        starts = np.concatenate(found)
    return starts, np.append(starts[1:], len(data))


class Merges:
    """Ranks of symbol pairs in an open-addressed table, looked up for whole arrays at once."""

    def __init__(self, left, right, rank, into):
        keys = (np.asarray(left, np.uint64) << np.uint64(20)) | np.asarray(right, np.uint64)
        self.listed = keys, np.asarray(rank, np.int64), np.asarray(into, np.int64)
        self.bits = max(12, int(len(keys) * 4 - 1).bit_length())
        size = 1 << self.bits
        self.keys = np.full(size, np.uint64(0xFFFFFFFFFFFFFFFF))
        self.rank = np.zeros(size, np.int32)
        self.into = np.zeros(size, np.int32)
        rank, into = np.asarray(rank, np.int32), np.asarray(into, np.int32)
        rest = np.arange(len(keys))
        place = self._home(keys)
        while len(rest):
            free = self.keys[place[rest]] == np.uint64(0xFFFFFFFFFFFFFFFF)
            taken, which = np.unique(place[rest[free]], return_index=True)
            chosen = rest[free][which]
            self.keys[taken], self.rank[taken], self.into[taken] = keys[chosen], rank[chosen], into[chosen]
            rest = np.setdiff1d(rest, chosen, assume_unique=True)
            place[rest] = (place[rest] + 1) & (size - 1)

    def _home(self, keys):
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    NONE = np.int32(2**31 - 1)

    @cached_property
    def by_pair(self) -> dict[int, tuple[int, int]]:
        """Rank and symbol by ``left << 20 | right``, to be looked up one at a time."""
        return dict(zip(self.listed[0].tolist(), zip(self.listed[1].tolist(), self.listed[2].tolist(), strict=True), strict=True))

    def look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rank of each pair, NONE where there is none, and its slot."""
        keys = (left.astype(np.uint64) << np.uint64(20)) | right.astype(np.uint64)
        place = self._home(keys)
        there = self.keys[place]
        out = np.where(there == keys, self.rank[place], self.NONE)
        rest = np.flatnonzero((there != keys) & (there != np.uint64(0xFFFFFFFFFFFFFFFF)))
        while len(rest):
            place[rest] = (place[rest] + 1) & (len(self.keys) - 1)
            there = self.keys[place[rest]]
            hit = there == keys[rest]
            out[rest[hit]] = self.rank[place[rest[hit]]]
            rest = rest[~hit & (there != np.uint64(0xFFFFFFFFFFFFFFFF))]
        return out, place


def merge_long(symbols: np.ndarray, merges: Merges) -> np.ndarray:
    """Merge one sequence pair by pair, the lowest rank and of these the leftmost first; its cost is its length times a logarithm."""
    n, table = len(symbols), merges.by_pair
    first = merges.look(symbols[:-1], symbols[1:])[0].astype(np.int64)
    some = np.flatnonzero(first != Merges.NONE)
    heap = ((first[some] << 32) | some).tolist()
    heapify(heap)
    rank = [*first.tolist(), -1]
    out, after, before = symbols.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))

    def paired(at: int, right: int):
        found = table.get((out[at] << 20) | out[right]) if right < n else None
        rank[at] = -1 if found is None else found[0]
        if found is not None:
            heappush(heap, (found[0] << 32) | at)

    while heap:
        top = heappop(heap)
        at = top & 0xFFFFFFFF
        if rank[at] != top >> 32:
            continue
        gone = after[at]
        out[at] = table[(out[at] << 20) | out[gone]][1]
        rank[gone], out[gone] = -1, -1
        right = after[at] = after[gone]
        if right < n:
            before[right] = at
        paired(at, right)
        if before[at] >= 0:
            paired(before[at], at)
    left = np.array(out, np.int32)
    return left[left >= 0]


def merge(symbols: np.ndarray, lengths: np.ndarray, merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """Merge ragged sequences: those of BY_ITSELF symbols and more one by one, the others together."""
    long = np.flatnonzero(lengths >= BY_ITSELF)
    if not len(long):
        return merge_together(symbols, lengths, merges)
    starts = np.cumsum(lengths) - lengths
    short = np.flatnonzero(lengths < BY_ITSELF)
    flat, left = merge_together(symbols[expand(starts[short], lengths[short])], lengths[short], merges)
    parts = [merge_long(symbols[starts[k] : starts[k] + lengths[k]], merges) for k in long]
    out = np.empty(len(lengths), np.int64)
    out[short], out[long] = left, [len(p) for p in parts]
    begin = np.cumsum(out) - out
    joined = np.empty(int(out.sum()), np.int32)
    joined[expand(begin[short], left)] = flat
    for k, part in zip(long, parts, strict=True):
        joined[begin[k] : begin[k] + len(part)] = part
    return joined, out


def merge_together(symbols: np.ndarray, lengths: np.ndarray, merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """Each round applies the lowest-ranked pair of every sequence.

    Returns the symbols left and their number for each sequence. A merged symbol only enters pairs of higher rank, so all
    places of one pair can be merged in the same round; of overlapping places every other one is, from the left.
    """
    done_symbols, done_index, done_lengths = [], [], []
    index = np.arange(len(lengths))
    owner = np.repeat(index, lengths)
    rank = np.full(len(symbols), Merges.NONE, np.int32)
    place = np.zeros(len(symbols), np.int64)
    same = np.flatnonzero(owner[1:] == owner[:-1])
    rank[same], place[same] = merges.look(symbols[same], symbols[same + 1])
    while len(index):
        lowest = np.minimum.reduceat(rank, np.cumsum(lengths) - lengths)
        alive = lowest != Merges.NONE
        if not alive.all():
            stay = alive[owner]
            done_symbols.append(symbols[~stay])
            done_index.append(index[~alive])
            done_lengths.append(lengths[~alive])
            symbols, rank, place = symbols[stay], rank[stay], place[stay]
            index, lengths, lowest = index[alive], lengths[alive], lowest[alive]
            owner = np.repeat(np.arange(len(index)), lengths)
        if not len(index):
            break
        at = np.flatnonzero(rank == lowest[owner])
        # places next to each other overlap: keep those at an even distance from the start of their run
        run = np.concatenate(([True], np.diff(at) > 1))
        head = np.maximum.accumulate(np.where(run, at, 0))
        at = at[(at - head) % 2 == 0]
        symbols[at] = merges.into[place[at]]
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        lengths = lengths - np.bincount(owner[at], minlength=len(index))
        symbols, rank, place, owner = symbols[keep], rank[keep], place[keep], owner[keep]
        # only the pairs that a merged symbol is in are others than before
        at -= np.arange(len(at))
        changed = np.concatenate([at, at[at > 0] - 1])
        paired = changed + 1 < len(symbols)
        paired[paired] = owner[changed[paired]] == owner[changed[paired] + 1]
        rank[changed[~paired]] = Merges.NONE
        changed = changed[paired]
        rank[changed], place[changed] = merges.look(symbols[changed], symbols[changed + 1])
    if not done_index:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    index, lengths = np.concatenate(done_index), np.concatenate(done_lengths)
    flat = np.concatenate(done_symbols)
    order = np.argsort(index, kind="stable")
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    return flat[expand(starts[order], lengths[order])], lengths[order]
