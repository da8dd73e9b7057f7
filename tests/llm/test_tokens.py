"""Byte-level BPE and token counts against the libraries they must equal."""

import hashlib
import random
import time

import numpy as np
import public_tokenizers as public
import pytest
import tiktoken
from tokenizers import Tokenizer

from listmill.llm import arrays, bpe, counts, pretokens
from listmill.llm.arrays import pieces
from listmill.llm.queries import RANKS, VOCABULARY

LETTERS = [*"aaabbst rvelmdSM''''  \n\t 019٣é中😀.,! 　'\x85\x1c", "'re", "'s", "'ll", "'RE", " 'd", "aaaa", "<|endoftext|>"]
SPECIAL = ["", " ", "  ", "\n\n  x", "'", "''s", "a's's b", "it's'", " 's", "!'s", "\n's", "a\r\n b", "x  ", "é" * 3, "<|endoftext|>", "a<|endoftext|><|endoftext|>b"]


@pytest.fixture(scope="module")
def texts():
    r = random.Random(5)
    made = ["".join(r.choice(LETTERS) for _ in range(r.randint(0, 80))) for _ in range(1500)]
    return SPECIAL + made + ["lorem ipsum " * 40_000, "a" * 30_000, "'s" * 3_000, " " * 5_000]


@pytest.fixture(scope="module")
def reference():
    ranks = bpe.ranks_of(bpe.read_file(RANKS))
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


def packed(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(x) for x in raw]))).astype(np.int64)


def test_ids_equal_the_library_and_offsets_decode(texts, reference):
    own = bpe.codec(bpe.read_file(RANKS))
    data, offsets = packed(texts)
    row = 0
    for low, high in pieces(offsets, 50_000):
        part = offsets[low : high + 1]
        ids, n = own.encode(data[part[0] : part[-1]], part - part[0])
        places = own.offsets(ids, n)
        end = 0
        for text, size in zip(texts[low:high], n, strict=True):
            mine = ids[end : end + size].tolist()
            assert mine == reference.encode_ordinary(text), text[:60]
            assert own.decode(mine) == text.encode()
            if size > 2:  # a slice of ids stands at its offset
                at = places[end + 1 : end + size]
                assert own.decode(mine[1:-1]) == text.encode()[at[0] : at[-1]]
            end += size
            row += 1
    assert row == len(texts)


def test_a_full_cache_starts_afresh(monkeypatch, texts, reference):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 50)
    own = bpe.Codec(bpe.ranks_of(bpe.read_file(RANKS)))
    own.cache.most = 50
    for text in texts[:300]:
        ids, n = own.encode(*packed([text]))
        own.cache.most = 50
        assert ids.tolist() == reference.encode_ordinary(text)


def test_long_texts_are_split_in_parts_alike(texts):
    data, offsets = packed(texts)
    whole = pretokens.boundaries(data, offsets)
    starts, ends = pretokens.split(data, offsets, limit=1000)
    assert (starts == whole).all() and ends[-1] == len(data)


def test_states_by_scan_equal_one_by_one():
    r = np.random.default_rng(3)
    steps = pretokens._STEP[r.integers(0, 7, 1000)]
    state, out = pretokens.FREE, []
    for f in steps.tolist():
        state = (f >> (2 * state)) & 3
        out.append(state)
    assert pretokens.states(steps).tolist() == out


def test_counts_equal_the_library(texts):
    own = counts.counter(bpe.read_file(VOCABULARY))
    tokenizer = Tokenizer.from_file(VOCABULARY)
    data, offsets = packed(texts)
    mine = [own.count(data[p[0] : p[-1]], p - p[0]) for p in (offsets[a : b + 1] for a, b in pieces(offsets, 50_000))]
    expected = [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert np.concatenate(mine).tolist() == expected


def test_coding_in_spark(spark, documents, rows, reference):
    table = [(1, "it's a test"), (2, None), (3, ""), (None, "x y"), (5, "x y"), (5, "x y"), (6, "wörd " * 30_000)]
    found = rows(bpe.digests(spark, documents(table), RANKS))
    expected = []
    for key, text in table:
        ids = reference.encode_ordinary(text or "")
        expected.append((key, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert found == sorted(expected, key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))
    coded = bpe.encode(documents(table), RANKS)
    decoded = {r["doc_id"]: bytes(r["decoded"]).decode() for r in bpe.decode(coded, RANKS).collect()}
    assert decoded == {k: t or "" for k, t in table}
    assert [tuple(r) for r in bpe.decode(spark.createDataFrame([(1, [99_999_999]), (2, None)], "doc_id long, ids array<int>"), RANKS).collect()] == [(1, None), (2, None)]
    assert bpe.digests(spark, documents([]), RANKS).count() == 0


def test_counts_in_spark(documents, rows):
    table = [(1, "a b c"), (2, None), (3, ""), (None, "é"), (5, "a b c"), (5, "a b c")]
    found = rows(counts.token_counts(documents(table), VOCABULARY, limit=2))
    assert found == [(None, 2, 1, False), (1, 5, 3, True), (2, 0, 0, False), (3, 0, 0, False), (5, 5, 3, True), (5, 5, 3, True)]
    assert counts.token_counts(documents([]), VOCABULARY).count() == 0


def opposite_words(n):
    """A Thue-Morse word over two letters and its complement, which every polynomial modulo a power of two confuses."""
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [1024, 2048])
def test_words_built_to_collide(n, reference):
    one, other = opposite_words(n)
    own = bpe.Codec(bpe.ranks_of(bpe.read_file(RANKS)))
    counter = counts.Counter(bpe.read_file(VOCABULARY))
    library = Tokenizer.from_file(VOCABULARY)
    for made in ([f"{one} {other}"], [one, other, one], [other]):
        ids, sizes = own.encode(*packed(made))
        assert ids.tolist() == [i for t in made for i in reference.encode_ordinary(t)]
        assert own.decode(ids.tolist()) == "".join(made).encode()
        assert counter.count(*packed(made)).tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in made]


def test_slices_that_share_a_hash_are_told_apart(monkeypatch, reference):
    """With a hash of a few bits every piece has collisions, in the piece and with what is remembered."""
    real = bpe.slice_hashes if hasattr(bpe, "slice_hashes") else None
    from listmill.llm import arrays

    few = arrays.slice_hashes
    monkeypatch.setattr(arrays, "slice_hashes", lambda *a: few(*a) & np.uint64(15))
    monkeypatch.setattr(bpe, "slice_hashes", lambda *a: real(*a) & np.uint64(15))
    own, counter = bpe.Codec(bpe.ranks_of(bpe.read_file(RANKS))), counts.Counter(bpe.read_file(VOCABULARY))
    library = Tokenizer.from_file(VOCABULARY)
    r = random.Random(3)
    for _ in range(30):
        made = [" ".join("".join(r.choice("abcdé") for _ in range(r.randint(1, 30))) for _ in range(40))]
        assert own.encode(*packed(made))[0].tolist() == reference.encode_ordinary(made[0])
        assert counter.count(*packed(made)).tolist() == [len(library.encode(made[0], add_special_tokens=False).ids)]


def test_long_words_take_seconds():
    r = random.Random(1)
    own, counter = bpe.codec(bpe.read_file(RANKS)), counts.counter(bpe.read_file(VOCABULARY))
    for letters in ("abcdefghijklmnopqrstuvwxyz", "ACGT", "x", "中文字"):
        text = "".join(r.choice(letters) for _ in range(1_000_000 // len(letters[0].encode())))
        data, offsets = packed([text])
        start = time.process_time()
        ids, _ = own.encode(data, offsets)
        counted = counter.count(data, offsets)
        assert time.process_time() - start < 30
        assert own.decode(ids.tolist()) == text.encode()
        assert len(ids) == counted[0]


@pytest.mark.parametrize("letters, n", [("abcdefghijklmnopqrstuvwxyz", 6000), ("ab", 5000), ("x", 700), ("中文é", 1500)])
def test_long_words_equal_the_library(letters, n, reference):
    r = random.Random(n)
    text = "".join(r.choice(letters) for _ in range(n))
    own = bpe.codec(bpe.read_file(RANKS))
    assert own.encode(*packed([text]))[0].tolist() == reference.encode_ordinary(text)
    assert own.encode(*packed(["a b", text, "c d"]))[0].tolist() == [i for t in ("a b", text, "c d") for i in reference.encode_ordinary(t)]


def test_merging_looks_up_only_pairs_that_are_new(monkeypatch):
    """A round of merges used to look up every pair that was left."""
    # one symbol each round: 0 1 -> 8, 8 2 -> 9, 9 3 -> 10 and so on
    merges = pretokens.Merges([0, 8, 9, 10, 11], [1, 2, 3, 4, 5], range(5), range(8, 13))
    words = [[0, 1, 2, 3, 4, 5] + [7] * 40, [5, 5, 0, 1, 2], [7], [0, 1, 0, 1, 2, 0]] * 50
    looked, look = [], merges.look
    monkeypatch.setattr(merges, "look", lambda left, right: looked.append(len(left)) or look(left, right))
    symbols, sizes = pretokens.merge_together(np.concatenate(words).astype(np.int32), np.array([len(w) for w in words]), merges)
    assert sizes.tolist() == [41, 3, 1, 3] * 50
    assert symbols.tolist() == [12, *[7] * 40, 5, 5, 9, 7, 8, 9, 0] * 50
    pairs, merged = sum(len(w) - 1 for w in words), sum(map(len, words)) - len(symbols)
    assert sum(looked) <= pairs + 2 * merged


def test_distinct_and_remembered_slices_tell_equal_hashes_apart(monkeypatch):
    # few hashes, all with the same leading bits: every slice meets another one in the table
    monkeypatch.setattr(arrays, "slice_hashes", lambda data, starts, ends: data[starts].astype(np.uint64) % np.uint64(3) + np.uint64(1))
    letters = [b"a", b"b", b"c", b"d", b"aa", b"a", b"d", b"dd", b"c"] * 4
    data, ends = np.frombuffer(b"".join(letters), np.uint8), np.cumsum([len(x) for x in letters])
    starts = ends - [len(x) for x in letters]
    hashes, first, back = arrays.distinct_slices(data, starts, ends)
    assert all(letters[first[k]] == x for k, x in zip(back, letters, strict=True))
    assert [h - 1 for h in hashes.tolist()] == [letters[i][0] % 3 for i in first]

    known = bpe.Remembered()
    for _ in range(3):
        known.add(hashes, data, starts[first], ends[first])
    found = known.look(hashes, data, starts[first], ends[first])
    assert (found >= 0).any()
    assert all(n < 0 or letters[first[n % len(first)]] == letters[first[k]] for k, n in enumerate(found))


def test_remembered_slices_are_found_when_the_table_grows():
    known, numbers = bpe.Remembered(), {}
    for a in range(0, 9_000, 1_500):
        words = [str(k).encode() for k in range(a, a + 1_500)]
        ends = np.cumsum([len(w) for w in words])
        data, starts = np.frombuffer(b"".join(words), np.uint8), ends - [len(w) for w in words]
        hashes = arrays.slice_hashes(data, starts, ends)
        assert (known.look(hashes, data, starts, ends) == -1).all()
        numbers[a] = known.add(hashes, data, starts, ends), hashes, data, starts, ends
    for added, *asked in numbers.values():
        assert known.look(*asked).tolist() == added.tolist()
