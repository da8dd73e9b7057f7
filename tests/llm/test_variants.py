"""Spelling variants against a comparison of all pairs of words."""

import random
import re
import zlib

import numpy as np
import pytest

from listmill.llm import variants

DOCS = "doc_id long, text string, word string, n string, state string, size long, low long, form string"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def build(spark, rows):
    return spark.createDataFrame([(*r, "x", None, "y", 1, 2, "z") for r in rows], DOCS)


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + 1 :] == b[at + 1 :] if len(a) == len(b) else a[at:] == b[at + 1 :]


def plain_counts(docs) -> dict[str, int]:
    out = {}
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= 6:
                out[run] = out.get(run, 0) + 1
    return out


def plain(docs) -> list[tuple]:
    words = {w: n for w, n in plain_counts(docs).items() if n >= 5}
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and one_edit(w, v)] for w in words}
    form = {}
    for w, some in near.items():
        best = min(some, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(out)


def found(spark, docs, **settings) -> list[tuple]:
    df = variants.groups(build(spark, docs).repartition(3), **settings)
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def corpus(seed: int, letters: str, sizes=(6, 7, 8, 9)) -> list[tuple]:
    r = random.Random(seed)
    stems = ["".join(r.choice(letters) for _ in range(r.choice(sizes))) for _ in range(12)]
    bag = []
    for stem in stems:
        bag += [stem] * r.choice([6, 40, 300])
        for _ in range(10):
            at, c = r.randrange(len(stem) + 1), r.choice(letters)
            other = r.choice([stem[:at] + c + stem[at:], stem[:at] + stem[at + 1 :], stem[:at] + c + stem[at + 1 :]])
            bag += [other] * r.choice([4, 5, 9, 60])
            at = r.randrange(len(other))
            bag += [other[:at] + c + other[at + 1 :]] * r.choice([5, 6, 12])
    r.shuffle(bag)
    marks = [" ", "1", "×x—", ", ", "\n", "Ā"]
    out, at = [], 0
    while at < len(bag):
        n = r.randrange(1, 60)
        text = "".join(w.upper() if r.random() < 0.1 and w.isascii() else w + r.choice(marks) for w in bag[at : at + n])
        out.append((r.choice([None, len(out), len(out) * 1000]), text))
        at += n
    return out


EDGES = [(1, None), (2, ""), (3, " 12 中"), (4, "short a bc"), (5, "end"), (5, "ing a word")]


@pytest.mark.parametrize("seed, letters, crowded", [(1, "ab", 20_000), (2, "ab", 3), (3, "abcdefghéñ", 20_000), (4, "aÀÿ", 1)])
def test_equals_all_pairs(spark, seed, letters, crowded):
    docs = corpus(seed, letters) + EDGES
    docs += docs[:5]
    expected = plain(docs)
    assert any(r[1] for r in expected)
    assert found(spark, docs, crowded=crowded) == expected


def test_chains_lead_to_the_last_form(spark):
    names = ["stations", "station", "statio", "statios", "xtatios"]
    docs = [(k, " ".join([w] * n)) for k, (w, n) in enumerate(zip(names, [5, 30, 160, 900, 6]))]
    expected = plain(docs)
    assert [r[2] for r in expected] == ["statios"] * 5
    assert found(spark, docs) == expected


def test_long_words(spark):
    base = "abcdefghij" * 500
    docs = [(k, f"{base}x {base}xx {base[:3000]}y{base[3000:]}x z{base}") for k in range(30)] + [(99, base + "x ") ] * 200
    assert found(spark, docs) == plain(docs)


def test_nothing_to_group(spark):
    assert found(spark, []) == []
    assert found(spark, EDGES) == []
    assert found(spark, [(1, "lonely words stand alone " * 9)])[0][:3] == ("lonely", None, "lonely")


def test_checksums_of_slices():
    r = np.random.default_rng(1)
    data = r.integers(0, 256, 5000).astype(np.uint8)
    starts = r.integers(0, 4000, 300)
    ends = starts + r.integers(0, 200, 300)
    before = r.integers(0, 2**32, 300)
    expected = [zlib.crc32(data[a:b].tobytes(), int(x)) for a, b, x in zip(starts, ends, before)]
    assert variants.checksums(data, starts, ends, before).tolist() == expected


def test_acceptors_share_equal_languages():
    machine = variants.Machine()
    one = machine.add(["abcx", "abdx", "bbcx", "bbdx"])
    two = machine.add(["abcx", "abdx", "bbcx", "bbdx"])
    assert one == two and len(machine.arcs) == 5
    assert sorted(machine.common(one, two)) == ["abcx", "abdx", "bbcx", "bbdx"]
    assert list(machine.common(one, machine.add(["abcx", "zz"]))) == ["abcx"]


@pytest.mark.parametrize("seed", range(20))
def test_each_pair_of_a_partition_once(seed):
    r = random.Random(seed)
    size = r.randrange(1, 6)
    words = {"".join(r.choice("abc") for _ in range(size + r.randrange(2))) for _ in range(r.randrange(1, 60))}
    short, long = (sorted(w for w in words if len(w) == n) for n in (size, size + 1))
    if not short:
        return
    machine = variants.Machine()
    pairs = [frozenset(p[:2]) for p in machine.near(machine.add(short), machine.add(long) if long else None, True)]
    expected = {frozenset((a, b)) for a in short for b in words if one_edit(a, b)}
    assert len(pairs) == len(set(pairs)) and set(pairs) == expected
