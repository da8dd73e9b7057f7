"""Language-model scores against plain versions."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from listmill.llm import bpe, lm
from listmill.llm.queries import RANKS

FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return [w for w in re.split("[ \t\n\x0b\x0c\r]+", (text or "").translate(FOLD)) if w]


def corpus(n, seed=1):
    r = random.Random(seed)
    word = lambda: "".join(r.choice(["th", "er", "on", "an", "re", "he"]) for _ in range(r.randint(1, 3)))
    return [" ".join(word().capitalize() if r.random() < 0.1 else word() for _ in range(r.randint(1, 80))) for _ in range(n)]


def held(key):
    return zlib.crc32(("" if key is None else str(key)).encode()) % 7 == 2


def test_base_and_counts(documents):
    table = [*enumerate(corpus(120))] + [(500, None), (501, ""), (None, "the on"), (502, "new Words é"), (502, "new Words é"), (503, "anon there " * 30_000)]
    train = [words(t) for k, t in table if not held(k)]
    counts = Counter(w for t in train for w in t)
    ends = len(train)
    total, distinct = sum(counts.values()) + ends, len(counts) + 1
    expected = []
    for key, text in table:
        c = [counts[w] for w in words(text)] + [ends]
        expected.append((key, held(key), len(c), sum(x > 0 for x in c), total, sum(math.log10((x + 1) / (total + distinct + 1)) for x in c)))
    found = lm.scores(documents(table), RANKS).collect()
    order = lambda rows: sorted(rows, key=lambda r: (r[0] is not None, r[0], r[2]))
    for mine, other in zip(order([tuple(r) for r in found]), order(expected), strict=True):
        assert mine[:5] == other[:5]
        assert mine[5] == pytest.approx(other[5], rel=1e-9)
        assert mine[6] < 0


def test_parts_of_the_corpus_change_nothing(documents, monkeypatch):
    df = documents([*enumerate(corpus(60))])
    one = {r["doc_id"]: tuple(r) for r in lm.scores(df, RANKS).collect()}
    monkeypatch.setattr(lm, "PART_BYTES", 2_000)
    for r in lm.scores(df, RANKS).collect():
        assert tuple(r)[:5] == one[r["doc_id"]][:5]
        assert tuple(r)[5:] == pytest.approx(one[r["doc_id"]][5:], rel=1e-5)


def test_nothing_to_learn_from(documents):
    key = next(k for k in range(100) if held(k))
    (row,) = lm.scores(documents([(key, "a b")]), RANKS).collect()
    assert tuple(row)[:6] == (key, True, 3, 0, 0, 0.0)
    assert math.isfinite(row["score"])
    assert lm.scores(documents([]), RANKS).count() == 0


def fit(m, ids, counts, steps=120):
    adam = lm.Adam(m.w)
    own, first, kinds, _ = lm.blocks(m, lm.segments(ids, counts, len(m.row)))
    losses = []
    for n in range(steps):
        loss, grad = m.gradient(own, first, kinds)
        told = (kinds >= 0).sum()
        losses.append(loss / told)
        adam.step({k: g / told for k, g in grad.items()}, 0.02 * (1 - 0.9 * n / steps))
    return losses


@pytest.fixture(scope="module")
def model():
    own = bpe.codec(bpe.read_file(RANKS))
    raw = [t.lower().encode() for t in corpus(300, 3)]
    ids, counts = own.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    fitted = lm.Model(np.bincount(ids, minlength=len(own.tokens)), len(raw))
    fitted.losses = fit(fitted, ids, counts)
    assert fitted.losses[-1] < fitted.losses[0] - 0.3
    return fitted


def chances(w, h):
    """The probability of every class."""
    soft = lambda x: np.exp(x - x.max(axis=-1, keepdims=True)) / np.exp(x - x.max(axis=-1, keepdims=True)).sum(axis=-1, keepdims=True)
    h = np.append(h, 1)
    return (soft(h @ w["group"])[:, None] * soft(np.einsum("d,gdm->gm", h, w["member"]))).ravel()


def plain_score(m, ids):
    """One id after the other, by the formulas."""
    w = {k: v.astype(np.float64) for k, v in m.w.items()}
    seq, total = [0, *(int(m.row[i]) for i in ids)], 0.0
    for t, target in enumerate([*ids, None]):
        low = max(0, (t // lm.STRIDE - 1) * lm.STRIDE)
        e = w["e"][seq[low : t + 1]]
        q, k, v = e[-1] @ w["q"], e @ w["k"], e @ w["v"]
        s = k @ q / math.sqrt(lm.KEY) + w["far"][np.arange(t - low, -1, -1)]
        a = np.exp(s - s.max())
        h = np.tanh(e[-1] + (a / a.sum()) @ v @ w["o"])
        total += math.log(chances(w, h)[0 if target is None else int(m.kind[target])]) + (0 if target is None else m.inside[target])
    return total / math.log(10)


def test_blocks_score_as_one_by_one(model):
    r = np.random.default_rng(2)
    texts = [r.integers(0, 50_000, n) if n % 2 else r.integers(250, 600, n) for n in (0, 1, 15, 16, 17, 31, 32, 33, 100, 7)]
    found = model.score(np.concatenate(texts).astype(np.int64), np.array([len(t) for t in texts]))
    for mine, ids in zip(found, texts, strict=True):
        assert mine == pytest.approx(plain_score(model, ids.tolist()), rel=1e-4)


def test_probabilities_of_what_may_follow_sum_to_one(model):
    rest = np.exp(model.inside[model.kind == 1]).sum()
    assert rest == pytest.approx(1)
    assert sorted(set(model.kind[model.kind > 1])) == list(range(2, lm.CLASSES))


@pytest.mark.parametrize("plain", [60, -1])
def test_gradient_is_that_of_the_loss(plain, monkeypatch):
    """Also where the largest exponent is taken off first."""
    monkeypatch.setattr(lm, "PLAIN", plain)
    m = lm.Model(np.random.default_rng(4).integers(0, 9, 50_256))
    m.w = {k: v.astype(np.float64) for k, v in m.w.items()}
    own, first, kinds, _ = lm.blocks(m, lm.segments(np.arange(250, 330), np.array([50, 30]), 50_256))
    _, grad = m.gradient(own, first, kinds)
    r = np.random.default_rng(0)
    for name in m.w:
        flat = m.w[name].reshape(-1)
        some = np.flatnonzero(np.abs(grad[name].reshape(-1)) > 1e-6)
        for at in r.choice(some, min(6, len(some)), replace=False):
            old, ends = flat[at], []
            for shift in (1e-5, -1e-5):
                flat[at] = old + shift
                ends.append(m.gradient(own, first, kinds)[0])
            flat[at] = old
            assert grad[name].reshape(-1)[at] == pytest.approx((ends[0] - ends[1]) / 2e-5, abs=1e-5, rel=1e-4), name


def test_the_loss_is_the_score(model):
    ids = np.random.default_rng(6).integers(0, 3_000, 5_000)
    counts = np.array([4_000, 0, 900, 100])
    own, first, kinds, _ = lm.blocks(model, lm.segments(ids, counts, len(model.row)))
    loss, _ = model.gradient(own, first, kinds)
    assert -(loss - model.inside[ids].sum()) / math.log(10) == pytest.approx(model.score(ids, counts).sum(), rel=1e-6)


def test_the_model_beats_single_ids_on_held_out_texts(model):
    own = bpe.codec(bpe.read_file(RANKS))
    raw = [t.lower().encode() for t in corpus(100, 99)]
    offsets = np.cumsum([0, *map(len, raw)])
    ids, counts = own.encode(np.frombuffer(b"".join(raw), np.uint8), offsets)
    alone = np.bincount(ids, minlength=len(own.tokens)) + 1.0
    assert model.score(ids, counts).sum() > np.log10(alone / alone.sum())[ids].sum()


def test_the_model_is_trained_on_every_id_of_every_training_row(documents):
    own = bpe.codec(bpe.read_file(RANKS))
    # a long text, whose rare word stands where no fixed number of windows reaches
    table = [*enumerate(corpus(40, 5)), (100, "anon there " * 2_000 + "zebra " + "anon there " * 3_000), (101, None), (102, "")]
    train = [(t or "").lower().encode() for k, t in table if not held(k)]
    assert not held(100)
    ids, counts, *_ = lm.WordCodec(own).encode(np.frombuffer(b"".join(train), np.uint8), np.cumsum([0, *map(len, train)]))
    expected = np.bincount(ids, minlength=len(own.tokens))
    found = lm.learn(lm.read_texts(lm.hashed_rows(documents(table)), RANKS), len(train))
    assert found.trained == len(ids) + len(train)
    rest = found.kind == 1
    assert found.inside[rest] == pytest.approx(np.log((expected + 1.0) / (expected[rest] + 1.0).sum())[rest])
    assert expected[found.kind > 1].min() >= expected[rest].max()
    assert found.score(ids, counts).sum() > lm.Model(expected, len(train)).score(ids, counts).sum()


def test_segments_give_the_scores_and_the_gradient_of_whole_texts(monkeypatch):
    r = np.random.default_rng(5)
    m = lm.Model(r.integers(0, 9, 50_256))
    m.w = {k: v.astype(np.float64) for k, v in m.w.items()}
    ids, counts = r.integers(0, 50_256, 5_000), np.array([3_000, 0, 15, 16, 17, lm.SEGMENT - 1, 5_000 - 3_048 - lm.SEGMENT + 1])

    def results():
        cut = lm.segments(ids, counts, 50_256)
        own, first, kinds, _ = lm.blocks(m, cut)
        assert (kinds >= 0).sum() == len(ids) + len(counts)
        return len(cut.sizes), m.score(ids, counts), m.gradient(own, first, kinds)

    cut, scores, (loss, grad) = results()
    monkeypatch.setattr(lm, "SEGMENT", 1 << 20)
    whole, expected, (one, other) = results()
    assert cut > whole == len(counts)
    assert scores == pytest.approx(expected) and loss == pytest.approx(one)
    for name in m.w:
        assert grad[name] == pytest.approx(other[name], abs=1e-9), name


@pytest.mark.parametrize("vocabulary", [300, 65_533, 65_534, 200_000])
def test_stored_segments_come_back(vocabulary):
    import pyarrow as pa

    cut = lm.segments(np.array([0, 5, vocabulary - 1, *range(200)] * 20), np.array([3_000, 0, 1_060]), vocabulary)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(cut.number), lm._binary(cut.context.ravel(), np.full(len(cut.sizes), lm.STRIDE + 1)), lm._binary(cut.codes, cut.sizes)],
        names=["number", "context", "ids"],
    )
    back = lm.stored_segments(batch.slice(1), vocabulary)
    assert len(cut.sizes) > 3 and back.number.tolist() == cut.number[1:].tolist() and back.sizes.tolist() == cut.sizes[1:].tolist()
    assert (back.codes == cut.codes[cut.sizes[0] :]).all() and (back.context == cut.context[1:]).all()


@pytest.mark.parametrize("most", [0, 40, 1 << 18])
def test_words_sent_to_all_and_words_joined_give_the_same(documents, monkeypatch, most):
    df = documents([*enumerate(corpus(60)), (900, "zebra yak"), (901, "yak")])
    monkeypatch.setattr(lm, "FREQUENT", most)
    rows = lm.hashed_rows(df)
    found, total = lm.base_scores(lm.read_texts(rows, RANKS).chunks(), 5)
    counts = Counter(w for k, t in [*enumerate(corpus(60)), (900, "zebra yak"), (901, "yak")] if not held(k) for w in words(t))
    assert total == sum(counts.values()) + 5
    for r in found.collect():
        text = "zebra yak" if r["key"] == 900 else "yak" if r["key"] == 901 else corpus(60)[r["key"]]
        assert (r["n_tokens"], r["n_known"]) == (len(words(text)) + 1, sum(counts[w] > 0 for w in words(text)) + 1)
        assert r["base_score"] == pytest.approx(sum(math.log10((x + 1) / (total + len(counts) + 2)) for x in [*(counts[w] for w in words(text)), 5]))


def test_words_built_to_collide_are_two(documents):
    word = "a"
    while len(word) < 2048:
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    keys = [k for k in range(60) if not held(k)][:3]
    found = {r["doc_id"]: r for r in lm.scores(documents([(keys[0], word), (keys[1], other), (keys[2], f"{word} {word}")]), RANKS).collect()}
    one, two = found[keys[0]]["base_score"], found[keys[1]]["base_score"]
    assert one - two == pytest.approx(math.log10(4) - math.log10(2))


def test_words_are_encoded_as_the_library_would_with_a_blank_before_them(monkeypatch):
    import public_tokenizers as public
    import tiktoken

    library = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=bpe.ranks_of(bpe.read_file(RANKS)), special_tokens={})
    monkeypatch.setattr(lm, "CACHED_WORDS", 50)
    own = lm.WordCodec(bpe.codec(bpe.read_file(RANKS)))
    texts = ["", *corpus(20, 8), " it's  done,  \n\tnaïve 中文 x" * 9, " ", "end"]
    for text in (texts[:9], texts[9:], texts):
        raw = [t.encode() for t in text]
        ids, counts, *_ = own.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
        expected = [[i for w in re.findall("[^ \t\n\x0b\x0c\r]+", t) for i in library.encode_ordinary(" " + w)] for t in text]
        assert counts.tolist() == [len(e) for e in expected] and ids.tolist() == [i for e in expected for i in e]


def test_every_id_has_a_class_and_an_embedding_of_its_own(model):
    assert len(set(model.kind)) == len(set(model.row)) == len(model.kind) == 50_256
    assert not model.inside.any()
    # the chances of the end and all ids, beside nothing else, are one
    h = np.random.default_rng(3).normal(size=lm.WIDTH)
    told = chances({k: v.astype(np.float64) for k, v in model.w.items()}, h)
    assert told[[0, *model.kind]].sum() == pytest.approx(1) and told[lm.CLASSES :].sum() == 0
    # also the context of a rare id tells: texts that differ in their first, rare id only
    rare = np.flatnonzero(model.w["e"][model.row].any(axis=1))[-2:]
    one, two = model.score(np.array([rare[0], 5, rare[1], 5]), np.array([2, 2]))
    ids = [plain_score(model, [int(r), 5]) for r in rare]
    assert [one, two] == pytest.approx(ids, rel=1e-4)
    own = [math.log10(np.exp(model.score(np.array([int(r)]), np.array([1]))[0] * math.log(10))) for r in rare]
    assert one - own[0] != pytest.approx(two - own[1], abs=1e-6)


def test_the_gradient_travels_in_parts_that_are_not_zero(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(lm, "GRADIENT_PART", 10)
    r, tasks = np.random.default_rng(1), []
    for _ in range(3):
        total = np.zeros(95)
        total[r.integers(0, 40, 5)] = r.normal(size=5)
        total[94] = 1
        tasks.append(total)
    rows = [pa.Table.from_batches([*lm._parts_of(np.array([2.0, 3]), t)]).append_column("task", pa.array([n] * len([*lm._parts_of(np.array([2.0, 3]), t)]))) for n, t in enumerate(tasks)]
    assert all(len(t) <= 6 for t in rows)
    rows, found = pa.concat_tables(rows), np.zeros(95)
    for part in set(rows.column("part").to_pylist()):
        (row,) = lm._added(rows.filter(pa.compute.equal(rows.column("part"), part))).to_pylist()
        values = np.frombuffer(row["grad"])
        if part < 0:
            assert values.tolist() == [6, 9]
        else:
            found[part * 10 :][: len(values)] = values
    assert found == pytest.approx(sum(tasks))


def test_a_batch_is_worked_on_in_bounded_pieces(model, documents, monkeypatch):
    r = np.random.default_rng(7)
    counts = np.array([0, 5_000, 3, 900, *[40] * 300])
    ids = r.integers(0, 50_256, counts.sum())
    cut = lm.segments(ids, counts, 50_256)
    expected = lm.segment_scores(model, cut)
    monkeypatch.setattr(lm, "UNFOLDED", 2_000)
    pieces = list(lm.unfolded(cut))
    assert len(pieces) > 5 and all(p.codes.size <= 2_000 for p in pieces)
    assert (np.concatenate([p.codes for p in pieces]) == cut.codes).all() and sum(len(p.sizes) for p in pieces) == len(cut.sizes)
    assert np.concatenate([lm.segment_scores(model, p) for p in pieces]) == pytest.approx(expected)
    # a segment longer than that is a piece of its own
    monkeypatch.setattr(lm, "UNFOLDED", 100)
    assert [len(p.sizes) for p in lm.unfolded(lm.segments(np.arange(900), np.array([900]), 50_256))] == [1]
    # and the whole operator gives the same in small pieces
    df = documents([*enumerate(corpus(60))])
    small = {x["doc_id"]: x["score"] for x in lm.scores(df, RANKS).collect()}
    monkeypatch.setattr(lm, "UNFOLDED", 1 << 17)
    assert {x["doc_id"]: x["score"] for x in lm.scores(df, RANKS).collect()} == pytest.approx(small, rel=1e-5)
