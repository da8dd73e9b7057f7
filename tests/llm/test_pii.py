"""Personal data: rules against plain patterns, the tagger against held-out windows."""

import hashlib
import random
import re

import numpy as np
import pytest

from listmill.llm import pii

PLAIN = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def plain_spans(text):
    out = []
    for kind, pattern in enumerate(PLAIN):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = (
                True,
                all(int(p) <= 255 for p in m.group().split(".")) if kind == pii.IP else True,
                16 <= len(digits) <= 19 and pii.luhn(digits),
                8 <= len(digits) <= 15,
            )[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def value(kind, r):
    d = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    if kind == pii.EMAIL:
        return f"{r.choice(['ann', 'bob.k', 'c_d'])}{d(2)}@mail{d(1)}.example.com"
    if kind == pii.IP:
        return ".".join(str(r.randrange(256)) for _ in range(4))
    if kind == pii.CARD:
        body = "4" + d(14)
        return body + next(c for c in "0123456789" if pii.luhn(body + c))
    return f"+1 ({r.randrange(200, 999)}) 555-{d(4)}"


def made(n, seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice(["th", "er", "on", "an", "re", "he", "in"]) for _ in range(r.randint(1, 4)))
    out = []
    for k in range(n):
        text = [word() for _ in range(r.randint(5, 60))]
        text.insert(r.randrange(len(text)), value(k % 4, r))
        out.append(" ".join(text))
    return out


def test_rules_equal_plain_patterns():
    r = random.Random(1)
    parts = ["4", "1", "11", "- ", " ", "-", "1.1.1.1", "@", "a@b.c", "+1", "999999999", ".", "300", "(", ")", "é", "٣", "x", "\n", "+", "%"]
    for _ in range(6000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 25)))
        assert pii.rule_spans(text) == plain_spans(text), text
    for text in made(200, 2):
        assert pii.rule_spans(text) == plain_spans(text) != []


def test_long_runs_take_no_square_time():
    for text in ("a" * 300_000 + "@", "1" * 300_000, "1." * 150_000, "+" * 300_000, "@" * 300_000, "a@" * 150_000, "1 " * 150_000):
        pii.rule_spans(text)


@pytest.fixture(scope="module")
def tagger():
    rows = [w for t in made(800, 3) for w in pii.labelled_windows(t)]
    model = pii.Tagger()
    losses = model.train(*pii.training_set(rows))
    assert losses[-1] < 0.2 * losses[0]
    return model


def test_gradient_is_that_of_the_loss():
    codes, tags = pii.training_set([w for t in made(8, 5) for w in pii.labelled_windows(t)])
    codes, tags = codes[:6, :20].T, np.where(tags[:6, :20] > 0, tags[:6, :20], 0).T
    model = pii.Tagger()
    model.w = {k: v.astype(np.float64) for k, v in model.w.items()}
    _, grad = model._loss(codes, tags)
    r = np.random.default_rng(0)
    for name in model.w:
        flat = model.w[name].reshape(-1)
        for at in r.integers(0, flat.size, 4):
            old = flat[at]
            flat[at] = old + 1e-3
            up = model._loss(codes, tags)[0]
            flat[at] = old - 1e-3
            down = model._loss(codes, tags)[0]
            flat[at] = old
            assert grad[name].reshape(-1)[at] == pytest.approx((up - down) / 2e-3, abs=2e-2, rel=2e-2)


def test_viterbi_is_the_best_of_all_paths():
    from itertools import product

    model = pii.Tagger(seed=3)
    codes = np.random.default_rng(1).integers(0, pii.CLASSES, (3, 4)).astype(np.uint8)
    scores = model._scores(codes.T)[0]
    step = model.w["next"] + pii._allowed()
    for row, path in enumerate(model.decode(codes)):
        score = lambda p: sum(scores[t, row, k] for t, k in enumerate(p)) + model.w["first"][p[0]] + sum(step[a, b] for a, b in zip(p[:-1], p[1:], strict=True))  # noqa: B023, E731, E501
        best = max(product(range(pii.TAGS), repeat=4), key=score)
        assert score(tuple(path)) == pytest.approx(score(best), rel=1e-5)


def test_tags_of_held_out_windows(tagger):
    codes, tags = pii.training_set([w for t in made(200, 77) for w in pii.labelled_windows(t)], seed=8)
    assert (tagger.decode(codes) == tags).all(axis=1).mean() > 0.9


def test_tagger_adds_other_spellings_and_leaves_plain_text_alone(tagger):
    before, after = "thon rehe inan erthon reth ", " and on thin here inre thonon"
    added = 0
    for kind, written in ((pii.PHONE, "(555) 123-4567"), (pii.PHONE, "555-123-4567"), (pii.EMAIL, "ann@[mail.example.com]"), (pii.IP, "10-20-30-40")):
        text = before + written + after
        spans = pii.add_spans(text, pii.rule_spans(text), pii._tagged(tagger, [text], [0]).get(0, []))
        added += any(k == kind and written.startswith(text[a:b].strip()) for k, a, b in spans)
    assert added >= 3
    for text in ("version 2.0 of 2024-05-06", "24be64439e3e49cf46b2d7c90f3602a3", "room 1234, 5,600 men", "thin and hein 19"):
        text = before + text + after
        assert pii.add_spans(text, [], pii._tagged(tagger, [text], [0]).get(0, [])) == []


def test_windows_without_a_digit_or_sign_cannot_change_the_spans(tagger):
    r = random.Random(6)
    for text in made(60, 9):
        text = text + " " + "".join(r.choice("abc de") for _ in range(r.randint(0, 300)))
        some = pii._tagged(tagger, [text], [0]).get(0, [])
        starts = list(range(0, max(0, -(-(len(text) - pii.WINDOW) // pii.STRIDE)) * pii.STRIDE + 1, pii.STRIDE))
        whole = pii.classes_of(text)
        every = pii.stitch(len(text), starts, tagger.decode(np.array([pii.window_codes(whole, s) for s in starts])))
        rules = pii.rule_spans(text)
        assert pii.add_spans(text, rules, some) == pii.add_spans(text, rules, every)


def test_report_and_mask(documents, rows):
    texts = made(120, 4)
    table = [*enumerate(texts), (500, None), (501, ""), (None, "a@b.de"), (502, "a@b.de, c@d.ef"), (502, "a@b.de, c@d.ef"), (503, "on " * 60_000 + "1.2.3.4")]
    found = pii.report(documents(table)).collect()
    assert len(found) == len(table)
    expected = {}
    for key, text in table:
        spans = plain_spans(text or "")
        written = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in spans)
        counts = [sum(s[0] == k for s in spans) for k in range(4)]
        expected[key] = (*counts, hashlib.sha256(written.encode()).hexdigest(), written)
    for r in found:
        *counts, digest, written = expected[r["doc_id"]]
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == counts
        assert r["base_sha256"] == digest
        assert set(written.split(",")) <= set(r["spans"].split(","))
    df = documents(table)
    masked = pii.mask(df)
    assert masked.columns == df.columns
    got = {r["doc_id"]: r["text"] for r in masked.collect()}
    assert got[500] is None and got[501] == "" and got[None] == "<email>" and got[502] == "<email>, <email>"
    assert got[503].endswith("on <ip>")
    assert pii.report(documents([])).count() == 0
    assert rows(pii.report(documents([(1, "no data")])), "spans") == [("",)]


def test_added_spans_equal_a_comparison_with_all():
    import random
    import time

    r = random.Random(3)
    for _ in range(300):
        base = sorted((k % 4, a, a + r.randrange(1, 9)) for k, a in enumerate(r.sample(range(200), 8)))
        text = "".join(r.choice("0123456789 +") for _ in range(220))
        tagged = [(r.randrange(4), a, a + r.randrange(1, 20)) for a in r.sample(range(190), 30)]
        out = list(base)
        for kind, start, end in tagged:
            if all(end <= a or b <= start for _, a, b in out) and pii.accept(text, kind, start, end):
                out.append((kind, start, end))
        assert pii.add_spans(text, base, tagged) == sorted(out)
    spans = [(3, 20 * k, 20 * k + 15) for k in range(40_000)]
    start = time.process_time()
    pii.add_spans("x" * 800_000, spans[::2], spans[1::2])
    assert time.process_time() - start < 2
