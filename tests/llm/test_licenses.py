"""License blocks and phrases against a plain search."""

import math
import random
import re

from listmill.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def plain_base(text):
    w = words(text)
    out = []
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        out += [(label, k) for k in range(len(w)) if w[k : k + len(p)] == p]
    return sorted(out, key=lambda x: (x[1], x[0]))


def plain_blocks(text, templates, threshold):
    w, out = words(text), []
    for number, (label, template) in enumerate(templates):
        t = words(template)
        size, names = len(t), set(t)
        for start in range(0, max(len(w), 1), size):
            held = set(w[start : start + 2 * size])
            if len(held & names) >= math.ceil(threshold * len(names) - 1e-9):
                out.append((number, label, start, min(start + 2 * size, len(w)), len(held & names) / len(names)))
    return sorted(out)


def texts():
    r = random.Random(4)
    vocabulary = [x for _, t in licenses.TEMPLATES for x in words(t)] + ["cc", "by", "all", "rights", "reserved", "ümlaut", "foo", "bar", "x1"] * 8
    made = [" ".join(r.choice(vocabulary) for _ in range(r.randint(0, 60))) for _ in range(400)]
    for _ in range(200):
        label, template = r.choice(licenses.TEMPLATES)
        w = template.split()
        for _ in range(r.randint(0, 4)):
            w[r.randrange(len(w))] = r.choice(["foo", "bar", ""])
        made.append(" ".join(r.choice(["foo", "baz", "qux"]) for _ in range(r.randint(0, 40))) + ", " + " ".join(w).upper() + "! foo")
    return made + ["", "CC-BY cc by CC BY", "All Rights Reserved. all rights all rights reserved", "foo " * 60_000 + "general public license"]


def test_scan_equals_plain_search(documents):
    table = [*enumerate(texts()), (None, "cc by"), (9_000, None), (9_001, "cc by"), (9_001, "cc by")]
    found = licenses.scan(documents(table)).collect()
    assert len(found) == len(table)
    by_text = {}
    for r in found:
        by_text.setdefault(r["doc_id"], []).append(r)
    for key, text in table:
        r = by_text[key][0]
        assert r["n_words"] == len(words(text))
        assert [tuple(p) for p in r["places"]] == plain_base(text)
        expected = [b[1:] for b in plain_blocks(text, licenses.TEMPLATES, licenses.THRESHOLD)]
        assert [tuple(b) for b in r["blocks"]] == expected, text


def test_order_of_the_words_does_not_change_what_is_found():
    for frequency in ({}, {w.encode(): k for k, w in enumerate(words(" ".join(t for _, t in licenses.TEMPLATES)))}):
        index = licenses.Index(licenses.TEMPLATES, frequency, 0.6, licenses.PHRASES)
        for text in texts()[:300]:
            assert index.blocks(licenses.words_of(text)) == [b[1:] for b in plain_blocks(text, licenses.TEMPLATES, 0.6)]


def test_report(documents, rows):
    table = [
        (1, "x y All rights reserved, CC BY cc-by"), (2, None), (3, ""), (4, "Licensed under the Apache License, Version 2.0."),
        (5, "This work is licensed under the GNU General Public License, version 3."), (None, "cc by"),
    ]
    found = rows(licenses.report(documents(table)))
    assert found == [
        (None, 2, 1, 0, 0, "cc-by", "cc-by", 1.0),
        (1, 9, 3, 2, 7, "cc-by,reserved", "cc-by,reserved", 1.0),
        (2, 0, 0, None, None, "", "", 0.0),
        (3, 0, 0, None, None, "", "", 0.0),
        (4, 8, 0, None, None, "", "apache", 1.0),
        (5, 12, 1, 7, 7, "gpl", "gpl", 1.0),
    ]
    assert licenses.report(documents([])).count() == 0


def test_a_notice_with_words_put_in_is_found_wherever_it_starts(documents, rows):
    notice = "Licensed under the following terms that is to say Apache License Version 2.0"
    table = [(k, " ".join(["qux"] * k) + f" {notice} and more") for k in range(40)]
    found = rows(licenses.report(documents(table)), "doc_id", "labels", "score")
    assert found == [(k, "apache", 1.0) for k in range(40)]


def test_passages_are_those_of_every_window():
    index = licenses.Index(licenses.TEMPLATES, {}, 0.7, licenses.PHRASES)
    for text in texts():
        w = words(text)[:3_000]
        best = {}
        for number, (label, template) in enumerate(licenses.TEMPLATES):
            names, width = set(words(template)), 2 * len(words(template))
            share = max((len(names & set(w[at : at + width])) / len(names) for at in range(max(1, len(w)))), default=0)
            if share * len(names) >= math.ceil(0.7 * len(names) - 1e-9) - 1e-6:
                best[label] = max(best.get(label, 0), share)
        found = {}
        for label, first, end, share in index.passages([x.encode() for x in w]):
            assert 0 <= first < end <= len(w)
            found[label] = max(found.get(label, 0), share)
        assert found == best, text
