"""Ranked search against scores of all pairs, in integers."""

import math
import random
import re

import pytest

from listmill.llm import lexical

DOCS = "doc_id long, text string, m string, part int, item int, terms string, score long, rank int"
ITEMS = "item_id long, text string, doc_id long, m string, item string"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(LOW))


def plain(docs, items, k=50):
    held = [(doc_id, terms(text)) for doc_id, text in docs]
    held = [(d, t) for d, t in held if t]
    n_docs, length = len(held), sum(len(t) for _, t in held)
    df = {}
    for _, t in held:
        for word in set(t):
            df[word] = df.get(word, 0) + 1
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, words in asked.items():
        scored = []
        for doc_id, t in held:
            m = 50 + (50 * len(t) * n_docs) // length
            score = 0
            for word in words & set(t):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[word] + 1)))
                score += w * ((1_000_000_000 * t.count(word)) // (1000 * t.count(word) + 20 * m))
            if score > 0:
                scored.append((-score, doc_id is not None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(scored)[:k], 1):
            out.append((item, rank, doc_id, -score))
    return sorted(out, key=str)


def found(spark, docs, items, k=50):
    table = spark.createDataFrame([(*d, "x", 1, 2, "y", 3, 4) for d in docs], DOCS).repartition(3)
    asked = spark.createDataFrame([(*i, 1, "x", "y") for i in items], ITEMS)
    rows = lexical.search(table, asked, k)
    assert rows.columns == ["item_id", "rank", "doc_id", "score"] and dict(rows.dtypes)["rank"] == "int"
    return sorted((tuple(r) for r in rows.collect()), key=str)


def corpus(seed, n=400):
    r = random.Random(seed)
    words = [f"w{k}" for k in range(60)] + ["Étude", "étude", "中文", "naïve", "a1b2", "𝔘x"]
    weight = [1 / (k + 1) for k in range(len(words))]
    docs = []
    for k in range(n):
        size = r.choice([0, 1, 2, 5, 5, 5, 40, 300])
        text = "".join(w.upper() if r.random() < 0.2 else w + r.choice([" ", ", ", "_", "\n", "'"]) for w in r.choices(words, weight, k=size))
        docs.append((r.choice([k, k, k, None, 7]), r.choice([text] * 9 + [None])))
    docs += [(1000 + k, "w3 w5 étude") for k in range(120)] + [(2000, "w1 " * 3000 + "中文 " * 9)]
    items = [(k, " ".join(r.choices(words, k=r.choice([1, 3, 12])))) for k in range(25)]
    items += [(30, None), (31, "  ., "), (32, "unheard of"), (33, "w1 W1 w1"), (33, "w2"), (None, "naïve a1b2"), (34, "w3 w5 étude")]
    return docs, items


@pytest.mark.parametrize("seed, block, opening, batch", [(1, 4096, 2000, 1 << 18), (2, 7, 1, 1 << 18), (3, 16, 60, 9)])
def test_equals_all_pairs(spark, monkeypatch, seed, block, opening, batch):
    monkeypatch.setattr(lexical, "BLOCK", block)
    monkeypatch.setattr(lexical, "OPENING", opening)
    monkeypatch.setattr(lexical, "TERMS", batch)
    docs, items = corpus(seed)
    if batch < 100:
        docs, items = docs[:60] + docs[-20:], items[::4]
    assert found(spark, docs, items) == plain(docs, items)


def test_few_best_of_many_equal_documents(spark):
    docs = [(k, "same words here") for k in range(3000)]
    items = [(1, "words"), (2, "Same HERE")]
    assert found(spark, docs, items, 5) == plain(docs, items, 5)


@pytest.mark.parametrize("docs, items", [([], [(1, "w")]), ([(1, "w x")], []), ([(1, None), (2, "")], [(1, "w")]), ([(1, "w")], [(1, None)])])
def test_empty_sides(spark, docs, items):
    assert found(spark, docs, items) == []


def test_one_very_long_text(spark):
    docs = [(1, "alpha beta " * 200_000 + "gamma"), (2, "gamma"), (3, "g" * 3_000_000)]
    items = [(1, "gamma alpha"), (2, "g" * 3_000_000)]
    assert found(spark, docs, items) == plain(docs, items)


def test_bounds_rule_out_strata(spark):
    """Long documents that hold a term once cannot reach the best short ones and are not scored."""
    docs = [(k, "needle " + "hay " * (3 + k % 3)) for k in range(3000)] + [(9000 + k, "needle " + f"straw{k} " * (500 + k)) for k in range(300)]
    index = lexical.build(spark.createDataFrame([(*d, "x", 1, 2, "y", 3, 4) for d in docs], DOCS), ["needle"])
    assert index.documents == 3300 and index.df.tolist() == [3300]
    assert index.rows().count() > 100
    assert found(spark, docs, [(1, "needle")]) == plain(docs, [(1, "needle")])
