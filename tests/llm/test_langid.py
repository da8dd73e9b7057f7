"""Language profiles against a plain version of the same method, and held-out accuracy."""

import zlib
from collections import Counter

import pytest

from listmill.llm import langid
from listmill.llm.queries import table

TEXTS = {
    "en": "the cat and the dog went to the house with the thing that they wanted and then left again",
    "de": "der hund und die katze gingen nicht in das haus mit dem ding das sie wollten und gingen wieder",
    "es": "el perro y la gata fueron a la casa con la cosa que ellos querían y luego se fueron otra vez",
}


def plain_grams(text):
    letters = "".join((c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " " for c in text)
    found = Counter()
    for word in letters.split():
        padded = f" {word} "
        for n in (1, 2, 3):
            for k in range(len(padded) - n + 1):
                gram = padded[k : k + n]
                if gram.strip() and (n < 3 or gram[1] != " "):
                    found[gram] += 1
    return found


def boundary_grams(text):
    """A blank between two words belongs to both: bigrams and trigrams overlap there, unigrams of blanks do not count."""
    return plain_grams(text)


def test_counts_are_those_of_padded_words(spark, documents):
    df = documents([(1, TEXTS["en"], "en"), (2, "Été, été!", "fr"), (3, "x", "fr")])
    counted = langid._counted(df, "lang", "text").collect()

    def name(code, n):
        return "".join(chr((code >> (21 * k)) & 0x1FFFFF) or " " for k in range(n - 1, -1, -1)).replace("\0", " ")

    for language, texts in (("en", [TEXTS["en"]]), ("fr", ["Été, été!", "x"])):
        mine = {(r["n"], name(r["gram"], r["n"])): r["times"] for r in counted if r["language"] == language}
        expected = Counter()
        for t in texts:
            expected.update(boundary_grams(t))
        assert mine == {(len(g), g): n for g, n in expected.items()}


def test_distance_is_that_of_the_ranks(documents):
    df = documents([(k, t, lang) for k, (lang, t) in enumerate(TEXTS.items())])
    profiles = langid.learn(df, length=60)
    names = {}
    for lang, text in TEXTS.items():
        # ranks by count, then length and code point
        order = sorted(plain_grams(text).items(), key=lambda g: (-g[1], len(g[0]), [0 if c == " " else ord(c) for c in g[0]]))
        names[lang] = {g: k for k, (g, _) in enumerate(order[:60])}
    place = {0: 0} | {int(c): k + 1 for k, c in enumerate(profiles.alphabet)}
    for text in ("the house and the hound", "das haus und der hund", "la casa", "Zebra!", "ñandú", "日本 the"):
        code = lambda g: [place.get(0 if c == " " else ord(c), len(place)) for c in g]
        merged = Counter()
        for g, n in plain_grams(text).items():
            merged[(len(g), tuple(code(g)))] += n
        ranked = sorted(merged.items(), key=lambda g: (-g[1], g[0]))[:60]
        by_code = {lang: {(len(g), tuple(code(g))): k for g, k in ranks.items()} for lang, ranks in names.items()}
        total = {lang: sum(abs(ranks[g] - k) if g in ranks else 60 for k, (g, _) in enumerate(ranked)) for lang, ranks in by_code.items()}
        best = min(sorted(total), key=total.get)
        import numpy as np

        raw = text.encode()
        which, score = profiles.predict(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        assert profiles.names[which[0]] == best
        assert score[0] == pytest.approx(1 - total[best] / (60 * len(ranked)))


def test_defined_cases(spark, documents, rows):
    table = [(k, f"{t} {t}", lang) for k in range(0, 60, 3) for k, (lang, t) in zip((k, k + 1, k + 2), TEXTS.items(), strict=True)]
    odd = [(100, None, "en"), (101, "", "en"), (102, "12 34 !?", "de"), (None, TEXTS["de"], "de"), (103, "und der " * 50_000, None), (103, "und der " * 50_000, None)]
    found = rows(langid.identify(documents(table + odd)))
    got = {r[0]: r for r in found}
    assert len(found) == len(table) + len(odd)
    assert all(got[k][2] == lang for k, _, lang in table)
    for key in (100, 101, 102):
        assert got[key][2:] == ("und", 0.0)
    assert got[103][2] == "de" and got[None][2] == "de"
    assert all(r[1] == (zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 5 == 0) for r in found)
    assert all(0 <= r[3] <= 1 for r in found)


def test_without_labels_all_is_undetermined(documents, rows):
    assert rows(langid.identify(documents([(1, "some text", None), (2, None, None)])), "lang_pred", "score") == [("und", 0.0)] * 2
    assert langid.identify(documents([])).count() == 0


def test_kept_rows_have_all_their_columns(documents):
    df = documents([(k, t, lang) for k, (lang, t) in enumerate(TEXTS.items())] + [(7, None), (8, "123"), (9, "日本語")])
    kept = langid.keep(df, langid.learn(df), 0.2)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 1, 2]


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    found = langid.identify(docs).filter("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(found) > 100
    assert sum(r["lang"] == r["lang_pred"] for r in found) >= 0.99 * len(found)
