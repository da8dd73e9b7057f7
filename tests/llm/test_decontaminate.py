"""Benchmark items in documents against SQL and planted cases."""

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from listmill.llm import decontaminate

MARIA = "Maria buys 3 pens. Each costs 2 dollars. Maria pays 10 dollars. How much change does Maria get?"
FAMILY = "A train leaves at {} and needs {} hours for {} miles. How fast does the train go on its way?"
SLOTS = "There are 12 red, 7 blue, 5 green, 12 white, 9 black, 3 brown, 4 pink and 6 gray balls. How many balls of all colours are there?"
ITEMS = [
    (1, "A baker sold Anna Smith 12 loaves of bread for 30 dollars on market day. How much did Anna Smith pay for each of the 12 loaves?"),
    (2, "The quick brown fox jumps over the lazy dog while seven small birds watch quietly from the old fence."),
    (3, "The quick brown fox jumps over the lazy dog while seven small birds watch quietly from the old fence."),
    (4, "1 2 3 4 5 6 7 8 9 10 11 12 13 14"),
    (5, "too short here"),
    (6, "five words are a template"),
    (7, None), (None, "a row without an id is not looked for in any of the documents here"), (8, ""),
    (20, MARIA), (21, "Compute 12 + 7 * 3 - 4 / 2"), (22, "Why is grass green?"), (23, "Yes"), (24, "Not now"),
    (30, FAMILY.format(5, 3, 120)), (31, FAMILY.format(8, 2, 90)), (32, FAMILY.format(2, 2, 90)), (33, SLOTS), (34, "x1 y"),
]
OTHER = ITEMS[0][1].replace("Anna Smith", "Bob").replace("12", "7").replace("30", "45.5")
TORN = OTHER.replace("the 7 loaves", "the 9 loaves").replace("did Bob pay", "did Carl pay")
# the same question with other values, of which the first fourteen words stand before the question itself
SIBLING = SLOTS.replace("12", "80").replace("7 blue", "81 blue").replace("5 green", "82 green").replace("9 black", "83 black")
DOCS = [
    (1, "Some words before. " + ITEMS[0][1] + " And after."),
    (2, "lower case before " + OTHER + " and after"),
    (3, TORN),
    (4, "intro " + ITEMS[1][1] + " " + ITEMS[1][1]),
    (5, "The quick brown fox jumps over a wall and the lazy dog sleeps while birds sing"),
    (6, "1 2 3 4 5 6 7 8 9 10 11 12 13 14 20 30 40 50"),
    (7, "these five words are a template indeed, " + "filler word " * 30_000),
    (8, None), (9, ""), (None, ITEMS[1][1]), (10, "too short here"), (11, ITEMS[1][1].upper()), (11, ITEMS[1][1]),
    (12, "x, " + " ".join(ITEMS[1][1].split()[:14]) + " y"),
    (20, "Solve this. " + MARIA.replace("Maria", "Ivan")), (21, "Q: \"" + MARIA.replace("Maria", "Ivan").replace("3", "4") + "\""),
    (22, MARIA.replace("does Maria", "does Olga")), (23, "Now: Compute 12 + 7 * 3 - 4 / 2 and say it"), (24, "Compute 13 + 8 * 4 - 5 / 3"),
    (25, "He asked: why is grass green? Nobody knew."), (26, "grass is green, why"), (27, "Yes"), (28, "Yes, we can, not now"), (29, "not NOW."),
    (30, "x " + FAMILY.format(8, 2, 90)), (31, FAMILY.format(7, 7, 300)), (32, " ".join(SIBLING.split()[:14]) + " " + SLOTS),
    (33, "15 16 17 18 19 20 21 22 23 24"), (34, "all new words that no item has, in a text of fair length, without end"),
    (35, FAMILY.format(8, 2, 90).replace("How fast", "And now, after many other words, tell me how fast")),
]


@pytest.fixture(scope="module")
def benchmark(spark):
    df = spark.createDataFrame(ITEMS, "item_id long, text string")
    return df.withColumns({c: F.lit("x") for c in ("id", "form", "hash", "place", "words", "doc_id", "source", "rep", "part", "way")})


@pytest.fixture(scope="module")
def held(documents, benchmark):
    df = decontaminate.contaminated(documents(DOCS), benchmark)
    plan = df._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
    return df.collect()


def test_planted_cases(held):
    found = {(r["doc_id"], r["item_id"]): r for r in held}
    items = {}
    for doc, item in found:
        items.setdefault(doc, set()).add(item)
    expected = {
        1: {1}, 2: {1}, 4: {2, 3}, 6: {4}, 7: {6}, 10: {5}, 11: {2, 3}, 12: {2, 3}, 20: {20}, 21: {20}, 23: {21}, 25: {22}, 27: {23}, 29: {24},
        22: {20}, 30: {30, 31, 32}, 31: {30, 31, 32}, 32: {33}, 35: {30, 31, 32},
    }
    assert items == expected
    # the values of 30 disagree with the equal ones of item 32, whose question stands there without values all the same
    assert found[30, 31]["consistent"] and not found[30, 32]["consistent"]
    assert found[1, 1]["share"] == found[4, 2]["share"] == found[7, 6]["share"] == found[32, 33]["share"] == 1.0
    assert found[2, 1]["consistent"] and found[2, 1]["share"] == 1.0 and found[20, 20]["consistent"]


def test_sql_gives_the_same(held):
    con = duckdb.connect()
    con.register("docs", pd.DataFrame(DOCS, columns=["doc_id", "text"]).astype({"doc_id": "Int64"}))
    con.register("items", pd.DataFrame(ITEMS, columns=["item_id", "text"]).astype({"item_id": "Int64"}))
    con.execute("CREATE VIEW documents AS SELECT * FROM docs; CREATE VIEW benchmark AS SELECT * FROM items")
    expected = con.execute(decontaminate.SQL).fetchall()
    assert sorted(tuple(r) for r in held) == sorted(expected)


def test_a_shuffled_join_gives_the_same(documents, benchmark, held, monkeypatch):
    few = sorted(tuple(r) for r in held)
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    assert sorted(tuple(r) for r in decontaminate.contaminated(documents(DOCS), benchmark).collect()) == few


def test_places_of_slots_shuffled_beside_the_texts_give_the_same(documents, benchmark, held, monkeypatch):
    # with copies of documents and items, whose windows and alignments overlap
    few = {tuple(r) for r in held}
    monkeypatch.setattr(decontaminate, "BROADCAST_SPOTS", 0)
    assert {tuple(r) for r in decontaminate.contaminated(documents([*DOCS, *DOCS]), benchmark.union(benchmark)).collect()} == few


def test_clean_documents_keep_all_columns(documents, benchmark):
    df = documents(DOCS)
    kept = decontaminate.clean(df, benchmark)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] is not None, r["doc_id"]) for r in kept.collect()) == [(False, None), *((True, k) for k in (3, 5, 8, 9, 24, 26, 28, 33, 34))]


def test_empty_tables(documents, benchmark):
    assert decontaminate.contaminated(documents([]), benchmark).count() == 0
    assert decontaminate.contaminated(documents(DOCS), benchmark.limit(0)).count() == 0


def test_window_hashes(spark):
    df = spark.createDataFrame([(["a", "b", "c", "d", "e", "f"],), (["b", "c", "d", "e", "f", "g"],), (["a"],), ([],)], "w array<string>")
    for width in (1, 2, 3, 5, 6):
        a, b, c, d = (r["hashes"] for r in decontaminate.window_hashes(df, width, "w").collect())
        assert len(a) == len(b) == 7 - width and a[1:] == b[:-1] and len(set(a)) == len(a)
        assert len(c) == (width == 1) and d == []
