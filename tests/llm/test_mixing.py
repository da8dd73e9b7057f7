"""The curriculum mix against targets shared by hand, its SQL and numerical integrals."""

import math
import re

import duckdb
import numpy as np
import pandas as pd
import pytest

from listmill.llm import mixing

DOCS = "doc_id long, text string, source string, size string, rank long, target string, passes string, position string"


def build(spark, rows):
    full = [(*r, "x", 7, None, None, "p") for r in rows]
    return spark.createDataFrame(full, DOCS)


def plain_targets(sizes: list[tuple], weights=(3, 1, 2), budget=1.5, most=2) -> dict:
    order = sorted(sizes, key=lambda s: (s[0] is None, (s[0] or "").encode()))
    weight = {name: weights[k % len(weights)] for k, (name, _) in enumerate(order)}
    size = dict(order)
    free, left, out = set(size), budget * sum(size.values()), {}
    while free:
        heavy = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / heavy > most * size[s]}
        if not over:
            out |= {s: left * weight[s] / heavy for s in free}
            break
        out |= {s: float(most * size[s]) for s in over}
        left -= sum(most * size[s] for s in over)
        free -= over
    return out


def words(n, salt=""):
    return " ".join(f"w{salt}{k}" for k in range(n))


CORPUS = (
    [(k, words(1 + k % 37), "hot") for k in range(300)]
    + [(1000 + k, words(3), f"s{k % 5}") for k in range(40)]
    + [(2000, words(5000), "\U0001f600big"), (2001, words(7), ""), (2002, words(9), None), (None, words(4), None), (2003, None, "hot")]
    + [(2004, "", "s1"), (2005, "\x0b\t \n", "s1"), (2006, "a\x0bb c", "s1")]
    + [(7, words(8), "hot")] * 25
    + [(2007, None, "only null"), (2008, words(11), "Z"), (2008, words(12), "Z")]
)


def test_targets_and_taken_words(spark):
    found = [r.asDict() for r in mixing.report(build(spark, CORPUS).repartition(5)).collect()]
    assert len(found) == len(CORPUS)
    sizes = {}
    for _, text, source in CORPUS:
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    wanted = plain_targets(list(sizes.items()))
    for source, size in sizes.items():
        rows = [r for r in found if r["source"] == source]
        assert {r["source_size"] for r in rows} == {size}
        assert all(math.isclose(r["target"], wanted[source], rel_tol=1e-12, abs_tol=1e-9) for r in rows)
        assert sum(r["taken"] for r in rows) == math.floor(wanted[source] + 0.5)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in found)
    assert all((r["position"] is None) == (r["taken"] == 0) for r in found)
    assert math.isclose(sum(wanted.values()), 1.5 * sum(sizes.values()))
    given = [r["position"] for r in found if r["position"] is not None]
    assert given == sorted(given) and 0 <= given[0] and given[-1] < 1


def test_reruns_agree(spark, rows):
    first = rows(mixing.report(build(spark, CORPUS)))
    assert first == rows(mixing.report(build(spark, CORPUS[::-1]).repartition(7)))


def test_small_leaves_give_the_same(spark, rows, monkeypatch):
    first = rows(mixing.report(build(spark, CORPUS)))
    monkeypatch.setattr(mixing, "LEAF_ROWS", 1)
    assert first == rows(mixing.report(build(spark, CORPUS)))


def test_equals_its_sql(spark):
    docs = build(spark, CORPUS)
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(CORPUS, columns=["doc_id", "text", "source"]).astype({"doc_id": "Int64"}))
    theirs = con.execute(mixing.SQL).fetchall()
    names = [d[0] for d in con.description]
    mine = [tuple(r) for r in mixing.report(docs).select(*names).collect()]
    key = lambda r: tuple((v is None, round(v, 9) if isinstance(v, float) else v) for v in r)
    assert sorted(map(key, mine), key=str) == sorted(map(key, theirs), key=str)


@pytest.mark.parametrize("table", [[], [(1, None, "a"), (2, "", None)]])
def test_tables_without_words(spark, table):
    found = mixing.report(build(spark, table)).collect()
    assert [(r["size"], r["target"], r["taken"], r["position"]) for r in found] == [(0, 0.0, 0, None)] * len(table)


def test_one_document_is_taken_in_part(spark):
    (row,) = mixing.report(build(spark, [(1, words(101), "a")])).collect()
    assert (row["taken"], row["position"]) == (152, 0.0) and 0 < row["second_position"] < 1


def test_budget_beyond_every_bound(spark):
    found = mixing.mix(build(spark, CORPUS[:20]), budget=5.0).collect()
    assert all(r["taken"] == 2 * r["size"] for r in found)


@pytest.mark.parametrize("schedule", mixing.SCHEDULES)
def test_position_inverts_the_integral(spark, schedule):
    times = np.linspace(0, 1, 200_001)
    density = np.interp(times, [t for t, _ in schedule], [d for _, d in schedule])
    given = np.concatenate(([0], np.cumsum((density[1:] + density[:-1]) / 2)))
    given /= given[-1]
    asked = spark.range(101).selectExpr("id / 100.0D as part")
    found = asked.select("part", mixing._inverse(schedule, asked["part"]).alias("time")).collect()
    assert all(abs(np.interp(r["time"], times, given) - r["part"]) < 1e-6 for r in found)


def test_training_order_keeps_texts_and_moves_early_sources_forward(spark):
    docs = build(spark, [(k, words(10, k), "abc"[k % 3]) for k in range(300)])
    rows = mixing.training_order(docs).collect()
    at = [r["position"] for r in rows]
    assert at == sorted(at)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert all(r["text"] == texts[r["doc_id"]] for r in rows)
    half = [r["source"] for r in rows if r["position"] < 0.5]
    # the first source is asked for early, the third late
    assert half.count("a") / sum(r["source"] == "a" for r in rows) > 0.55
    assert half.count("c") / sum(r["source"] == "c" for r in rows) < 0.35
