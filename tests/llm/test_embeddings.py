"""Vector links and components against all pairs."""

import numpy as np
import pytest

from listmill.llm import embeddings
from listmill.llm.components import components


def brute(table, cosine=0.9):
    unit = []
    for _, v in table:
        good = v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        unit.append(np.array(v, float) / np.linalg.norm(v) if good else None)
    n = len(table)
    links, root = [0] * n, list(range(n))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(n):
        for j in range(i + 1, n):
            a, b = unit[i], unit[j]
            if a is not None and b is not None and len(a) == len(b) and table[i][0] is not None and table[j][0] is not None and a @ b >= cosine:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    out = []
    for i, (key, _) in enumerate(table):
        group = [table[j][0] for j in range(n) if find(j) == find(i) and table[j][0] is not None]
        low = min(group) if key is not None else None
        out.append((key, links[i], low, key is not None and key == low))
    return out


def test_all_pairs_of_a_small_table(spark, rows, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 16)  # so that buckets are cut into blocks
    r = np.random.default_rng(1)
    table = [(k, r.standard_normal(16).tolist()) for k in range(200)]
    center = r.standard_normal(16)
    table += [(300 + k, (center + 0.05 * r.standard_normal(16)).tolist()) for k in range(60)]
    table += [(400 + k, table[5][1]) for k in range(30)]  # exact copies
    table += [(500, None), (501, []), (502, [0.0] * 16), (503, [float("nan")] + [1.0] * 15), (504, [None] + [1.0] * 15)]
    table += [(505, [float("inf")] + [1.0] * 15), (506, [1.0, 2.0]), (507, [1.0, 2.0]), (None, table[5][1]), (508, [-0.0, 1.0]), (509, [0.0, 1.0])]
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>").selectExpr("*", "1 as rep", "2 as weight", "3 as root", "4 as label")
    found = rows(embeddings.near_duplicates(df))
    assert found == sorted(brute(table), key=lambda x: tuple((v is not None, str(type(v)), v) for v in x))


def test_links_at_the_threshold_are_met(spark):
    r = np.random.default_rng(2)
    table = []
    for k in range(400):
        a = r.standard_normal(64)
        a /= np.linalg.norm(a)
        b = r.standard_normal(64)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        table += [(2 * k, a.tolist()), (2 * k + 1, (0.905 * a + np.sqrt(1 - 0.905**2) * b).tolist())]
    found = embeddings.near_duplicates(spark.createDataFrame(table, "vec_id long, embedding array<double>"))
    assert found.filter("n_links = 1").count() >= 0.99 * len(table)


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embeddings.near_duplicates(df).count() == 0


def test_more_vectors_get_more_bits_and_tables():
    assert embeddings.plan(10) == embeddings.plan(60_000)
    assert embeddings.plan(10**9)[0] > embeddings.plan(10**6)[0] > 8
    for n in (10, 10**6, 10**9):
        bits, tables = embeddings.plan(n)
        meet = (1 - np.arccos(0.9) / np.pi) ** bits
        assert 1 - (1 - meet) ** tables >= embeddings.RECALL


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    r = np.random.default_rng(seed)
    links = [(int(a), int(b)) for a, b in r.integers(0, 300, (220, 2))]
    links += [(400, 400 + k) for k in range(1, 80)] + [(500 + k, 501 + k) for k in range(40)] + [(7, 7), (None, 3), (4, None)]
    root = {}

    def find(k):
        root.setdefault(k, k)
        while root[k] != k:
            k = root[k]
        return k

    for a, b in links:
        if a is not None and b is not None and a != b:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    found = components(spark.createDataFrame(links, "a long, b long"))
    assert {r["node"]: r["root"] for r in found.collect()} == {k: find(k) for k in root}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_unlike_vectors_may_share_an_id(spark, rows):
    table = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.01]), (3, [0.01, 1.0]), (4, [1.0, 0.0]), (0, [-1.0, 0.0]), (0, [0.7, 0.7])]
    found = rows(embeddings.near_duplicates(spark.createDataFrame(table, "vec_id long, embedding array<double>")))
    assert found == sorted(brute(table))
    assert [r[1] for r in found if r[0] in (1, 4)] == [1, 2, 2]
