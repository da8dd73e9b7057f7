"""Shards against the laws they must keep."""

import zlib

import numpy as np
import pytest

from listmill.llm import sharding


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 65, 1000, 4097])
def test_permutation_and_its_inverse(n):
    numbers = sharding.permute(np.arange(n), n)
    assert sorted(numbers) == list(range(n))
    assert (sharding.restore(numbers, n) == np.arange(n)).all()
    shard, slot = sharding.place_of(np.arange(n), n, 3)
    assert (sharding.row_at(shard, slot, n, 3) == np.arange(n)).all()


def test_rows_beyond_the_table_are_refused():
    with pytest.raises(ValueError):
        sharding.permute([5], 5)


def test_seeds_differ():
    assert (sharding.permute(np.arange(1000), 1000, 1) != sharding.permute(np.arange(1000), 1000, 2)).mean() > 0.9


def test_report(documents, rows):
    table = [(k, f"text {k}") for k in range(95)] + [(None, "x"), (None, None), (3, "text 3"), (200, ""), (201, "ü" * 50_000)]
    found = rows(sharding.report(documents(table)))
    again = rows(sharding.report(documents(table[::-1]).repartition(7)))
    assert found == again
    expected = sorted((k if k is not None else -1, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in table)
    assert sorted((r[0] if r[0] is not None else -1, r[1], r[2]) for r in found) == expected
    sizes = [sorted(r[5] for r in found if r[4] == s) for s in range(8)]
    assert all(s == list(range(len(s))) for s in sizes)
    assert max(map(len, sizes)) - min(map(len, sizes)) <= 1
    assert {(r[3], r[6]) for r in found} == {("rows", None)}
    assert sharding.report(documents([])).count() == 0


def test_rows_take_their_place_in_the_order(spark):
    df = spark.createDataFrame([(k % 3, f"{k:03d}") for k in range(300)], "a int, b string").repartition(5)
    numbered = {(r["a"], r["b"]): r["row_number"] for r in sharding.numbered(df, ["a", "b"]).collect()}
    assert [numbered[k] for k in sorted(numbered)] == list(range(300))


def test_one_key_may_hold_all_rows(spark):
    df = spark.range(500).selectExpr("cast(null as long) as a", "1 as shard")
    found = sharding.assign(df, ["a"], 4).collect()
    assert sorted(r["row_number"] for r in found) == list(range(500))
    assert [sum(r["shard"] == s for r in found) for s in range(4)] == [125] * 4
