"""Registered queries against their SQL on the smallest supplied tables."""

from pathlib import Path

import duckdb
import pandas as pd
import pytest

from listmill.checks import load

FOLDER = Path("/root/testdata/sf0.001")
QUERIES, ORACLES = load()
LIGHT = [
    "unit_price_bounds_exact", "trimmed_listings", "trimmed_price_by_district", "avg_price_by_day", "heat_layer",
    "strip_special", "category_label", "extras_substring", "gazetteer_resolve", "route_by_filename", "dedup_keep_first",
    "lambda_merge", "page_links", "context_window", "conversation_upsert", "confusion_metrics", "search_strict",
    "search_fallback", "cosine_pairs", "job_batch_clean", "keyed_upsert", "stream_to_lake",
]


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.skipif(not FOLDER.exists(), reason="supplied tables are absent")
@pytest.mark.parametrize("name", LIGHT)
def test_query_equals_sql(spark, name):
    from tools.compare import frame

    con = duckdb.connect()
    for file in FOLDER.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    df = QUERIES[name](spark, str(FOLDER))
    mine = pd.DataFrame([tuple(r) for r in df.collect()], columns=df.columns, dtype=object)
    cursor = con.execute(ORACLES[name])
    theirs = pd.DataFrame(cursor.fetchall(), columns=[d[0] for d in cursor.description], dtype=object)
    assert frame(mine) == frame(theirs)
