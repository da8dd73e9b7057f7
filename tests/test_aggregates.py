"""Cells maintained from upserts against aggregates of the served view."""

import datetime as dt
import random

from pyspark.sql import functions as F

from listmill.operators import market
from listmill.session import fresh_dir
from listmill.sources import messages, tables
from listmill.streaming import aggregates

SCHEMA = (
    "id string, table string, estate_type string, province string, district string, post_date date, price double, price_per_m2 double, square double,"
    " created_at string, kafka_offset long"
)


def batch(r, day, n=60):
    pick = lambda *x: r.choice(x)
    return [
        (pick(*[f"i{k}" for k in range(40)], None), pick("a", "b"), pick("nhà", "nhà cho thuê", None), "P", pick("d1", "d2", None),
         dt.date(2024, 1, pick(1, 2, 5)), pick(None, r.randrange(1000) * 1.0), 2.0 * r.randrange(9), pick(None, 30.0), f"2024/01/{day + r.randrange(-2, 1):02d} 00:00:00", k)
        for k in range(n)
    ]


def test_cells_equal_the_served_view_after_each_micro_batch(spark):
    source, served, cells, checkpoint = (fresh_dir(spark, n) for n in ("cells-in", "cells-served", "cells-out", "cells-ckpt"))
    r = random.Random(4)
    for day in (5, 6, 7, 8):
        spark.createDataFrame(batch(r, day), SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = messages.file_stream(spark, source, SCHEMA, "parquet", max_files=1)
        aggregates.publish_with_cells(stream, served, cells, checkpoint, once=True).awaitTermination()
    view = tables.read_latest(spark, served).withColumnRenamed("table", "category")
    found = aggregates.read_cells(spark, cells)
    assert found.agg(F.sum("n")).first()[0] == view.count()
    domain = spark.createDataFrame([("P", "d1"), ("P", "d2"), ("P", "d3")], "province string, district string")
    read = lambda df: sorted((tuple(x) for x in df.collect()), key=str)
    for kind in ("buy", "rent"):
        for metric in aggregates.METRICS:
            for category in (None, "a"):
                assert read(aggregates.by_district(found, domain, metric, kind, category)) == read(market.by_district(view, domain.select("district"), metric, kind, category))
            mine, theirs = (f(x, metric, "d1", "2024-01-01", "2024-01-31", kind) for f, x in ((aggregates.by_day, found), (market.by_day, view)))
            assert read(mine) == read(theirs)
    folded = aggregates.fold(spark, cells)
    assert read(aggregates.read_cells(spark, folded)) == read(found)


def test_a_repeated_batch_counts_once(spark):
    served, cells = fresh_dir(spark, "again-served"), fresh_dir(spark, "again-cells")
    rows = spark.createDataFrame(batch(random.Random(1), 5), SCHEMA)
    before = aggregates.differences(rows.limit(0), rows)
    tables.write_batch(before, cells, 0)
    tables.write_batch(before, cells, 0)
    assert aggregates.read_cells(spark, cells).agg(F.sum("n")).first()[0] == rows.count()
    assert aggregates.differences(rows, rows).isEmpty() and served
