"""Sources, sinks and streams."""

import json

from pyspark.sql import functions as F

from listmill.functions.jsontext import encode
from listmill.operators.records import with_ingest_date
from listmill.plans import jobs
from listmill.schema import LISTING_MESSAGE
from listmill.session import balanced, fresh_dir, small
from listmill.sources import files, messages, tables
from listmill.streaming import flows


def test_crawl_files_of_both_forms(spark, tmp_path):
    (tmp_path / "d" / "e").mkdir(parents=True)
    (tmp_path / "d" / "a_batch.json").write_text('{"title": "1"}\nbroken\n{"title": "2", "extra_infos": {"k": "v"}}\n')
    (tmp_path / "d" / "e" / "b_batch.json").write_text(json.dumps([{"title": "3"}, {"title": "4"}], indent=1))
    (tmp_path / "d" / "c_batch.json").write_text("")
    (tmp_path / "d" / "other.json").write_text('{"title": "5"}')
    got = {(r.title, r.file_name) for r in files.read_crawl(spark, str(tmp_path)).collect()}
    assert got == {("1", "a_batch.json"), ("2", "a_batch.json"), ("3", "b_batch.json"), ("4", "b_batch.json")}


def test_crawl_keeps_what_can_be_read(spark, tmp_path):
    good = "".join(json.dumps({"title": str(k), "square": k}) + "\n" for k in range(9))
    (tmp_path / "a_batch.json").write_text(good + "[broken\n" + '{"title": "x", "square": "wide", "price": 5}\n{"title": "y", "square": "12.5"}\n{bad\n')
    (tmp_path / "b_batch.json").write_text("\n  " + json.dumps([{"title": "p", "square": "wide"}, {"title": "q", "square": 2}], indent=1))
    rows = files.read_crawl(spark, str(tmp_path))
    assert rows.count() == 13
    got = {r.title: (r.square, r.price) for r in rows.collect()}
    assert got["8"] == (8.0, None) and got["x"] == (None, "5") and got["y"] == (12.5, None) and got["p"] == (None, None) and got["q"] == (2.0, None)
    assert sorted(r.value for r in files.crawl_rejects(spark, str(tmp_path)).collect()) == ["[broken", "{bad"]


def test_dimensions(spark, tmp_path):
    gaz = {"Hà Nội": {"prefix": "Thành phố", "Ba Đình": {"prefix": "Quận", "Cống Vị": {"prefix": "Phường"}}, "Tây Hồ": {"prefix": "Quận"}}}
    (tmp_path / "g.json").write_text(json.dumps(gaz, ensure_ascii=False))
    rows = files.read_gazetteer(spark, str(tmp_path / "g.json")).orderBy("ord").collect()
    assert [(r.level, r.district, r.ward, r.prefix) for r in rows] == [
        (1, None, None, "Thành phố"), (2, "Ba Đình", None, "Quận"), (3, "Ba Đình", "Cống Vị", "Phường"), (2, "Tây Hồ", None, "Quận"),
    ]
    (tmp_path / "s.json").write_text(json.dumps([{"slug": "ha-noi", "name": "Hà Nội"}, {"slug": None, "name": "x"}]))
    assert [r.slug for r in files.read_slugs(spark, str(tmp_path / "s.json")).collect()] == ["ha-noi"]
    (tmp_path / "c.json").write_text(json.dumps({"P": {"A": [1.5, 2.5], "B": None}}))
    got = {r.district: (r.lat, r.lon) for r in files.read_coordinates(spark, str(tmp_path / "c.json")).collect()}
    assert got == {"A": (1.5, 2.5), "B": (None, None)}
    assert files.read_coordinates(spark, str(tmp_path / "none.json")).count() == 0
    assert files.from_rows(spark, [("a", 1)], "k string, v int").schema["v"].dataType.simpleString() == "int"


def message(i, topic="nhamatpho", price="100"):
    return json.dumps({"title": f"Nhà {i}", "link": f"l{i}", "post_id": str(i), "price": price, "square": 10.0,
                       "estate_type": "Nhà mặt phố", "extra_infos": {"Số Tầng": "2"}}), topic


def write_messages(spark, folder, rows):
    numbered = [(*row, k) for k, row in enumerate(rows)]
    spark.createDataFrame(numbered, "value string, topic string, offset long").withColumn(
        "timestamp", F.lit("2024-01-01 00:00:00").cast("timestamp")
    ).write.mode("append").parquet(folder)


def test_publish_stream_upserts_and_restarts(spark):
    source, served, lake, checkpoint = (fresh_dir(spark, n) for n in ("in", "served", "lake", "ckpt"))
    moments = iter(["2024-01-01 00:00:00", "2024-01-02 00:00:00"])

    def run():
        moment = F.lit(next(moments)).cast("timestamp")
        stream = messages.decode_messages(
            messages.file_stream(spark, source, "value string, topic string, offset long, timestamp timestamp", "parquet"),
            LISTING_MESSAGE,
        )
        flows.publish_stream(stream, lambda b: jobs.stream_clean(b, moment), served, lake, checkpoint, moment, once=True).awaitTermination()

    write_messages(spark, source, [message(1), message(2), message(2, price="200"), message(3, "unknown"), ("broken", "bietthu")])
    run()
    write_messages(spark, source, [message(1, price="500")])
    run()
    rows = {r.id: r.price for r in tables.read_latest(spark, served).where("id is not null").collect()}
    assert rows["1"] == 500.0 and rows["2"] == 200.0 and "3" not in rows
    assert spark.read.parquet(lake).count() == 6
    compacted = tables.compact(spark, served)
    assert spark.read.parquet(compacted).where("id is not null").count() == 2


def test_debug_stream(spark):
    source = fresh_dir(spark, "dbg")
    write_messages(spark, source, [message(1)])
    stream = messages.file_stream(spark, source, "value string, topic string, timestamp timestamp", "parquet")
    flows.debug_stream(stream.select("topic"), "memory", "dbg", once=True).awaitTermination()
    assert [r.topic for r in spark.table("dbg").collect()] == ["nhamatpho"]


def test_messages_keep_nulls(spark):
    df = spark.createDataFrame([("t", "1", None)], "topic string, id string, v string")
    assert messages.as_messages(df, key="id").first().value == '{"id":"1","v":null}'
    assert df.select(encode("v").alias("x")).first().x == '{"v":null}'


def test_size_checks(spark):
    df = spark.range(10)
    joined = spark.range(5).join(small(df, 10), "id")
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
    assert small(df, 9) is df and balanced(df).count() == 10


def test_a_batch_repeated_on_another_day_replaces_its_folder(spark):
    lake = fresh_dir(spark, "lake")
    rows = spark.range(40).selectExpr("id", "concat('t', id % 3) as topic")
    for day in ("2024-01-01", "2024-01-02"):
        dated = with_ingest_date(rows, F.lit(day).cast("timestamp"))
        tables.write_batch(dated, lake, 0, "topic", "year", "month", "day")
    assert sorted((r.day, r["count"]) for r in spark.read.parquet(lake).groupBy("day").count().collect()) == [(2, 40)]


def test_written_input_has_more_files_where_there_are_more_rows(spark, tmp_path):
    from listmill.checks import streams

    spark.range(120_001).write.parquet(str(tmp_path / "orders.parquet"))
    assert streams._files(spark, str(tmp_path), 1) == 3 and streams._files(spark, str(tmp_path), 8) == 8


def test_upserts_are_written_by_many_tasks(spark, monkeypatch):
    from listmill.checks import streams

    names = "id long, category string, estate_type string, province string, district string, post_date date, price double, price_per_m2 double, square double, ward string"
    rows = [(i, "c", "e", "p", "d", None, 1.0, 1.0, 1.0, ("1-URGENT", "2-HIGH", "x")[i % 3]) for i in range(12)]
    monkeypatch.setattr(streams, "listings", lambda spark, sf: spark.createDataFrame(rows, names).repartition(5))
    parts = streams._upserts(spark, "")
    assert [p.count() for p in parts] == [12, 12, 4]
    assert parts[0].rdd.getNumPartitions() == 5 and parts[1].rdd.getNumPartitions() == 10


def test_many_array_files_are_read_as_few_are(spark, tmp_path, monkeypatch):
    good = '{"post_id": "%s", "title": "t\\u00e9 \\"%s\\" [x], {y}", "price": %s, "square": %s, "address": {"district": "d"}}'
    for k in range(6):
        records = [good % (f"{k}-{j}", j, '"9 m"' if j % 2 else "12.5", "1e3" if j % 3 else "null") for j in range(5)]
        (tmp_path / f"a{k} b%_batch.json").write_text("\n\n [\n " + ",\n\n  ".join(records) + "\n]\n")
    (tmp_path / "odd_batch.json").write_text('[{"post_id": "o1", "price": {"a":1}, "title": "kept"}, {"post_id": "o2", "square": {"a": 1}}]')
    (tmp_path / "plain_batch.json").write_text('[{"post_id": "p1", "address": "no struct", "title": "kept"}, {"post_id": "p2"}]')
    (tmp_path / "empty_batch.json").write_text("[]")
    (tmp_path / "torn_batch.json").write_text('[{"post_id": "x1"}, {"post_id": ')
    (tmp_path / "lines_batch.json").write_text("\n".join(good % (f"l{j}", j, "1", "2") for j in range(4)) + "\n[stray\n{bad\n")

    def answers():
        rows = files.read_crawl(spark, str(tmp_path))
        rejects = files.crawl_rejects(spark, str(tmp_path))
        return sorted(map(repr, rows.collect())), sorted(r.value for r in rejects.collect())

    few = answers()
    monkeypatch.setattr(files, "NAMED_FILES", 3)
    # nothing but the few names is brought to the driver
    assert answers() == few and few[1] == ["[stray", "{bad"]
    assert len(few[0]) == 6 * 5 + 4 + 4
