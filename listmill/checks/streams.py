"""Sources, sinks and streams: everything is written to the shared folder and read back."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from listmill import fixed
from listmill.checks.documents import TOKENS_SQL
from listmill.checks.jobs import EXTRA_NAMES, _SHOWN, clean_sql, shown
from listmill.checks.registry import query
from listmill.checks.views import LISTINGS_SQL, RAW_SQL, case, listings, raw_listings, table
from listmill.functions.jsontext import encode
from listmill.operators import records, routing
from listmill.plans import jobs
from listmill.schema import LISTING_MESSAGE
from listmill.session import balanced, fresh_dir
from listmill.sources import files, messages, tables
from listmill.streaming import aggregates, flows, neardup

MESSAGE_FIELDS = [f.name for f in LISTING_MESSAGE.fields]
_EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def _event_stream(spark, sf):
    """The events file as a topic stream: key, value, topic, timestamp."""
    rows = messages.file_stream(spark, sf, _EVENTS, "parquet", pathGlobFilter="events.parquet")
    return rows.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        encode("event_id", "user_id", "event_type", "value").cast("binary").alias("value"),
        F.col("event_type").alias("topic"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


_EVENT_MESSAGE = T.StructType(
    [
        T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()),
    ]
)


@query("""SELECT event_id, user_id, event_type, value, event_type AS topic, CAST(year(ts) AS INTEGER) AS year,
CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day FROM events""")
def stream_to_lake(spark, sf):
    """Topic messages decoded and appended to the partitioned lake, which is then scanned."""
    lake, checkpoint = fresh_dir(spark, "lake"), fresh_dir(spark, "lake-checkpoint")
    decoded = messages.decode_messages(_event_stream(spark, sf), _EVENT_MESSAGE)
    flows.append_lake(decoded, lake, checkpoint, F.col("kafka_timestamp"), once=True).awaitTermination()
    return files.read_lake(spark, lake).drop("kafka_timestamp")


@query("SELECT event_id, event_type AS topic FROM events WHERE event_type IN ('click', 'error')")
def lake_topics(spark, sf):
    """A lake scan that reads two topics' partitions only."""
    lake = fresh_dir(spark, "lake")
    events = table(spark, sf, "events").withColumnRenamed("event_type", "topic")
    records.with_ingest_date(events, F.col("ts")).write.partitionBy("topic", "year", "month", "day").parquet(lake)
    return files.read_lake(spark, lake, ["click", "error"]).select("event_id", "topic")


@query("""SELECT CAST(user_id AS VARCHAR) AS key, count(*) AS n, count(DISTINCT event_id) AS ids FROM events GROUP BY 1""")
def stream_raw_copy(spark, sf):
    out, checkpoint = fresh_dir(spark, "copy"), fresh_dir(spark, "copy-checkpoint")
    copy = messages.raw_copy(_event_stream(spark, sf))
    query_ = (
        copy.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query_.awaitTermination()
    rows = spark.read.schema("key string, value string").parquet(out)
    event = F.get_json_object("value", "$.event_id")
    return rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.countDistinct(event).alias("ids"))


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(spark, sf):
    """One event per user and kind; the delay spans the whole month, so one of each is left."""
    out, checkpoint = fresh_dir(spark, "dedup"), fresh_dir(spark, "dedup-checkpoint")
    rows = messages.decode_messages(_event_stream(spark, sf), _EVENT_MESSAGE)
    unique = flows.suppress_repeats(rows, ["user_id", "event_type"], "kafka_timestamp", "60 days")
    query_ = (
        unique.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query_.awaitTermination()
    return spark.read.schema(unique.schema).parquet(out).select("user_id", "event_type")


# Orders of a file of messages or crawl lines, which one task reads.
_PER_FILE = 50_000


def _files(spark, sf, least):
    return max(least, -(-table(spark, sf, "orders").count() // _PER_FILE))


def _message_files(spark, sf):
    """Raw listings as JSON message files, one row per message."""
    folder = fresh_dir(spark, "messages")
    rows = raw_listings(spark, sf).select(*MESSAGE_FIELDS, "topic", F.col("last_ship").cast("timestamp").alias("timestamp"))
    body = encode(*MESSAGE_FIELDS).alias("value")
    # several files, as a topic has several partitions, and more of them where there are more messages
    rows.select(body, "topic", "timestamp").repartition(_files(spark, sf, 8)).write.parquet(folder)
    return folder


_MESSAGE = "value string, topic string, timestamp timestamp"


@query(f"""WITH {RAW_SQL}, {clean_sql(fixed.LABEL_MAP_STREAM)}
SELECT {_SHOWN}, {case('topic', fixed.TOPIC_TABLES)} AS "table", '2024/01/02 03:04:05' AS created_at FROM ratio WHERE topic <> 'other'""")
def job_stream_publish(spark, sf):
    """Messages to lake and served tables through one stream; the newest version of each id is read back."""
    moment = F.lit("2024-01-02 03:04:05").cast("timestamp")
    stream = messages.decode_messages(messages.file_stream(spark, _message_files(spark, sf), _MESSAGE, "parquet"))
    served, lake = fresh_dir(spark, "served"), fresh_dir(spark, "lake")
    flows.publish_stream(
        stream, lambda batch: jobs.stream_clean(batch, moment), served, lake, fresh_dir(spark, "publish-checkpoint"),
        moment, once=True,
    ).awaitTermination()
    return shown(tables.read_latest(spark, served), "table", "created_at")


@query(f"""WITH {RAW_SQL}, {clean_sql(fixed.LABEL_MAP_STREAM)} SELECT {_SHOWN} FROM ratio""")
def stream_clean_equals_batch(spark, sf):
    """The row-wise cleaning on a stream, against the SQL of the batch form."""
    out, checkpoint = fresh_dir(spark, "cleaned"), fresh_dir(spark, "cleaned-checkpoint")
    stream = messages.decode_messages(messages.file_stream(spark, _message_files(spark, sf), _MESSAGE, "parquet"))
    query_ = (
        jobs.stream_clean(stream).writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query_.awaitTermination()
    return shown(spark.read.parquet(out))


@query(f"""WITH {RAW_SQL} SELECT topic, coalesce(post_id, '') AS post_id, price, title, n_name IS NOT NULL AS has_address FROM raw""")
def publish_json(spark, sf):
    """Rows to JSON messages per topic and back."""
    folder = fresh_dir(spark, "published")
    rows = raw_listings(spark, sf).select(*MESSAGE_FIELDS, "topic")
    messages.as_messages(rows, "topic", "post_id").write.partitionBy("topic").parquet(folder)
    back = spark.read.parquet(folder).withColumn("timestamp", F.lit(None).cast("timestamp"))
    decoded = messages.decode_messages(back)
    return decoded.select(
        "topic", F.coalesce("post_id", F.lit("")).alias("post_id"), "price", "title",
        F.col("address.full_address").isNotNull().alias("has_address"),
    )


@query(f"WITH {LISTINGS_SQL} SELECT id, category, price, CAST(square AS FLOAT) AS square, no_floors, district FROM listings")
def typed_load(spark, sf):
    path = fresh_dir(spark, "typed")
    tables.write_typed(listings(spark, sf), path, ["category"])
    return spark.read.parquet(path).select("id", "category", "price", "square", "no_floors", "district")


@query(f"""WITH {LISTINGS_SQL} SELECT CASE WHEN id % 10 <> 0 THEN 'p' || id END AS post_id, category, price FROM listings""")
def typed_load_keyed(spark, sf):
    """Documents by post_id: of three versions the last is loaded, documents without an id all stay."""
    rows = listings(spark, sf).select(
        F.when(F.col("id") % 10 != 0, F.concat(F.lit("p"), "id")).alias("post_id"), "category", "price"
    ).withColumn("created_at", F.lit("2024/01/03 00:00:00"))
    older = rows.where("post_id IS NOT NULL").withColumn("n", F.explode(F.array(F.lit(1), F.lit(2))))
    older = older.withColumn("created_at", F.concat(F.lit("2024/01/0"), "n", F.lit(" 00:00:00"))).withColumn("price", F.lit(-1.0)).drop("n")
    path = fresh_dir(spark, "typed")
    tables.write_typed(rows.unionByName(older), path, key="post_id")
    return spark.read.parquet(path).select("post_id", "category", "price")


# Both layers write: all listings as a batch, then the priority ones again, later and re-priced.
@query(f"""WITH {LISTINGS_SQL} SELECT id, category AS "table", CASE WHEN ward = '1-URGENT' THEN price * 2 ELSE price END AS price FROM listings""")
def keyed_upsert(spark, sf):
    path = fresh_dir(spark, "upsert")
    rows = listings(spark, sf).select("id", F.col("category").alias("table"), "price", "ward")
    rows = rows.withColumn("created_at", F.lit("2024/01/01 00:00:00"))
    # in each batch older messages of the same stamp stand beside the last one of a key
    older = rows.withColumns({"price": -F.col("price"), "kafka_offset": F.lit(1)})
    rows = rows.withColumn("kafka_offset", F.lit(2))
    tables.append_versions(rows.unionByName(older).repartition(4), path, "id", 0)
    again = rows.where("ward = '1-URGENT'").withColumns(
        {"price": F.col("price") * 2, "created_at": F.lit("2024/01/02 00:00:00")}
    )
    # a first attempt at the second batch, with other tables in it, is replaced as a whole
    tables.append_versions(rows.withColumns({"price": F.lit(0.0), "table": F.lit("wrong")}), path, "id", 1)
    tables.append_versions(again.unionByName(again.withColumns({"price": F.lit(-1.0), "kafka_offset": F.lit(1)})), path, "id", 1)
    return tables.read_latest(spark, path).select("id", "table", "price")


@query(f"""WITH {LISTINGS_SQL} SELECT id, category AS "table", CASE WHEN category = 'dat_index' THEN price * 2 ELSE price END AS price FROM listings""")
def category_overwrite(spark, sf):
    """A second batch write replaces the tables it holds and leaves the others."""
    path = fresh_dir(spark, "overwrite")
    rows = listings(spark, sf).select("id", F.col("category").alias("table"), "price", "created_at")
    tables.write_by_category(rows, path)
    tables.write_by_category(rows.where(F.col("table") == "dat_index").withColumn("price", F.col("price") * 2), path)
    return spark.read.parquet(path).select("id", "table", "price")


@query(f"""WITH {RAW_SQL} SELECT post_id, title, price, topic FROM raw""")
def crawl_roundtrip(spark, sf):
    """Crawl output per province and category as JSON lines, found again by a recursive scan."""
    root = fresh_dir(spark, "crawl")
    rows = raw_listings(spark, sf)
    out = rows.select(*MESSAGE_FIELDS, F.lower("r_name").alias("slug"), F.col("topic").alias("category"))
    tables.write_crawl_files(out, root)
    back = files.read_crawl(spark, root, "*.json")
    topic = F.regexp_extract("file_path", r"category=([^/]*)", 1)
    return back.select("post_id", "title", "price", topic.alias("topic"))


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS post_id, CASE WHEN o_orderkey % 5 <> 0 THEN round(o_totalprice, 2) END AS square,
o_orderkey % 2 = 0 AS in_array FROM orders""")
def crawl_mixed_files(spark, sf):
    """Lines with stray ones between them and indented arrays, some with text in a number's place."""
    root = fresh_dir(spark, "mixed")
    square = F.when(F.col("o_orderkey") % 5 == 0, '"wide"').otherwise(F.round("o_totalprice", 2).cast("decimal(18,2)").cast("string"))
    body = F.format_string('{"post_id": "%s", "square": %s}', F.col("o_orderkey").cast("string"), square)
    rows = table(spark, sf, "orders").select("o_orderkey", body.alias("value"))
    lines = rows.where("o_orderkey % 2 <> 0")
    stray = lines.where("o_orderkey % 7 = 0").select(F.explode(F.array(F.lit("[broken"), F.lit("{no record"), F.lit("  "))).alias("value"))
    # the strays stand behind a record in every file
    held = lines.select("value", F.lit(0).alias("n")).unionByName(stray.withColumn("n", F.lit(1)))
    held.repartition(_files(spark, sf, 3)).sortWithinPartitions("n").select("value").write.text(f"{root}/lines")
    # an array to a file, of as many records as a file of lines has, not a file for every 64 keys
    n = _files(spark, sf, 4)
    arrays = rows.where("o_orderkey % 2 = 0").groupBy(F.pmod(F.xxhash64("o_orderkey"), F.lit(n))).agg(F.array_join(F.collect_list("value"), ",\n  ").alias("v"))
    arrays.select(F.concat(F.lit("\n[\n  "), "v", F.lit("\n]")).alias("value")).repartition(n).write.option("maxRecordsPerFile", "1").text(f"{root}/arrays")
    back = files.read_crawl(spark, root, "*.txt")
    return back.select("post_id", "square", F.col("file_path").contains("/arrays/").alias("in_array"))


# Four parts in order of arrival; a memory of 400 seconds is short enough to lose entries.
_NEAR = {"least": 13, "keep_seconds": 400}
_SIGNATURE_SQL = " || ".join(
    f"list_min(list_transform(w, lambda t: substr(md5('{k // 4}:' || t), {8 * (k % 4) + 1}, 8)))" for k in range(16)
)


@query(rf"""WITH RECURSIVE t AS MATERIALIZED (SELECT doc_id, list_distinct({TOKENS_SQL.format('text')}) AS w FROM documents),
s AS MATERIALIZED (SELECT doc_id, CASE WHEN len(w) > 0 THEN {_SIGNATURE_SQL} END AS sig FROM t),
b AS (SELECT doc_id, sig, unnest(range(0, 8)) AS band FROM s WHERE sig IS NOT NULL),
o AS MATERIALIZED (SELECT *, substr(sig, band * 16 + 1, 16) AS v, row_number() OVER (PARTITION BY band, substr(sig, band * 16 + 1, 16) ORDER BY doc_id) AS i FROM b),
rec AS (SELECT band, v, 0::BIGINT AS i, NULL::BIGINT AS doc_id, false AS dup, []::STRUCT(place BIGINT, sig VARCHAR)[] AS held
  FROM (SELECT DISTINCT band, v FROM o) UNION ALL
  SELECT band, v, i, doc_id, dup, CASE WHEN dup THEN old ELSE list_append(old, {{'place': doc_id, 'sig': sig}}) END FROM (
    SELECT *, len(list_filter(old, lambda h: list_sum(list_transform(range(0, 16), lambda k: (substr(h.sig, k * 8 + 1, 8) = substr(sig, k * 8 + 1, 8))::INTEGER))
      >= {_NEAR['least']})) > 0 AS dup FROM (SELECT o.*, list_filter(held, lambda h: h.place >= o.doc_id - {_NEAR['keep_seconds']}) AS old
        FROM rec JOIN o ON o.band = rec.band AND o.v = rec.v AND o.i = rec.i + 1)))
SELECT d.doc_id, coalesce(NOT bool_or(dup), true) AS kept FROM documents d LEFT JOIN rec ON rec.doc_id = d.doc_id GROUP BY d.doc_id""")
def stream_near_dup(spark, sf):
    """Near copies suppressed on a stream, band by band, against all kept signatures of the last 400 seconds."""
    folder, out, checkpoint = (fresh_dir(spark, name) for name in ("documents", "near", "near-checkpoint"))
    docs = balanced(table(spark, sf, "documents").select("doc_id", "text", F.timestamp_seconds(F.col("doc_id") + 1_700_000_000).alias("moment")))
    last = docs.agg(F.max("doc_id")).first()[0]
    neardup.state_settings(spark)
    for part in range(4):
        # the stream goes on where it was, with the files of the part as one micro-batch
        docs.where(F.expr(f"doc_id * 4 div {last + 1} = {part}")).write.mode("append").parquet(folder)
        stream = messages.file_stream(spark, folder, docs.schema, "parquet")
        decided = neardup.decisions(stream, "doc_id", "text", "moment", "10 seconds", **_NEAR)
        neardup.write_unique(decided, out, checkpoint, once=True).awaitTermination()
    return spark.read.parquet(out).select(F.col("id").cast("long").alias("doc_id"), "kept")


# Averages are shown a little off the middle between two roundings.
# All listings, then the urgent ones dearer beside versions that come too late, then some that have moved to another district.
_UPSERTED_SQL = f"""{LISTINGS_SQL}, last AS (SELECT category AS "table", estate_type, province, CASE WHEN ward = '2-HIGH' THEN 'NATION_1' ELSE district END AS district,
  post_date, CASE WHEN ward = '1-URGENT' THEN price * 2 ELSE price END AS price, price_per_m2, square, CASE WHEN contains(estate_type, 'thuê') THEN 'rent' ELSE 'buy' END AS kind
  FROM listings)"""


def _upserts(spark, sf):
    """The three parts in order of arrival."""
    rows = listings(spark, sf).withColumnRenamed("category", "table").select(
        "id", "table", "estate_type", "province", "district", "post_date", "price", "price_per_m2", "square", "ward"
    )
    stamped = lambda df, day: df.withColumn("created_at", F.lit(f"2024/01/{day} 00:00:00"))
    dearer = rows.where("ward = '1-URGENT'").withColumn("price", F.col("price") * 2)
    late = rows.where("ward <> '1-URGENT'").withColumns({"price": F.lit(1.0), "district": F.lit("NATION_9")})
    moved = rows.where("ward = '2-HIGH'").withColumn("district", F.lit("NATION_1"))
    return [stamped(rows, "02"), stamped(dearer, "03").unionByName(stamped(late, "01")), stamped(moved, "04")]


@query(f"""WITH {_UPSERTED_SQL} SELECT kind, 'district' AS grain, district AS name, round(avg(price) + 1e-7, 3) AS avg_price, round(avg(price_per_m2) + 1e-7, 3) AS avg_unit,
round(avg(square) + 1e-7, 3) AS avg_square FROM last GROUP BY kind, district UNION ALL SELECT kind, 'day', CAST(post_date AS VARCHAR), round(avg(price) + 1e-7, 3),
round(avg(price_per_m2) + 1e-7, 3), round(avg(square) + 1e-7, 3) FROM last GROUP BY kind, post_date""")
def stream_market_cells(spark, sf):
    """District and day averages from the differences that each micro-batch of upserts has left."""
    served, cells, folder, checkpoint = (fresh_dir(spark, name) for name in ("served", "cells", "upserts", "cells-checkpoint"))
    for part in _upserts(spark, sf):
        # the stream goes on where it was, with the files of the part as one micro-batch
        part.write.mode("append").parquet(folder)
        stream = messages.file_stream(spark, folder, part.schema, "parquet")
        aggregates.publish_with_cells(stream, served, cells, checkpoint, once=True).awaitTermination()
    found = aggregates.read_cells(spark, cells)
    shown = [F.round(F.sum(f"sum_{m}") / F.sum(f"n_{m}") + 1e-7, 3).alias(a) for m, a in (("price", "avg_price"), ("price_per_m2", "avg_unit"), ("square", "avg_square"))]
    parts = [
        found.groupBy("kind", F.lit(grain).alias("grain"), F.col(column).cast("string").alias("name")).agg(*shown)
        for grain, column in (("district", "district"), ("day", "post_date"))
    ]
    return parts[0].union(parts[1])
