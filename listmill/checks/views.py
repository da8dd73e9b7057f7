"""Listing-shaped views of the supplied tables, in DataFrame form and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listmill.session import balanced


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balanced(table(spark, sf_dir, "documents"))


CATEGORIES = {
    "AUTOMOBILE": "nhamatpho_index",
    "BUILDING": "nharieng_index",
    "FURNITURE": "chungcu_index",
    "HOUSEHOLD": "bietthu_index",
    "MACHINERY": "dat_index",
}
TOPICS = {"AUTOMOBILE": "nhamatpho", "BUILDING": "nharieng", "FURNITURE": "chungcu", "HOUSEHOLD": "bietthu"}


def case(column: str, values: dict, default: str = "NULL") -> str:
    """SQL CASE over a fixed table."""
    quoted = {k: "'" + str(v).replace("'", "''") + "'" for k, v in values.items()}
    arms = " ".join(
        f"WHEN {k if isinstance(k, int) else repr(k) if chr(39) not in k else k} THEN {v}" for k, v in quoted.items()
    )
    return f"CASE {column} {arms} ELSE {default} END"


# ---------------------------------------------------------------- places

PLACES_SQL = "SELECT r_name AS province, n_name AS district FROM nation JOIN region ON n_regionkey = r_regionkey"

COORDINATES_SQL = """SELECT r_name AS province, n_name AS district,
    CASE WHEN n_nationkey % 7 <> 0 THEN 10 + n_nationkey * 0.4e0 END AS lat,
    CASE WHEN n_nationkey % 7 <> 0 THEN 100 + n_nationkey * 0.3e0 END AS lon
  FROM nation JOIN region ON n_regionkey = r_regionkey"""


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid districts with their province."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("r_name").alias("province"), F.col("n_name").alias("district")
    )


def coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    located = F.col("n_nationkey") % 7 != 0
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("r_name").alias("province"),
        F.col("n_name").alias("district"),
        F.when(located, 10 + F.col("n_nationkey") * 0.4).alias("lat"),
        F.when(located, 100 + F.col("n_nationkey") * 0.3).alias("lon"),
    )


# ---------------------------------------------------------------- served listings

_LINES_SQL = """lines AS (
  SELECT l_orderkey, sum(l_quantity) AS square, CAST(count(*) AS INTEGER) AS n_lines,
         max(l_linenumber) AS top_line, max(l_shipdate) AS last_ship
  FROM lineitem GROUP BY l_orderkey)"""

LISTINGS_SQL = f"""{_LINES_SQL},
listings AS (
  SELECT o_orderkey AS id, CAST(o_orderkey AS VARCHAR) AS post_id,
    'https://listings.example/' || o_orderkey AS link,
    o_orderpriority || ' ' || c_name AS title,
    lower(o_orderpriority || ' ' || c_mktsegment || ' ' || n_name) AS description,
    c_mktsegment || CASE WHEN o_orderstatus = 'F' THEN ' cho thuê' ELSE '' END AS estate_type,
    {case("c_mktsegment", CATEGORIES)} AS category,
    r_name AS province, n_name AS district, o_orderpriority AS ward,
    o_totalprice AS price, square, o_totalprice / square AS price_per_m2,
    n_lines AS no_bedrooms, top_line AS no_bathrooms, CAST(floor(square / 25) AS INTEGER) AS no_floors,
    n_lines / 2e0 AS front_face, top_line * 1.5e0 AS front_road, square AS ultilization_square,
    CAST(o_orderdate AS DATE) AS post_date, strftime(last_ship, '%Y/%m/%d %H:%M:%S') AS created_at
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey LEFT JOIN lines ON o_orderkey = l_orderkey)"""


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with customer, place and the sums of their lines. Small dimensions are broadcast by file size."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("square"),
        F.count(F.lit(1)).cast("int").alias("n_lines"),
        F.max("l_linenumber").alias("top_line"),
        F.max("l_shipdate").alias("last_ship"),
    )
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    people = table(spark, sf_dir, "customer").join(
        nation.join(region, nation.n_regionkey == region.r_regionkey), F.col("c_nationkey") == nation.n_nationkey
    )
    orders = table(spark, sf_dir, "orders")
    return orders.join(people, orders.o_custkey == people.c_custkey).join(
        lines, orders.o_orderkey == lines.l_orderkey, "left"
    )


def segment_map(values: dict):
    return F.create_map(*[F.lit(x) for item in values.items() for x in item])[F.col("c_mktsegment")]


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rent = F.when(F.col("o_orderstatus") == "F", F.lit(" cho thuê")).otherwise(F.lit(""))
    return _orders(spark, sf_dir).select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderkey").cast("string").alias("post_id"),
        F.concat(F.lit("https://listings.example/"), F.col("o_orderkey").cast("string")).alias("link"),
        F.concat_ws(" ", "o_orderpriority", "c_name").alias("title"),
        F.lower(F.concat_ws(" ", "o_orderpriority", "c_mktsegment", "n_name")).alias("description"),
        F.concat("c_mktsegment", rent).alias("estate_type"),
        segment_map(CATEGORIES).alias("category"),
        F.col("r_name").alias("province"),
        F.col("n_name").alias("district"),
        F.col("o_orderpriority").alias("ward"),
        F.col("o_totalprice").alias("price"),
        "square",
        F.try_divide("o_totalprice", "square").alias("price_per_m2"),
        F.col("n_lines").alias("no_bedrooms"),
        F.col("top_line").alias("no_bathrooms"),
        F.floor(F.col("square") / 25).cast("int").alias("no_floors"),
        (F.col("n_lines") / 2.0).alias("front_face"),
        (F.col("top_line") * 1.5).alias("front_road"),
        F.col("square").alias("ultilization_square"),
        F.to_date("o_orderdate").alias("post_date"),
        F.date_format("last_ship", "yyyy/MM/dd HH:mm:ss").alias("created_at"),
    )


# ---------------------------------------------------------------- raw listings

_RAW_LABELS = {
    0: "Mua bán nhà mặt phố", 1: "Căn hộ chung cư", 2: "Kho, xưởng", 3: "Biệt thự, liền kề", 4: " phòng trọ",
}

RAW_SQL = f"""{_LINES_SQL},
raw0 AS (
  SELECT o_orderkey AS k, CAST(CAST(floor(o_totalprice / 10000) AS BIGINT) AS VARCHAR) AS n, *
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey LEFT JOIN lines ON o_orderkey = l_orderkey),
raw AS (
  SELECT k, CASE WHEN k % 5 <> 0 THEN CAST(k AS VARCHAR) END AS post_id,
    'https://listings.example/' || k AS link,
    'Nhà ' || o_orderpriority || CASE WHEN k % 3 = 0 THEN ' → đẹp' ELSE '' END
      || CASE WHEN k % 5 = 0 THEN ' ★!!' ELSE '' END || CASE WHEN k % 4 = 0 THEN ' ,, ,x....' ELSE '' END AS title,
    CASE WHEN k % 11 <> 0 THEN c_name || ' ' || c_mktsegment || CASE WHEN k % 7 = 0 THEN ' € ✓ ~~ $$' ELSE '' END
      || CASE WHEN k % 2 = 0 THEN ' !! giá   tốt ..' ELSE '' END END AS description,
    CASE WHEN k % 13 <> 0 THEN {case("k % 6", _RAW_LABELS, "'Nhà riêng'")} END AS estate_type,
    CASE k % 6 WHEN 0 THEN n || ' tỷ' WHEN 1 THEN n || ' triệu/m2' WHEN 2 THEN 'Thỏa thuận'
      WHEN 3 THEN CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) WHEN 4 THEN n || ',5 Tỷ / m2'
      ELSE 'giá ' || n END AS price,
    square,
    CASE k % 4 WHEN 0 THEN CAST(square AS BIGINT) || ' m2' WHEN 1 THEN CAST(square AS BIGINT) || 'm²'
      WHEN 2 THEN '-' || CAST(square AS BIGINT) ELSE 'rộng' END AS square_text,
    day(o_orderdate) || '/' || month(o_orderdate) || '/' || year(o_orderdate) AS post_date,
    CAST(o_orderdate AS DATE) AS posted, n_lines, top_line,
    CASE k % 4 WHEN 0 THEN 'Số Phòng Ngủ' WHEN 1 THEN 'Số phòng ngủ :' WHEN 2 THEN 'Tổng phòng ngủ' ELSE 'Khác' END AS bed_key,
    CASE k % 3 WHEN 0 THEN 'Số Tầng' WHEN 1 THEN 'Tầng :' ELSE 'WC riêng' END AS floor_key,
    CASE WHEN k % 5 = 0 THEN n_lines || ' phòng' ELSE CAST(n_lines AS VARCHAR) END AS bed_value,
    top_line || ',5m' AS face_value, CAST(square AS BIGINT) || ' m²' AS use_value,
    c_name AS contact, '09' || k || '.12.' || k AS phone_text,
    CASE k % 4 WHEN 0 THEN 'Phường ' || c_mktsegment || ', Quận ' || n_name || ', Tỉnh ' || r_name
      WHEN 1 THEN c_mktsegment || ', ' || n_name || ', ' || r_name
      WHEN 2 THEN 'số ' || k || ' ' || lower(n_name) ELSE c_mktsegment || ' ' || r_name END AS full_address,
    r_name, n_name, c_mktsegment, {case("c_mktsegment", TOPICS, "'other'")} AS topic, last_ship
  FROM raw0)"""


def raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message-shaped listings with dirty text, plus ``k`` (arrival number), ``square_text`` and ``posted``."""
    k = F.col("k")
    n = F.floor(F.col("o_totalprice") / 10000).cast("long").cast("string")
    whole = F.col("square").cast("long").cast("string")

    def when(step: int, value: str):
        return F.when(k % step == 0, F.lit(value)).otherwise(F.lit(""))

    def pick(step: int, values: list, default):
        out = F.when(k % step == 0, values[0])
        for i, v in enumerate(values[1:], 1):
            out = out.when(k % step == i, v)
        return out.otherwise(default)

    label = pick(6, [F.lit(v) for v in _RAW_LABELS.values()], F.lit("Nhà riêng"))
    price = pick(
        6,
        [
            F.concat(n, F.lit(" tỷ")), F.concat(n, F.lit(" triệu/m2")), F.lit("Thỏa thuận"),
            F.floor("o_totalprice").cast("long").cast("string"), F.concat(n, F.lit(",5 Tỷ / m2")),
        ],
        F.concat(F.lit("giá "), n),
    )
    area = pick(
        4, [F.concat(whole, F.lit(" m2")), F.concat(whole, F.lit("m²")), F.concat(F.lit("-"), whole)], F.lit("rộng")
    )
    beds = F.when(k % 5 == 0, F.concat(F.col("n_lines").cast("string"), F.lit(" phòng"))).otherwise(
        F.col("n_lines").cast("string")
    )
    extras = F.create_map(
        pick(4, [F.lit("Số Phòng Ngủ"), F.lit("Số phòng ngủ :"), F.lit("Tổng phòng ngủ")], F.lit("Khác")), beds,
        pick(3, [F.lit("Số Tầng"), F.lit("Tầng :")], F.lit("WC riêng")), F.col("top_line").cast("string"),
        F.lit("Mặt Tiền"), F.concat(F.col("top_line").cast("string"), F.lit(",5m")),
        F.lit("Diện Tích Sử Dụng"), F.concat(whole, F.lit(" m²")),
        F.lit("Hướng Nhà"), F.concat(F.lit(" Đông-"), F.col("o_orderstatus")),
    )
    address = pick(
        4,
        [
            F.concat(F.lit("Phường "), "c_mktsegment", F.lit(", Quận "), "n_name", F.lit(", Tỉnh "), "r_name"),
            F.concat_ws(", ", "c_mktsegment", "n_name", "r_name"),
            F.concat(F.lit("số "), k.cast("string"), F.lit(" "), F.lower("n_name")),
        ],
        F.concat_ws(" ", "c_mktsegment", "r_name"),
    )
    null = F.lit(None).cast("string")
    digits = k.cast("string")
    day = F.col("o_orderdate")
    base = _orders(spark, sf_dir).withColumn("k", F.col("o_orderkey"))
    return base.select(
        "k",
        F.struct(
            null.alias("district"), address.alias("full_address"), null.alias("province"), null.alias("ward")
        ).alias("address"),
        F.struct(
            F.col("c_name").alias("name"),
            F.array(
                F.concat(F.lit("tel:09"), digits, F.lit(".12."), digits), F.concat(F.lit("09"), digits)
            ).alias("phone"),
        ).alias("contact_info"),
        F.when(
            k % 11 != 0,
            F.concat("c_name", F.lit(" "), "c_mktsegment", when(7, " € ✓ ~~ $$"), when(2, " !! giá   tốt ..")),
        ).alias("description"),
        F.when(k % 13 != 0, label).alias("estate_type"),
        F.when(F.col("n_lines").isNotNull(), extras).alias("extra_infos"),
        F.concat(F.lit("https://listings.example/"), digits).alias("link"),
        F.concat_ws("/", F.dayofmonth(day), F.month(day), F.year(day)).alias("post_date"),
        F.when(k % 5 != 0, digits).alias("post_id"),
        price.alias("price"),
        "square",
        area.alias("square_text"),
        F.concat(
            F.lit("Nhà "), "o_orderpriority", when(3, " → đẹp"), when(5, " ★!!"), when(4, " ,, ,x....")
        ).alias("title"),
        segment_map(TOPICS).alias("_topic"),
        F.to_date(day).alias("posted"),
        "last_ship", "r_name", "n_name", "c_mktsegment", "n_lines", "top_line", "o_orderstatus",
    ).withColumn("topic", F.coalesce("_topic", F.lit("other"))).drop("_topic")


RAW_SHAPE = ["r_name", "n_name", "c_mktsegment", "n_lines", "top_line", "o_orderstatus", "posted", "last_ship"]
