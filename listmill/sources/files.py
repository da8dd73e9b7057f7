"""File sources: the lake, crawl files and the dimensions kept as JSON."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listmill.schema import LISTING_MESSAGE
from listmill.session import settle, small


def read_lake(spark: SparkSession, path: str, topics: list[str] | None = None) -> DataFrame:
    """The raw lake; asking for topics reads their partitions only."""
    lake = spark.read.parquet(path)
    return lake if topics is None else lake.where(F.col("topic").isin(topics))


def _as_text(schema: T.StructType) -> T.StructType:
    """The schema with its top numbers as text, so that a mistyped field does not spoil its record."""
    plain = lambda t: t if isinstance(t, (T.StructType, T.ArrayType, T.MapType)) else T.StringType()
    return T.StructType([T.StructField(f.name, plain(f.dataType)) for f in schema.fields])


def _typed_as(schema: T.StructType) -> list[Column]:
    return [F.col(f.name) if f.dataType == T.StringType() else F.col(f.name).try_cast(f.dataType).alias(f.name)
            if not isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)) else F.col(f.name) for f in schema.fields]


# So many files that hold an array are named one by one; the lines of more are gathered by file in tasks.
NAMED_FILES = 1_000


def _crawl_lines(spark: SparkSession, root: str, glob: str) -> tuple[DataFrame, DataFrame]:
    """All lines with their file and place, and the files whose first line that is not blank opens an array."""
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    lines = reader.text(root).select(
        "value", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("start")
    )
    filled = lines.where(F.trim("value") != "").withColumn("line", F.monotonically_increasing_id())
    # lines of one split are numbered in order, and the first line is in the first split
    first = filled.groupBy("file_path").agg(F.min_by(F.substring(F.ltrim("value"), 1, 1), F.struct("start", "line")).alias("sign"))
    return filled, settle(first.where(F.col("sign") == "[").select("file_path"))


def _without(lines: DataFrame, arrays: DataFrame) -> DataFrame:
    """The lines of the other files."""
    return lines.join(small(arrays, NAMED_FILES), "file_path", "left_anti")


def _array_records(spark: SparkSession, lines: DataFrame, arrays: DataFrame, schema: T.StructType) -> DataFrame:
    """The records (r) of files that hold an array, with their file. Gathered ones write a number in a text's place as lines do: 12.5 for 12.50."""
    named = [r["file_path"] for r in arrays.limit(NAMED_FILES + 1).collect()]
    if not named:
        return spark.createDataFrame([], T.StructType([T.StructField("r", schema), T.StructField("file_path", T.StringType())]))
    if len(named) <= NAMED_FILES:
        # few files may be long: each is parsed as it is read
        whole = spark.read.option("multiLine", "true").schema(schema).json([unquote(p) for p in named])
        return whole.select(F.struct(*schema.names).alias("r"), F.col("_metadata.file_path").alias("file_path"))
    held = lines.join(arrays, "file_path", "left_semi").groupBy("file_path").agg(F.array_sort(F.collect_list(F.struct("start", "line", "value"))).alias("l"))
    return held.select(F.explode(F.from_json(F.array_join("l.value", "\n"), T.ArrayType(schema))).alias("r"), "file_path")


def read_crawl(
    spark: SparkSession, root: str, glob: str = "*batch.json*", schema: T.StructType = LISTING_MESSAGE
) -> DataFrame:
    """Crawl files below ``root``, JSON lines or one JSON array per file, with ``file_path`` and ``file_name``.

    The first character of a file tells its form. Lines are read as text, which splits and never fails; only files that hold an
    array are read as a whole. The driver lists the files of the folder, as for any scan, and names no more than NAMED_FILES. A field of a wrong type is null and its record stays. Lines that hold no record are
    left to :func:`crawl_rejects`, unreadable arrays give no rows.
    """
    lines, arrays = _crawl_lines(spark, root, glob)
    lenient = _as_text(schema)
    parsed = _without(lines, arrays).where(F.col("value").rlike(r"^\s*\{"))
    parsed = parsed.select(F.from_json("value", lenient).alias("r"), "file_path").unionByName(_array_records(spark, lines, arrays, lenient))
    rows = parsed.where(_filled("r", lenient)).select("r.*", "file_path").select(*_typed_as(schema), "file_path")
    return rows.withColumn("file_name", F.element_at(F.split("file_path", "/"), -1))


def _filled(record: str, schema: T.StructType) -> Column:
    """Whether any field of a record could be read."""
    return F.coalesce(*[F.when(F.col(f"{record}.{c}").isNotNull(), True) for c in schema.names], F.lit(False))


def crawl_rejects(
    spark: SparkSession, root: str, glob: str = "*batch.json*", schema: T.StructType = LISTING_MESSAGE
) -> DataFrame:
    """The lines of line files that hold no readable record, with their file."""
    lines, arrays = _crawl_lines(spark, root, glob)
    lenient = _as_text(schema)
    record = F.when(F.col("value").rlike(r"^\s*\{"), F.from_json("value", lenient))
    parsed = _without(lines, arrays).withColumn("r", record)
    return parsed.where(F.col("r").isNull() | ~_filled("r", lenient)).select("value", "file_path")


def read_gazetteer(spark: SparkSession, path: str) -> DataFrame:
    """Nested ``{province: {prefix, district: {prefix, ward: {prefix}}}}`` as
    ``(level, province, district, ward, prefix, ord)`` in file order."""
    text = spark.read.text(path, wholetext=True)
    raw = "map<string,string>"
    provinces = text.select(F.posexplode(F.from_json("value", raw)).alias("i", "province", "body"))
    provinces = provinces.withColumn("m", F.from_json("body", raw))
    districts = provinces.select("i", "province", F.posexplode("m").alias("j", "district", "body")).where(
        F.col("district") != "prefix"
    ).withColumn("m", F.from_json("body", raw))
    wards = districts.select("i", "j", "province", "district", F.posexplode("m").alias("k", "ward", "body")).where(
        F.col("ward") != "prefix"
    ).withColumn("m", F.from_json("body", raw))
    null = F.lit(None).cast("string")
    place = lambda i, j, k: (F.col("i").cast("long") * 1_000_000_000 + j * 1_000_000 + k).alias("ord")
    zero = F.lit(0).cast("long")
    return (
        provinces.select(F.lit(1).alias("level"), "province", null.alias("district"), null.alias("ward"),
                         F.col("m")["prefix"].alias("prefix"), place("i", zero, zero))
        .unionByName(districts.select(F.lit(2).alias("level"), "province", "district", null.alias("ward"),
                                      F.col("m")["prefix"].alias("prefix"), place("i", F.col("j") + 1, zero)))
        .unionByName(wards.select(F.lit(3).alias("level"), "province", "district", "ward",
                                  F.col("m")["prefix"].alias("prefix"), place("i", F.col("j") + 1, F.col("k") + 1)))
    )


def read_slugs(spark: SparkSession, path: str) -> DataFrame:
    schema = "slug string, name string"
    return spark.read.schema(schema).option("multiLine", "true").json(path).where(F.col("slug").isNotNull())


def read_coordinates(spark: SparkSession, path: str) -> DataFrame:
    """Nested ``{province: {district: [lat, lon] | null}}``; a missing file gives no rows."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], "province string, district string, lat double, lon double")
    text = spark.read.text(path, wholetext=True)
    body = F.from_json("value", "map<string,map<string,array<double>>>")
    provinces = text.select(F.explode(body).alias("province", "m"))
    return provinces.select("province", F.explode("m").alias("district", "c")).select(
        "province", "district", F.get("c", F.lit(0)).alias("lat"), F.get("c", F.lit(1)).alias("lon")
    )


def from_rows(spark: SparkSession, rows, schema) -> DataFrame:
    """Local rows or a pandas frame under a declared schema."""
    return spark.createDataFrame(rows, schema=schema)
