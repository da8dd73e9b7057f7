"""Text, number, date, map and JSON functions over whole tables."""

from pyspark.sql import functions as F

from listmill import fixed
from listmill.checks.registry import query
from listmill.checks.views import RAW_SQL, case, raw_listings, table
from listmill.functions import extras, fields, jsontext, text
from listmill.operators import market
from listmill.session import balanced

SPACE = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"
SPECIAL = rf"[^\p{{L}}\p{{N}}[:punct:]{SPACE}]"


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def strip_special_sql(column: str) -> str:
    return f"CASE WHEN {column} <> '' THEN regexp_replace({column}, '{SPECIAL}', '', 'g') END"


def collapse_sql(column: str) -> str:
    """One pair of replacements per mark, in ASCII order, as the rule is stated."""
    out = column
    for mark in r"""!"#$%&'()*+,-./:;<=>?@[]^_`{|}~""":
        low = 3 if mark == "." else 1
        pattern = "\\" + mark if mark not in "'\"" else mark
        for p in (f"{pattern}{{{low},}}", f"([{SPACE}]{pattern}){{{low},}}"):
            out = f"regexp_replace({out}, {quoted(p)}, {quoted(mark)}, 'g')"
    return f"CASE WHEN {column} <> '' THEN {out} END"


def strip_sql(column: str) -> str:
    return f"regexp_replace({column}, '^[{SPACE}]+|[{SPACE}]+$', '', 'g')"


def squeeze_sql(column: str) -> str:
    return f"trim(regexp_replace({column}, '[{SPACE}]+', ' ', 'g'))"


def simple_clean_sql(column: str) -> str:
    kept = rf"regexp_replace({column}, '[^\p{{L}}\p{{N}}_{SPACE}.,?!%/\-]', '', 'g')"
    return f"coalesce({squeeze_sql(kept)}, '')"


def label_sql(column: str, table: dict = fixed.LABEL_MAP_BATCH) -> str:
    out = column
    for prefix in fixed.LABEL_PREFIXES:
        inner = strip_sql(f"replace({out}, '{prefix}', '')")
        out = f"(SELECT upper(substr(x, 1, 1)) || lower(substr(x, 2)) FROM (SELECT {inner} AS x))"
    return f"(SELECT CASE WHEN {column} <> '' THEN {case('y', table, 'y')} END FROM (SELECT {out} AS y))"


def extract_number_sql(value: str) -> str:
    return f"TRY_CAST(regexp_replace(replace({value}, ',', '.'), '[^0-9.]', '', 'g') AS DOUBLE)"


def price_text_sql(column: str) -> str:
    tight = f"replace(replace(regexp_replace({column}, ',', '.'), ' /', '/'), '/ ', '/')"
    low = strip_sql(f"lower({tight})")
    return f"(SELECT CASE WHEN contains(x, '{fixed.PRICE_ON_REQUEST}') THEN '{fixed.PRICE_ON_REQUEST}' ELSE x END FROM (SELECT {low} AS x))"


def price_crawl_sql(column: str, square: str) -> str:
    return f"""(SELECT CASE WHEN len(p) = 2 AND regexp_full_match(p[1], '[0-9]+\\.?[0-9]*|\\.[0-9]+') THEN TRY_CAST(p[1] AS DOUBLE) *
  CASE p[2] WHEN 'tỷ' THEN 1e9 WHEN 'triệu' THEN 1e6 WHEN 'tỷ/m2' THEN 1e9 * {square} WHEN 'triệu/m2' THEN 1e6 * {square} END END
  FROM (SELECT string_split({squeeze_sql(price_text_sql(column))}, ' ') AS p))"""


def price_job_sql(column: str, square: str) -> str:
    first = f"TRY_CAST(regexp_extract({strip_sql(column)}, '^[^\\s]*') AS DOUBLE)"
    return f"""coalesce(TRY_CAST({column} AS DOUBLE), CASE WHEN {square} IS NULL THEN NULL
  WHEN regexp_matches({column}, 'triệu\\s*/\\s*m') THEN {first} * 1e6 * {square}
  WHEN regexp_matches({column}, 'tỷ\\s*/\\s*m') THEN {first} * 1e9 END)"""


def area_sql(column: str) -> str:
    return f"""(SELECT CASE WHEN x >= 0 THEN x END FROM
  (SELECT TRY_CAST(regexp_replace({strip_sql(column)}, 'm2|m²|m', '', 'g') AS DOUBLE) AS x))"""


# the extras map of the raw view, as SQL
EXTRAS_SQL = """CASE WHEN n_lines IS NOT NULL THEN MAP([bed_key, floor_key, 'Mặt Tiền', 'Diện Tích Sử Dụng', 'Hướng Nhà'],
  [bed_value, CAST(top_line AS VARCHAR), face_value, use_value, ' Đông-' || o_orderstatus]) END"""


def extra_clean_sql(keys: list[str]) -> str:
    found = "CASE " + " ".join(f"WHEN list_contains(map_keys(m), '{k}') THEN m['{k}']" for k in keys) + " END"
    return rf"regexp_replace(translate({found}, ',²', '.2'), '[^\p{{L}}\p{{N}}. ]', '', 'g')"


def extras_struct_sql() -> dict[str, str]:
    out = {}
    for name, keys in fixed.EXTRA_KEYS.items():
        value = extra_clean_sql(keys)
        if name in ("no_bedrooms", "no_bathrooms", "no_floors", "yo_construction"):
            # whole numbers only, as text
            value = f"(SELECT CASE WHEN regexp_full_match(trim(v), '[+-]?[0-9]+') THEN CAST(trim(v) AS INTEGER) END FROM (SELECT {value} AS v))"
        elif name in ("front_road", "front_face"):
            value = f"TRY_CAST(replace({value}, 'm', '') AS DOUBLE)"
        elif name == "ultilization_square":
            value = f"TRY_CAST(replace({value}, 'm2', '') AS DOUBLE)"
        out[name] = value
    return out


def extras_word_sql() -> dict[str, str]:
    out = {}
    for name, words in fixed.EXTRA_WORDS.items():
        test = " OR ".join(f"contains(lower(e.key), '{w.lower()}')" for w in words)
        value = f"list_filter(map_entries(m), lambda e: {test})[1].value"
        if name in ("no_bedrooms", "no_bathrooms", "no_floors", "yo_construction"):
            value = f"TRY_CAST(trunc({extract_number_sql(value)}) AS INTEGER)"
        elif name in ("direction", "legal"):
            value = strip_sql(value)
        else:
            value = extract_number_sql(value)
        out[name] = value
    return out


def columns(parts: dict[str, str]) -> str:
    return ", ".join(f"{v} AS {k}" for k, v in parts.items())


# ---------------------------------------------------------------- text


@query(f"""WITH {RAW_SQL}
SELECT DISTINCT unnest(regexp_extract_all(concat_ws(' ', title, description), '{SPECIAL}')) AS ch FROM raw""")
def special_characters(spark, sf):
    return market.special_characters(raw_listings(spark, sf), "title", "description")


@query(f"""WITH {RAW_SQL} SELECT k, {strip_special_sql('title')} AS title, {strip_special_sql('description')} AS description FROM raw""")
def strip_special(spark, sf):
    return raw_listings(spark, sf).select(
        "k", text.strip_special(F.col("title")).alias("title"), text.strip_special(F.col("description")).alias("description")
    )


@query(f"WITH {RAW_SQL} SELECT k, CASE WHEN title <> '' THEN translate(title, '→★€✓', '') END AS title FROM raw")
def strip_fixed_characters(spark, sf):
    """The streaming form, with a given character set."""
    return raw_listings(spark, sf).select("k", text.strip_chars(F.col("title"), "→★€✓").alias("title"))


@query(f"SELECT page_id, md5(t) AS digest, length(t) AS n FROM (SELECT page_id, {collapse_sql('html')} AS t FROM pages)")
def collapse_punctuation(spark, sf):
    t = text.collapse_punctuation(F.col("html"))
    return table(spark, sf, "pages").select("page_id", t.alias("t")).select(
        "page_id", F.md5("t").alias("digest"), F.length("t").alias("n")
    )


@query(f"""SELECT doc_id, md5(t) AS digest, length(t) AS n, label FROM
(SELECT doc_id, {simple_clean_sql('text')} AS t, coalesce({strip_sql("' ' || source || ' '")}, 'Khác') AS label FROM documents)""")
def simple_clean(spark, sf):
    docs = table(spark, sf, "documents").select(
        "doc_id", text.simple_clean(F.col("text")).alias("t"),
        text.trimmed_label(F.concat(F.lit(" "), "source", F.lit(" "))).alias("label"),
    )
    return docs.select("doc_id", F.md5("t").alias("digest"), F.length("t").alias("n"), "label")


@query(f"""WITH {RAW_SQL} SELECT k, {label_sql('estate_type')} AS label,
{label_sql('estate_type', fixed.LABEL_MAP_STREAM)} AS stream_label FROM raw""")
def category_label(spark, sf):
    label = F.col("estate_type")
    return raw_listings(spark, sf).select(
        "k", text.category_label(label).alias("label"),
        text.category_label(label, fixed.LABEL_MAP_STREAM).alias("stream_label"),
    )


@query(f"""SELECT c_custkey, {case('c_nationkey', fixed.SITE_A_CODES)} AS site_a, {case('c_nationkey', fixed.SITE_B_CODES)} AS site_b
FROM customer""")
def category_code_label(spark, sf):
    from listmill.operators.routing import with_label

    codes = [(k, fixed.SITE_A_CODES.get(k), v) for k, v in fixed.SITE_B_CODES.items()]
    labels = spark.createDataFrame(codes, "c_nationkey int, site_a string, site_b string")
    people = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return with_label(people, labels, "c_nationkey").drop("c_nationkey")


_EMOJI = r"[\x{1F1E6}-\x{1F1FF}\x{1F300}-\x{1FAFF}\x{2600}-\x{27BF}\x{2B50}\x{2B55}][\x{FE0F}\x{200D}\x{1F3FB}-\x{1F3FF}]*"


@query(f"""SELECT doc_id, md5(t) AS digest, length(t) AS n FROM (SELECT doc_id, nfc_normalize(regexp_replace(
replace(text, 'é', 'e' || chr(769)) || '🏠️ ✓ cũ', '{_EMOJI}', '', 'g')) AS t FROM documents)""")
def unicode_normalise(spark, sf):
    raw = F.concat(F.replace("text", F.lit("é"), F.lit("é")), F.lit("🏠️ ✓ cũ"))
    docs = table(spark, sf, "documents").select("doc_id", text.normalise_text(raw).alias("t"))
    return docs.select("doc_id", F.md5("t").alias("digest"), F.length("t").alias("n"))


# Syllables as they are typed, in the old and in the new spelling.
_SYLLABLES = [
    ("baỏ", "bảo", "bảo"), ("lựơng", "lượng", "lượng"), ("nghịêm", "nghiệm", "nghiệm"), ("hoá", "hóa", "hoá"), ("hòa", "hòa", "hoà"),
    ("thuỷ", "thủy", "thuỷ"), ("KHOẺ", "KHỎE", "KHOẺ"), ("qúy", "quý", "quý"), ("gía", "giá", "giá"), ("tòan", "toàn", "toàn"),
    ("cuả", "của", "của"), ("miá", "mía", "mía"), ("hòai", "hoài", "hoài"), ("khủyu", "khuỷu", "khuỷu"), ("qủa", "quả", "quả"),
    ("gíêng", "giếng", "giếng"), ("gìn", "gìn", "gìn"), ("thưở", "thưở", "thưở"), ("cưủ", "cửu", "cửu"), ("Đừơng", "Đường", "Đường"),
    ("nhà", "nhà", "nhà"), ("ăn", "ăn", "ăn"), ("mưà", "mừa", "mừa"), ("húênh", "huếnh", "huếnh"), ("tuýêt", "tuyết", "tuyết"),
]


def _syllables_sql(form: int) -> str:
    return "[" + ", ".join(f"'{s[form]}'" for s in _SYLLABLES) + f"][p_partkey % {len(_SYLLABLES)} + 1]"


@query(f"""SELECT p_partkey, p_name || ' ' || {_syllables_sql(1)} || ', ' || {_syllables_sql(1)} || '. ' || p_type AS old_spelling,
p_name || ' ' || {_syllables_sql(2)} || ', ' || {_syllables_sql(2)} || '. ' || p_type AS new_spelling FROM part""")
def tone_marks(spark, sf):
    """Part names with mistyped syllables between their words."""
    typed = F.get(F.array(*[F.lit(s[0]) for s in _SYLLABLES]), (F.col("p_partkey") % len(_SYLLABLES)).cast("int"))
    whole = F.concat("p_name", F.lit(" "), typed, F.lit(", "), typed, F.lit(". "), "p_type")
    rows = balanced(table(spark, sf, "part")).select("p_partkey", whole.alias("t"))
    return rows.select("p_partkey", text.tone_marks(F.col("t")).alias("old_spelling"), text.tone_marks(F.col("t"), True).alias("new_spelling"))


@query(r"""SELECT doc_id, w AS word, regexp_matches(w, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$') AS valid
FROM (SELECT doc_id, unnest(regexp_split_to_array(text, '\s+')) AS w FROM documents) WHERE contains(w, '@')""")
def email_valid(spark, sf):
    words = table(spark, sf, "documents").select("doc_id", F.explode(F.split("text", r"\s+")).alias("word"))
    return words.where(F.contains("word", F.lit("@"))).withColumn("valid", text.is_email(F.col("word")))


@query("""SELECT doc_id, CASE WHEN length(text) > 4000 THEN length(text[:4000] || m) ELSE length(text) END AS n,
md5(CASE WHEN length(text) > 4000 THEN text[:4000] || m ELSE text END) AS digest FROM documents,
(SELECT chr(10) || '...[Nội dung quá dài đã được cắt bớt để lưu vào bộ nhớ]...' AS m)""")
def truncate_text(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", text.truncate(F.col("text")).alias("t"))
    return docs.select("doc_id", F.length("t").alias("n"), F.md5("t").alias("digest"))


_MARKED = "replace(replace(text, '. ', '.' || chr(10) || '  * '), ', ', ', **') "


@query(rf"""SELECT doc_id, md5(t) AS digest, md5(translate(t, '"''', '')) AS bare FROM (SELECT doc_id,
regexp_replace(replace({_MARKED}, '**', ''), '(^|\n)\s*\*\s+', '\1- ', 'g') AS t FROM documents)""")
def markdown_clean(spark, sf):
    marked = F.replace(F.replace("text", F.lit(". "), F.lit(".\n  * ")), F.lit(", "), F.lit(", **"))
    docs = table(spark, sf, "documents").select("doc_id", text.clean_markdown(marked).alias("t"))
    return docs.select("doc_id", F.md5("t").alias("digest"), F.md5(text.strip_quotes(F.col("t"))).alias("bare"))


@query("""SELECT p_partkey, concat_ws(' ', p_name, p_type, nullif(p_brand, 'Brand#2')) AS text FROM part""")
def search_text(spark, sf):
    brand = F.nullif(F.col("p_brand"), F.lit("Brand#2"))
    return table(spark, sf, "part").select("p_partkey", text.search_text(F.col("p_name"), F.col("p_type"), brand).alias("text"))


@query("""SELECT s_suppkey, s_name || ', ' || n_name || ', ' || r_name AS address FROM supplier
JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def breadcrumb_address(spark, sf):
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    rows = table(spark, sf, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    crumbs = F.array(F.lit("Home"), F.concat(F.lit(" "), "r_name"), F.concat("n_name", F.lit("\n")), F.col("s_name"))
    return rows.select("s_suppkey", text.breadcrumb_address(crumbs).alias("address"))


# ---------------------------------------------------------------- numbers and dates


@query(f"""WITH {RAW_SQL} SELECT k, {price_text_sql('price')} AS price_text,
round({price_crawl_sql('price', 'square')}, 2) AS price FROM raw""")
def parse_price_crawl(spark, sf):
    price, square = F.col("price"), F.col("square")
    return raw_listings(spark, sf).select(
        "k", fields.price_text(price).alias("price_text"),
        F.round(fields.parse_price_crawl(price, square), 2).alias("price"),
    )


@query(f"""WITH {RAW_SQL}, p AS (SELECT k, square, {price_job_sql('price', 'square')} AS price FROM raw)
SELECT k, round(price, 2) AS price, round(price / NULLIF(square, 0), 4) AS price_per_m2 FROM p""")
def parse_price_job(spark, sf):
    rows = raw_listings(spark, sf)
    rows = rows.withColumn("price", fields.parse_price_job(F.col("price"), F.col("square")))
    ratio = fields.unit_price(F.col("price"), F.col("square"))
    return rows.select("k", F.round("price", 2).alias("price"), F.round(ratio, 4).alias("price_per_m2"))


@query(f"WITH {RAW_SQL} SELECT k, {area_sql('square_text')} AS area FROM raw")
def parse_area(spark, sf):
    return raw_listings(spark, sf).select("k", fields.parse_area(F.col("square_text")).alias("area"))


@query(f"WITH {RAW_SQL} SELECT k, {extract_number_sql('price')} AS number, {extract_number_sql('face_value')} AS face FROM raw")
def extract_number(spark, sf):
    face = F.col("extra_infos")["Mặt Tiền"]
    return raw_listings(spark, sf).select(
        "k", fields.extract_number(F.col("price")).alias("number"), fields.extract_number(face).alias("face")
    )


@query(f"""WITH {RAW_SQL} SELECT k, price AS as_string, price <> '' AS as_boolean,
CASE WHEN regexp_full_match(price, '[0-9]+') THEN TRY_CAST(price AS INTEGER) END AS as_int,
TRY_CAST(price AS DOUBLE) AS as_double FROM raw""")
def safe_casts(spark, sf):
    return raw_listings(spark, sf).select("k", fields.safe_casts(F.col("price")).alias("c")).select("k", "c.*")


@query(f"""WITH {RAW_SQL} SELECT k, posted AS day, post_date || ' - 10:00' AS stamp, posted AS day_of_stamp FROM raw""")
def parse_post_date(spark, sf):
    stamp = F.concat("post_date", F.lit(" - 10:00"))
    return raw_listings(spark, sf).select(
        "k", fields.parse_post_date(F.col("post_date")).alias("day"), stamp.alias("stamp"),
        fields.parse_post_date(fields.date_part_of_stamp(stamp)).alias("day_of_stamp"),
    )


@query(f"WITH {RAW_SQL} SELECT k, '09' || k || '12' || k || ',09' || k AS phones FROM raw")
def phone_cleanup(spark, sf):
    phones = text.clean_phones(F.col("contact_info.phone"))
    return raw_listings(spark, sf).select("k", F.array_join(phones, ",").alias("phones"))


# ---------------------------------------------------------------- maps


@query("""SELECT p_partkey, p_type AS kind, CAST(p_size AS VARCHAR) AS area, 2 AS n FROM part""")
def split_pairs_to_map(spark, sf):
    lines = F.array(
        F.concat(F.lit("  Loại \n nhà : "), "p_type", F.lit("  ")), F.lit("no colon"), F.lit("a:b:c"),
        F.concat(F.lit("Diện Tích:"), F.col("p_size").cast("string")),
    )
    pairs = extras.pairs_to_map(F.transform(lines, text.label_value))
    return table(spark, sf, "part").select("p_partkey", pairs.alias("m")).select(
        "p_partkey", F.col("m")["Loại nhà"].alias("kind"), F.col("m")["Diện Tích"].alias("area"), F.size("m").alias("n")
    )


@query(f"""WITH {RAW_SQL}, x AS (SELECT k, {EXTRAS_SQL} AS m FROM raw JOIN orders ON k = o_orderkey)
SELECT k, {columns(extras_struct_sql())} FROM x""")
def extras_struct(spark, sf):
    rows = raw_listings(spark, sf).select("k", extras.extras_struct(F.col("extra_infos")).alias("extra_infos"))
    return extras.flatten(rows)


@query(f"""WITH {RAW_SQL}, x AS (SELECT k, {EXTRAS_SQL} AS m FROM raw JOIN orders ON k = o_orderkey)
SELECT k, {columns(extras_word_sql())} FROM x""")
def extras_substring(spark, sf):
    rows = raw_listings(spark, sf).select("k", extras.extras_by_word(F.col("extra_infos")).alias("extra_infos"))
    return extras.flatten(rows)


@query(f"""WITH {RAW_SQL} SELECT DISTINCT unnest(map_keys({EXTRAS_SQL})) AS key FROM raw JOIN orders ON k = o_orderkey""")
def extras_keys(spark, sf):
    return extras.extra_keys(raw_listings(spark, sf))


# ---------------------------------------------------------------- JSON


@query("""SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, NULL::BIGINT AS broken FROM events""")
def json_decode(spark, sf):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("k", T.LongType())])
    cut = F.concat(F.lit("{"), "props")
    return table(spark, sf, "events").select(
        "event_id", jsontext.decode(F.col("props"), schema)["k"].alias("k"), jsontext.decode(cut, schema)["k"].alias("broken")
    )


@query("""SELECT event_id, json_object('event_id', event_id, 'event_type', event_type, 'none', NULL)::VARCHAR AS message FROM events""")
def json_encode(spark, sf):
    null = F.lit(None).cast("string").alias("none")
    return table(spark, sf, "events").select("event_id", jsontext.encode("event_id", "event_type", null).alias("message"))


@query(r"""SELECT event_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k, event_type AS name, NULL AS gap FROM events
WHERE event_type <> 'error' UNION ALL SELECT event_id, NULL, NULL, NULL FROM events WHERE event_type = 'error'""")
def json_lenient(spark, sf):
    from pyspark.sql import types as T

    schema = T.StructType(
        [T.StructField("k", T.LongType()), T.StructField("name", T.StringType()), T.StructField("gap", T.StringType())]
    )
    body = F.concat(F.regexp_replace("props", r"\}", ""), F.lit(', "name": "'), "event_type")
    dirty = (
        F.when(F.col("event_type") == "click", F.concat(F.lit("```json\n"), body, F.lit('"}\n```')))
        .when(F.col("event_type") == "view", F.concat(body, F.lit('", "gap": None}')))
        .when(F.col("event_type") == "error", F.concat(F.lit("sorry, "), body))
        .otherwise(body)
    )
    rows = table(spark, sf, "events").select("event_id", jsontext.decode_lenient(dirty, schema).alias("r"))
    return rows.select("event_id", "r.*")
