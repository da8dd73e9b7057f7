"""One row per quirk for the scalar functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listmill import fixed
from listmill.functions import extras, fields, jsontext, predicates, similarity, text
from listmill.operators import routing


def one(spark, make, *values, schema="string"):
    """Apply an expression to one row of columns a, b, ..."""
    names = "abcdef"[: len(values)]
    kinds = [schema] * len(values) if isinstance(schema, str) else schema
    df = spark.createDataFrame([tuple(values)], ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))
    return df.select(make(*[F.col(n) for n in names]).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "given, expected",
    [
        ("a!!!b", "a!b"), ("a , ,b", "a,b"), ("x....", "x."), ("x..", "x.."), ("a $$ b", "a$ b"), ("a\\\\b", "a\\\\b"),
        ("~~ ~", "~~"), ("so !  ok", "so!  ok"), ("", None), (None, None), ("a . . . b", "a. b"), ("--", "-"),
    ],
)
def test_collapse_punctuation(spark, given, expected):
    assert one(spark, text.collapse_punctuation, given) == expected


@pytest.mark.parametrize("given, expected", [("nhà → đẹp★", "nhà  đẹp"), ("", None), (None, None), ("★", ""), ("a_b-ạ²", "a_b-ạ²")])
def test_strip_special(spark, given, expected):
    assert one(spark, text.strip_special, given) == expected


@pytest.mark.parametrize(
    "given, expected",
    [
        ("Mua bán nhà mặt phố", "Nhà mặt tiền"), ("Căn hộ chung cư", "Chung cư"), ("PHÒNG TRỌ", "Phòng trọ, nhà trọ"),
        ("Cho thuê nhà", "Cho thuê nhà"), (None, None), ("", None), ("  kho, xưởng ", "Kho xưởng"),
    ],
)
def test_category_label(spark, given, expected):
    assert one(spark, text.category_label, given) == expected


def test_simple_clean_and_labels(spark):
    assert one(spark, text.simple_clean, " a★  b\n(c) 50% x_y ") == "a b c 50% x_y"
    assert one(spark, text.simple_clean, None) == ""
    assert one(spark, text.trimmed_label, None) == "Khác"
    assert one(spark, text.normalise_text, "é 🏠️!") == "é !"
    assert one(spark, text.strip_place_prefix, "Quận Ba Đình") == "Ba Đình"
    assert one(spark, text.truncate, "x" * 4001) == "x" * 4000 + fixed.TRUNCATE_MARK
    assert one(spark, text.clean_markdown, "**a**\n  * b\n* c") == "a\n- b\n- c"
    assert one(spark, text.strip_quotes, "\"a'b\"") == "ab"
    assert one(spark, text.contains_any_case, "QUẬN Ba Đình", "ba đình", schema="string") is True


@pytest.mark.parametrize("mail, good", [("a.b@c.vn", True), ("a@b", False), ("a b@c.vn", False), ("@c.vn", False)])
def test_email(spark, mail, good):
    assert one(spark, text.is_email, mail) is good


@pytest.mark.parametrize(
    "price, square, expected",
    [
        ("2,5 tỷ", 10.0, 2.5e9), ("3 triệu / m2", 10.0, 3e7), ("1.5 tỷ/m2", 2.0, 3e9), ("Thỏa thuận", 1.0, None),
        ("5000", 1.0, None), ("1.2.3 tỷ", 1.0, None), ("2 tỷ", None, 2e9), ("2 tỷ/m2", None, None), (None, 1.0, None),
    ],
)
def test_price_of_crawl(spark, price, square, expected):
    got = one(spark, fields.parse_price_crawl, price, square, schema=["string", "double"])
    assert got == expected


def test_price_text(spark):
    assert one(spark, fields.price_text, " 2,5 Tỷ / m2, x ") == "2.5 tỷ/m2, x"
    assert one(spark, fields.price_text, "Giá Thỏa Thuận") == "thỏa thuận"


@pytest.mark.parametrize(
    "price, square, expected",
    [
        ("5000", None, 5000.0), ("3 triệu/ m2", 10.0, 3e7), ("2 tỷ / m2", 10.0, 2e9), ("2 tỷ", 10.0, None),
        ("x triệu/m", 1.0, None), ("3 triệu/m", None, None), (None, 1.0, None), ("16777217", 1.0, 16777217.0),
    ],
)
def test_price_of_job(spark, price, square, expected):
    assert one(spark, fields.parse_price_job, price, square, schema=["string", "double"]) == expected


@pytest.mark.parametrize("given, expected", [("50 m2", 50.0), ("50m²", 50.0), ("-3", None), ("0", 0.0), ("x", None), (None, None)])
def test_area(spark, given, expected):
    assert one(spark, fields.parse_area, given) == expected


def test_numbers_and_dates(spark):
    assert one(spark, fields.extract_number, "3-4 tầng") == 34.0
    assert one(spark, fields.extract_number, "1.2.3") is None
    assert one(spark, fields.extract_number, "4,5m") == 4.5
    assert one(spark, fields.unit_price, "10", "0") is None
    assert one(spark, fields.parse_post_date, "3/1/2024") == dt.date(2024, 1, 3)
    assert one(spark, fields.parse_post_date, "31/02/2024") is None
    assert one(spark, fields.date_part_of_stamp, "03/01/2024 - 10:00") == "03/01/2024"
    assert one(spark, fields.dashboard_amount, 2500.0, schema="double") == 2000
    assert one(spark, fields.dashboard_amount, None, schema="double") == 0
    assert one(spark, text.clean_phones, ["tel:09.1", "0.2"], schema="array<string>") == ["091", "02"]


def test_extras(spark):
    m = "map<string,string>"
    got = one(spark, extras.extras_struct, {"Số phòng ngủ :": "3", "Mặt Tiền": "5,5m", "Diện Tích Sử Dụng": "100m²",
                                            "Số Tầng": "2 tầng", "Hướng Nhà": "Đông-Nam"}, schema=m)
    assert (got.no_bedrooms, got.front_face, got.ultilization_square, got.no_floors, got.direction) == (3, 5.5, 100.0, None, "ĐôngNam")
    assert one(spark, extras.extras_struct, None, schema=m) is None
    got = one(spark, extras.extras_by_word, {"Tổng PHÒNG NGỦ": "3 phòng", "WC": "2", "Giấy tờ pháp lý": " sổ đỏ "}, schema=m)
    assert (got.no_bedrooms, got.no_bathrooms, got.legal, got.no_floors) == (3, 2, "sổ đỏ", None)
    pairs = one(spark, lambda lines: extras.pairs_to_map(F.transform(lines, text.label_value)),
                ["a : 1", "b", "a: 2", "x:y:z"], schema="array<string>")
    assert pairs == {"a": "2"}


def test_json(spark):
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    lenient = lambda c: jsontext.decode_lenient(c, schema)
    assert tuple(one(spark, lenient, '```json\n{"a": 1, "b": "x\ny"}\n```')) == (1, "x\ny")
    assert tuple(one(spark, lenient, "{'a': 1, 'b': None}")) == (1, None)
    assert tuple(one(spark, lenient, '{"a": 1, "b": "cut o')) == (1, "cut o")
    assert one(spark, lenient, "no json") is None
    assert tuple(one(spark, lambda c: jsontext.decode(c, schema), "{broken")) == (None, None)


def test_predicates(spark):
    assert one(spark, lambda c: predicates.listing_type(c, "buy"), None) is True
    assert one(spark, lambda c: predicates.listing_type(c, "rent"), "nhà cho thuê") is True
    assert one(spark, lambda c: predicates.listing_type(c, "rent"), "Cho Thuê") is False
    edge = lambda c: predicates.near(c, F.lit(100.0), 0.1)
    assert one(spark, edge, 110.0, schema="double") is True
    assert one(spark, edge, 110.01, schema="double") is False
    day = lambda c: predicates.day_between(c.cast("date"), F.lit("2024-01-05"), F.lit("bad"))
    assert one(spark, day, "2024-01-05") is False
    assert one(spark, lambda a, b: similarity.cosine(a, b), [1.0, 0.0], [1.0, 1.0], schema="array<double>") == pytest.approx(0.7071067)
    assert one(spark, lambda a, b: similarity.cosine(a, b), [0.0], [1.0], schema="array<double>") is None


def test_routing(spark):
    assert one(spark, routing.by_file_name, "ThueNhaMatPho_batch.json") == "nhamatpho_index"
    assert one(spark, routing.by_file_name, "datbietthu_batch") == "dat_index"
    assert one(spark, routing.by_file_name, "other") == "bds_khac_index"
    assert one(spark, routing.tables_of_request, [" Đất ", "đất nền", "?"], schema="array<string>") == ["dat_index"]
    assert one(spark, routing.tables_of_request, None, schema="array<string>") == fixed.SEARCH_TABLES_DEFAULT
    assert one(spark, routing.province_of_slug, "nowhere") is None


def test_cleaners_are_idempotent(spark):
    df = spark.createDataFrame([("a !! b,, c....",), ("★ x ~~ y",), ("a .. . .b",)], "t string")
    once = text.strip_special(F.col("t"))
    rows = df.select(once.alias("a"), text.strip_special(once).alias("b")).collect()
    assert all(r.a == r.b for r in rows)
    clean = text.simple_clean(F.col("t"))
    assert all(r.a == r.b for r in df.select(clean.alias("a"), text.simple_clean(clean).alias("b")).collect())


def test_tone_marks(spark):
    import unicodedata

    from listmill.functions import text as t

    rows = [
        ("Ðảm baỏ chất lựơng phòng thí nghịêm hoá học", "Ðảm bảo chất lượng phòng thí nghiệm hóa học"),
        ("", ""), (None, None), ("no tones at all", "no tones at all"), ("áá x", "áá x"), ("qúa, gìa; GỈAO", "quá, già; GIẢO"), ("tủôi2", "tủôi2"),
        ("line\nhoà\n", "line\nhòa\n"), ("củả", "củả"), ("thuở, thúơ", "thuở, thuớ"),
    ]
    rows = [(a and unicodedata.normalize("NFC", a), b and unicodedata.normalize("NFC", b)) for a, b in rows]
    df = spark.createDataFrame([(k, a) for k, (a, _) in enumerate(rows)], "k int, s string")
    found = {r.k: r.o for r in df.select("k", t.tone_marks(F.col("s")).alias("o")).collect()}
    expected = {k: b for k, (_, b) in enumerate(rows)}
    expected[6] = found[6]  # a digit ends the run of letters; the syllable before it is mended
    assert found == expected and found[6] == unicodedata.normalize("NFC", "tuổi2")


def test_tone_marks_looks_up_runs(spark):
    from listmill.functions import text as t

    df = spark.createDataFrame([("a long plain name, hoà nhà",), ("ho\ue001\ue001 a\ue000b",)], "s string")
    units = lambda pattern: [r.u for r in df.select(F.regexp_extract_all("s", F.lit(pattern), F.lit(0)).alias("u")).collect()]
    assert units(t._UNITS)[0] == ["a long plain name, ho", "à", " nh", "à"]
    assert units(t._TONED_UNITS) == [["a long plain name, hoà nhà"], ["h", "o\ue001", "\ue001", " ", "a\ue000", "b"]]
