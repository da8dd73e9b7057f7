"""Operators against brute force or hand-made expectations on small tables."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from listmill.operators import (
    conversations, evaluate, gazetteer, geo, lookback, market, markup, outliers, records, search, similar,
)
from listmill.schema import REQUEST


def test_exact_quantiles_compute_their_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def prices(batches):
        for batch in batches:
            seen.add(len(batch))
            yield pd.DataFrame({"g": (batch["id"] % 3).astype(str), "v": (batch["id"] % 100).astype(float)})

    rows = spark.range(1000).mapInPandas(prices, "g string, v double")
    got = {r.g: r.q0 for r in outliers.exact_quantiles(rows, "g", "v", [0.5]).collect()}
    assert seen.value == 1000
    assert got == {str(g): float(np.quantile([k % 100 for k in range(g, 1000, 3)], 0.5)) for g in range(3)}


@pytest.mark.parametrize("accuracy", [10_000, 200])
def test_exact_quantiles_equal_numpy(spark, accuracy):
    rng = random.Random(3)
    data = {"a": [rng.gauss(0, 1) for _ in range(30_000)], "b": [float(rng.randrange(20)) for _ in range(5_000)], "c": [7.0]}
    rows = [(g, v) for g, vs in data.items() for v in vs] + [("a", None), (None, 2.0), (None, 4.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    got = {r.g: r for r in outliers.exact_quantiles(df, "g", "v", [0.05, 0.5, 0.95], accuracy).collect()}
    for g, values in [*data.items(), (None, [2.0, 4.0])]:
        assert [got[g].q0, got[g].q1, got[g].q2] == pytest.approx(list(np.quantile(values, [0.05, 0.5, 0.95])))
        assert got[g].n == len(values)


def test_approximate_bounds_within_rank_error(spark):
    df = spark.range(100_000).select(F.lit("x").alias("g"), F.col("id").cast("double").alias("v"))
    r = outliers.approx_bounds(df, "g", "v", spreads=0.0).first()
    assert abs(r.lower_bound - 5_000) <= 20 and abs(r.upper_bound - 95_000) <= 20


def test_trim_null_rules(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 99.0), ("a", None), (None, 5.0), ("z", 3.0)], "g string, v double")
    bounds = spark.createDataFrame([("a", 0.0, 10.0)], "g string, lower_bound double, upper_bound double")
    strict = {tuple(r) for r in outliers.trim(df, bounds, "g", "v", keep_null=False).collect()}
    loose = {tuple(r) for r in outliers.trim(df, bounds, "g", "v", keep_null=True).collect()}
    assert strict == {("a", 1.0)}
    assert loose == {("a", 1.0), ("a", None), (None, 5.0), ("z", 3.0)}


def test_district_average_fills_zero(spark):
    rows = spark.createDataFrame(
        [("P", "A", "nhà", 10.0), ("P", "A", "nhà cho thuê", 99.0), ("P", "X", "nhà", 5.0), ("P", "B", None, 4.0)],
        "province string, district string, estate_type string, price double",
    )
    domain = spark.createDataFrame([("P", "A"), ("P", "B"), ("P", "C")], "province string, district string")
    got = {r.district: r.avg_price for r in market.by_district(rows, domain.select("district"), "price").collect()}
    assert got == {"A": 10.0, "B": 4.0, "C": 0.0}


def test_day_series(spark):
    rows = spark.createDataFrame(
        [("A", "nhà", dt.date(2024, 1, 1), 2.0), ("A", "nhà", dt.date(2024, 1, 4), 6.0), ("B", "nhà", dt.date(2024, 1, 2), 1.0)],
        "district string, estate_type string, post_date date, price double",
    )
    got = [(r.day.day, r.avg_price) for r in market.by_day(rows, "price", "A", "2024-01-01", "2024-01-31").orderBy("day").collect()]
    assert got == [(1, 2.0), (2, 0.0), (3, 0.0), (4, 6.0)]
    assert market.by_day(rows, "price", "A", "2024-02-01", "2024-01-01").count() == 0
    assert market.by_day(rows, "price", "A", "soon", "2024-01-01").count() == 0


def test_heat_layer_equal_values(spark):
    metric = spark.createDataFrame([("P", "A", 1.0), ("P", "B", 1.0)], "province string, district string, v double")
    coords = spark.createDataFrame([("P", "A", 1.0, 2.0), ("P", "B", None, None)], "province string, district string, lat double, lon double")
    layer = geo.heat_layer(metric, coords, "v")
    assert [(r.district, r.weight) for r in layer.collect()] == [("A", 0.5)]
    assert geo.map_extent(layer.where("false")).first().centre_lat == 21.0285


GAZ = [
    (1, "Hà Nội", None, None, "Thành phố", 1), (2, "Hà Nội", "Ba Đình", None, "Quận", 2),
    (3, "Hà Nội", "Ba Đình", "Cống Vị", "Phường", 3), (2, "Hà Nội", "Ba", None, "Huyện", 4),
    (1, "Hải Phòng", None, None, "Thành phố", 10), (2, "Hải Phòng", "Ba", None, "Quận", 11),
    (3, "Hải Phòng", "Ba", "Chợ", "Xã", 12), (2, "Hải Phòng", "An", None, "Huyện", 13),
]
ADDRESSES = [
    ("phường cống vị, quận ba đình, hà nội", None, ("Hà Nội", "Ba Đình", "Cống Vị")),
    ("huyện ba", None, ("Hà Nội", "Ba", None)),
    ("ba đình", "Hải Phòng", ("Hải Phòng", "Ba", None)),
    ("xã chợ", None, ("Hải Phòng", "Ba", "Chợ")),
    ("nowhere", None, (None, None, None)),
    ("", "Hải Phòng", ("Hải Phòng", None, None)),
    (None, None, (None, None, None)),
]


def test_gazetteer(spark):
    gaz = spark.createDataFrame(GAZ, "level int, province string, district string, ward string, prefix string, ord long")
    rows = spark.createDataFrame([(i, a, g) for i, (a, g, _) in enumerate(ADDRESSES)], "i int, full_address string, given string")
    got = gazetteer.resolve(rows, gaz, "full_address", "given").orderBy("i").collect()
    assert [(r.province, r.district, r.ward) for r in got] == [e for _, _, e in ADDRESSES]


def greedy(items, alike):
    kept = []
    for i, item in items:
        if not any(alike(item, k) for _, k in kept):
            kept.append((i, item))
    return {i for i, _ in kept}


def texts(seed, families=12, size=18):
    """Families of look-alikes, one of them large, and exact copies."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    out = []
    for f in range(families):
        base = [rng.choice(vocabulary) for _ in range(40)]
        for _ in range(size * (6 if f == 0 else 1)):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 3, 8])):
                words[rng.randrange(40)] = rng.choice(vocabulary)
            out.append(" ".join(words))
    rng.shuffle(out)
    return [*enumerate(out), (len(out), ""), (len(out) + 1, "")]


def test_near_duplicates_jaccard_equals_greedy(spark):
    rows = texts(5)

    def alike(a, b):
        x, y = set(a.split()), set(b.split())
        return (len(x & y) / len(x | y) if x | y else 1.0) >= 0.7

    df = spark.createDataFrame(rows, "id long, t string").repartition(4)
    decided = similar.near_duplicates_jaccard(df, "id", "t", 0.7).collect()
    kept = {r.id for r in decided if r.kept_as == r.id}
    assert len(decided) == len(rows) and kept == greedy(rows, alike)
    by_id = dict(rows)
    assert all(alike(by_id[r.id], by_id[r.kept_as]) and r.kept_as in kept for r in decided if r.kept_as != r.id)


def test_near_duplicates_listing_equals_greedy(spark):
    rows = [(i, f"t{i % 3}", t) for i, t in texts(6, 8, 10)]
    n = len(rows)
    sets = [t.split() for _, _, t in rows]
    df_ = {}
    for words in sets:
        for w in set(words):
            df_[w] = df_.get(w, 0) + 1

    def vector(t):
        words = t.split()
        v = {w: words.count(w) * (np.log((1 + n) / (1 + df_[w])) + 1) for w in set(words)}
        size = np.sqrt(sum(x * x for x in v.values())) or 1.0
        return {w: x / size for w, x in v.items()}

    def alike(a, b):
        cos = sum(x * b[1].get(w, 0.0) for w, x in a[1].items())
        return cos > 0.99 or (cos > 0.95 and a[0] == b[0])

    items = [(i, (title, vector(t))) for i, title, t in rows]
    frame = spark.createDataFrame(rows, "id long, title string, t string").repartition(4)
    decided = similar.near_duplicates_listing(frame, "id", "title", "t").collect()
    assert {r.id for r in decided if r.kept_as == r.id} == greedy(items, alike)


def test_sketches_bound_the_similarity_and_rule_out_unlike_rows():
    rng = np.random.default_rng(5)
    for n in (1, 40, 700):
        common, own, other = (rng.integers(-(2**62), 2**62, n) for _ in range(3))
        for a, b in ((common, common), (np.r_[common, own], common), (own, other), (np.r_[common[: n // 2], own], np.r_[common[: n // 2], other])):
            x, y = similar.parities.func(pd.Series([a, b]))
            apart = similar.least_apart.func(pd.Series([x]), pd.Series([y]))[0]
            assert apart <= len(np.setxor1d(a, b))
            v, w = (rng.random(len(t)) + 0.1 for t in (a, b))
            v, w = v / np.sqrt(v @ v), w / np.sqrt(w @ w)
            weights = dict(zip(b.tolist(), w))
            cosine = sum(p * weights.get(t, 0.0) for t, p in zip(a.tolist(), v))
            most = similar.most_cosine.func(pd.Series([similar._norms(a, v)]), pd.Series([similar._norms(b, w)]))[0]
            assert most >= cosine
            if n == 700 and a is own:
                # unlike rows need no look at their contents
                assert apart > (1 - 0.7) / (1 + 0.7) * 2 * n and most < 0.95


def test_buckets_that_decide_nothing_go(spark):
    rows = [(1, "a", 10, 3, 3), (2, "a", 10, 3, 3), (3, "b", 10, 3, 3), (4, "c", 10, 3, 4), (5, "c", 10, 3, 4), (6, "d", 10, 3, 4), (7, "d", 14, 4, 4)]
    buckets = spark.createDataFrame(rows, "id long, bucket string, size int, own int, class int")
    assert {r.id for r in similar._shared(buckets, True).collect()} == {1, 2, 6, 7}
    assert {r.id for r in similar._shared(buckets, False).collect()} == {1, 2, 4, 5, 6, 7}


def test_minhash_finds_most_and_only_true_pairs(spark):
    rows = texts(7, 6, 12)
    df = spark.createDataFrame(rows, "id long, t string")
    exact = {r.id for r in similar.near_duplicates_jaccard(df, "id", "t", 0.8).collect() if r.kept_as != r.id}
    found = similar.near_duplicates_jaccard(df, "id", "t", 0.8, "minhash").collect()
    by_id = dict(rows)
    for r in found:
        if r.kept_as != r.id:
            x, y = set(by_id[r.id].split()), set(by_id[r.kept_as].split())
            assert not (x | y) or len(x & y) / len(x | y) >= 0.8
    assert len({r.id for r in found if r.kept_as != r.id}) >= 0.9 * len(exact)


def test_look_back_pairs_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(40, 8))
    vectors = [(i, str(i % 4), (base[i % 40] + rng.normal(scale=0.05, size=8)).tolist()) for i in range(160)]
    df = spark.createDataFrame(vectors, "pos long, title string, v array<double>")
    got = {(r.later, r.earlier) for r in lookback.similar_pairs(df, "pos", "title", "v", look_back=50).collect()}
    want = set()
    for i, ti, vi in vectors:
        for j, tj, vj in vectors:
            cos = np.dot(vi, vj) / np.linalg.norm(vi) / np.linalg.norm(vj)
            if 0 < i - j <= 50 and (cos > 0.99 or (cos > 0.95 and ti == tj)):
                want.add((i, j))
    assert got == want and want


def test_hashed_tfidf_reuses_model(spark):
    df = spark.createDataFrame([(1, "a b b"), (2, "a c"), (3, None)], "id long, t string")
    first, model = similar.tfidf_vectors(df, "t")
    again, _ = similar.tfidf_vectors(df, "t", model)
    a = [r.text_vector for r in first.orderBy("id").collect()]
    assert a == [r.text_vector for r in again.orderBy("id").collect()] and len(a[2].indices) == 1


def test_records(spark):
    df = spark.createDataFrame([(None, "l1"), ("7", "l2")], "post_id string, link string")
    ids = [r.id for r in records.with_id(df).collect()]
    assert ids[1] == "7" and len(ids[0]) == 32
    batch = spark.createDataFrame([(1, "a", "2024/01/01"), (2, "b", "2024/01/01")], "id long, v string, created_at string")
    speed = spark.createDataFrame([(2, "c", "2024/01/01"), (3, "d", "2024/01/02")], "id long, v string, created_at string")
    assert {(r.id, r.v) for r in records.merge_views(batch, speed).collect()} == {(1, "a"), (2, "c"), (3, "d")}
    dup = spark.createDataFrame([(1, "x", None), (2, "x", None), (3, "y", "z")], "p long, t string, d string")
    assert {r.p for r in records.first_per_key(dup, ["t", "d"], "p").collect()} == {1, 3}
    post = records.reader_record(spark.createDataFrame([(None, None)], "price double, ward string")).first()
    assert (post.price, post.address.ward, post.contact_info.phone, post.post_id) == (0.0, "", [], "")


def test_conversations(spark):
    turns = spark.createDataFrame([(1, t, "user" if t % 2 == 0 else None, f"m{t}") for t in range(12)], "c int, t long, role string, text string")
    got = conversations.context_window(turns, "c", "t", ["text"], size=3, block=5).orderBy("t").collect()
    assert [[x.text for x in r.context] for r in got] == [[f"m{j}" for j in range(max(0, i - 3), i)] for i in range(12)]
    parts = conversations.transcript(turns, "c", "t", "role", "text").collect()
    assert len(parts) == 1 and parts[0].transcript == "".join(f"{'user' if t % 2 == 0 else 'unknown'}: m{t}\n" for t in range(12))
    gaps = spark.createDataFrame([(1, t, f"m{t}") for t in (0, 100, 200, 300, 301, 302, 303, 304, 305, 900, 5000)], "c int, t long, text string")
    texts = [r.text for r in gaps.orderBy("t").collect()]
    got = conversations.context_window(gaps, "c", "t", ["text"], size=3, block=100).orderBy("t").collect()
    assert [[x.text for x in r.context] for r in got] == [texts[max(0, i - 3) : i] for i in range(len(texts))]
    current = spark.createDataFrame([("a", "old"), ("b", "keep")], "chat_id string, title string")
    updates = spark.createDataFrame([("a", None), ("n", "new")], "chat_id string, title string")
    merged = {r.chat_id: (r.title, r.is_new) for r in conversations.upsert(current, updates, "chat_id").collect()}
    assert merged == {"a": (None, False), "b": ("keep", None), "n": ("new", True)}


def test_evaluation_on_empty_input(spark):
    empty = spark.createDataFrame([], "e int, p int, a array<string>, b array<string>")
    assert evaluate.tool_accuracy(empty, "a", "b").first().accuracy == 0.0
    assert evaluate.confusion_metrics(empty, "e", "p", 1, 0).first().f1_negative == 0.0


SPANS_PAGE = """<html><div class="product_base"><ul class="breadcrumb"><li><a href="/">Trang chủ</a></li><li><a> Hà Nội </a></li>
<li><a>Ba Đình</a></li></ul></div><h1 class="title-product">Nhà &amp; vườn</h1><div class="ct-pr-sum"> dòng 1<br> <b>bỏ</b>dòng 2 </div>
<ul class="list-attr-hot"><li><span class="value-attr">2 tỷ</span></li><li><span class="value-attr">50 m2</span></li>
<li><span class="value-attr2">3/1/2024</span></li><li><span class="value-attr2">99</span></li></ul>
<ul class="list-attr-hot x"><li><span>Số Tầng</span><span>3</span></li></ul><div class="content-info-member"><span class="member-name">An</span></div>
<div class="row-contact-product"><a class="hotline-member-detail" href="tel:09.12">g</a></div></html>"""
LINES_PAGE = """<h1 class="detail-prop-title"><span>Nhà đẹp</span></h1><div class="prop-description"><div><p>Mô tả</p></div></div>
<div class="prop-address"><a><span>Ba Đình, Hà Nội</span></a></div><a class="phone-link"><div class="seller-info-phone"><div class="infoPhone">
<span class="hide-phone"> 0912 </span></div></div></a><div class="seller-info-header"><div><h3>Bình</h3></div></div>
<div class="prop-features"><div>x</div><div>y</div><div>z</div><div>Giá : 2 tỷ</div><div>Diện  Tích: 50<div>Hướng: Đông</div></div>
<div>Nội thất: đủ</div><div>Ngày Đăng: 03/01/2024 - 9</div><div>a:b:c</div></div><div>Khác: ngoài</div>"""


def test_listing_pages(spark):
    pages = lambda html: spark.createDataFrame([("http://s/p", html)], "url string, html string")
    a = markup.spans_record(pages(SPANS_PAGE)).first()
    assert (a.title, a.price, a.square, a.post_date, a.post_id) == ("Nhà & vườn", "2 tỷ", "50 m2", "3/1/2024", "99")
    assert a.description.split() == ["dòng", "1", "dòng", "2"]
    assert a.address.full_address == "Ba Đình, Hà Nội" and a.contact_info.name == "An" and a.contact_info.phone == ["0912"]
    assert a.extra_infos == {"Số Tầng": "3"}
    b = markup.lines_record(pages(LINES_PAGE)).first()
    assert (b.title, b.description, b.price, b.square, b.post_date) == ("Nhà đẹp", "Mô tả", "2 tỷ", "50", "03/01/2024")
    assert b.address.full_address == "Ba Đình, Hà Nội" and b.contact_info.phone == ["0912"] and b.contact_info.name == "Bình"
    assert b.extra_infos == {"Hướng": "Đông"}


def test_links(spark):
    hrefs = ["/a", "b", "http://x/y", "//z/w", "?q=1", "#t"]
    html = "".join(f'<a class="k" href="{h}">x</a>' for h in hrefs)
    df = spark.createDataFrame([("https://s.vn/d/p?x=1", html)], "url string, html string")
    got = [r.link for r in markup.links(df).orderBy("position").collect()]
    assert got == ["https://s.vn/a", "https://s.vn/d/b", "http://x/y", "https://z/w", "https://s.vn/d/p?q=1", "https://s.vn/d/p?x=1#t"]


def listing_rows(n=400, seed=2):
    rng = random.Random(seed)
    return [
        (i, str(i), f"l{i}", rng.choice(["nhamatpho_index", "dat_index"]), rng.choice("PQ"), rng.choice("ABC"), rng.choice("xyz"),
         rng.choice(["nhà đẹp", "căn góc", None]), dt.date(2024, 1, rng.randint(1, 28)), "2024", rng.uniform(1, 100),
         rng.choice([None, 10.0, 20.0]), rng.uniform(1, 50), rng.randint(1, 4))
        for i in range(n)
    ]


LISTING_SCHEMA = """id long, post_id string, link string, category string, province string, district string, ward string,
description string, post_date date, created_at string, price double, price_per_m2 double, square double, no_bedrooms int,
no_bathrooms int, no_floors int, front_face double, front_road double, ultilization_square double"""


def test_strict_search_same_for_small_and_large_request_tables(spark, monkeypatch):
    rows = spark.createDataFrame([(*r, None, None, None, None, None) for r in listing_rows()], LISTING_SCHEMA)
    asked = [
        {"request_id": 1, "estate_type": ["đất"], "district": ["Quận A", "B"], "min_price": 20.0},
        {"request_id": 2, "estate_type": ["đất", "nhà phố"], "province": ["P"], "no_bedrooms": 2},
        {"request_id": 3, "estate_type": ["nhà phố"], "description": "đep"},
        {"request_id": 4, "estate_type": ["nhà phố"], "ward": ["x"], "province": ["Q"], "is_latest_posted": True},
    ]
    requests = search.clean_requests(
        spark.createDataFrame([tuple(a.get(f.name) for f in REQUEST.fields) for a in asked], REQUEST)
    )
    few = {tuple(r) for r in search.strict_hits(rows, requests).collect()}
    monkeypatch.setattr(search, "BROADCAST_ROWS", 0)
    many = {tuple(r) for r in search.strict_hits(rows, requests).collect()}
    assert few == many and {r[0] for r in few} == {1, 2, 3, 4} and all(r[2] <= 12 for r in few)


def test_clean_requests_accepts_single_values(spark):
    df = spark.createDataFrame(
        [("đất", "P", "Huyện A ", "w", "2.0", "x", "1", "5", None, None, None, None, None)],
        "estate_type string, province string, district string, ward string, no_bedrooms string, no_bathrooms string, "
        "no_floors string, price string, min_price string, max_price string, square string, front_face string, front_road string",
    )
    r = search.clean_requests(df).first()
    assert (r.estate_type, r.district, r.no_bedrooms, r.no_bathrooms, r.price) == (["đất"], ["A"], 2, None, 5.0)


def test_a_long_transcript_is_joined_by_blocks(spark):
    turns = spark.range(1000).selectExpr("1 c", "999 - id t", "'user' role", "concat('m', 999 - id) text")
    turns = turns.union(spark.createDataFrame([(2, None, "bot", "x"), (2, 300, None, None), (2, 5, "bot", "y")], "c int, t long, role string, text string"))
    blocks = conversations.transcript_blocks(turns, "c", "t", "role", "text").collect()
    assert max(r._text.count("\n") for r in blocks) <= 256 and len(blocks) == 4 + 3
    found = {r.c: r.transcript for r in conversations.transcript(turns, "c", "t", "role", "text").collect()}
    assert found == {1: "".join(f"user: m{t}\n" for t in range(1000)), 2: "bot: x\nbot: y\nunknown: \n"}


def kept_by_list(items, look_back, same=0.95, any_=0.99):
    """The list of kept items as a loop."""
    held, out = [], {}
    for pos, title, vec in sorted(items, key=lambda i: i[0]):
        if len(held) > look_back:
            held = held[look_back // 4 :]
        v = None if vec is None or None in vec or not any(vec) else np.array(vec) / np.linalg.norm(vec)
        like = False
        for other_title, other in held:
            if v is not None and other is not None and len(v) == len(other):
                c = float(v @ other)
                like |= c > any_ or (c > same and title == other_title)
        out[pos] = not like
        if not like:
            held.append((title, v))
    return out


@pytest.mark.parametrize("look_back, block_rows, seed", [(4, 400, 1), (9, 500, 2), (20, 300, 3), (4000, None, 5)])
def test_lookback_keep_equals_a_list(spark, look_back, block_rows, seed):
    r = np.random.default_rng(seed)
    centers = r.standard_normal((12, 4))
    items, pos = [], 0
    for _ in range(260):
        pos += int(r.integers(1, 9)) if r.random() < 0.9 else 60
        vec = (centers[r.integers(0, 12)] + r.choice([0.0, 0.05, 0.2]) * r.standard_normal(4)).tolist()
        vec = vec if r.random() < 0.9 else [None, [], [0.0] * 4, [1.0, None, 2.0, 3.0], vec[:3]][r.integers(0, 5)]
        items.append((pos, str(r.choice(["a", "b"])) if r.random() < 0.9 else None, vec))
    df = spark.createDataFrame([(*i, "x", 1) for i in items], "p long, t string, v array<double>, own string, number int").repartition(3)
    found = lookback.keep(df, "p", "t", "v", look_back=look_back, block_rows=block_rows)
    rows = found.collect()
    assert found.columns == ["p", "kept"] and len(rows) == len(items)
    assert {row.p: row.kept for row in rows} == kept_by_list(items, look_back)


def test_lookback_keep_of_nothing(spark):
    df = spark.createDataFrame([], "p long, t string, v array<double>")
    assert lookback.keep(df, "p", "t", "v").count() == 0


def test_lookback_keep_by_source(spark):
    r = np.random.default_rng(9)
    items = [(k, "a", [1.0, float(r.integers(0, 6)) / 7]) for k in range(120)]
    rows = [(*i, ["x", "y", None][i[0] % 3]) for i in items]
    df = spark.createDataFrame(rows, "p long, t string, v array<double>, site string")
    found = {(row.site, row.p): row.kept for row in lookback.keep(df, "p", "t", "v", look_back=5, block_rows=60, source="site").collect()}
    expected = {(site, p): kept for site in ("x", "y", None) for p, kept in kept_by_list([i[:3] for i in rows if i[3] == site], 5).items()}
    assert found == expected


def test_shuffles_behind_a_settled_table_go(spark):
    from listmill.session import settle

    names = []
    df = spark.range(1_000).groupBy((F.col("id") % 50).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    shuffles = lambda: spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()
    before = shuffles()
    for _ in range(3):
        names.append(settle(df.join(df.withColumnRenamed("n", "m"), "k")))
    assert shuffles() <= before
    # the settled tables and the one behind them can be read as often as wanted
    assert [t.count() for t in names] == [50] * 3 and df.count() == 50 and settle(df).count() == 50 and df.count() == 50
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"


def test_prefixes_and_vectors_inside_rows_are_those_of_the_joins(spark, monkeypatch):
    from listmill.operators import similar

    r = random.Random(8)
    words = [f"w{k}" for k in range(40)] + [f"rare{k}" for k in range(300)]
    table = [(k, " ".join(r.choices(words, weights=[20] * 40 + [1] * 300, k=r.randrange(0, 40))), r.choice(["a", "b", None])) for k in range(120)]
    table += [(200 + k, table[k][1] + " more", "a") for k in range(30)] + [(300, None, "a"), (301, "", "b"), (302, "only", None)]
    df = spark.createDataFrame(table, "id long, t string, title string").repartition(3)

    def answers():
        exact = {tuple(x) for x in similar.near_duplicates_jaccard(df, "id", "t", 0.7).collect()}
        listing = {(x.id, x.kept_as, x.score and round(x.score, 9)) for x in similar.near_duplicates_listing(df, "id", "title", "t").collect()}
        return exact, listing

    inside = answers()
    used = []
    for name in ("prefixes_in_rows", "vectors_in_rows"):
        monkeypatch.setattr(similar, name, lambda *a, n=name: used.append(n))
    monkeypatch.setattr(similar, "SENT_TOKENS", 5)
    assert answers() == inside and not used
    assert len(inside[0]) == len(inside[1]) == len(table)
