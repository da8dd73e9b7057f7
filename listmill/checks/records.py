"""Record ids, ingest columns, versions, shaping, pages, conversations, evaluation."""

from pyspark.sql import functions as F

from listmill.checks.registry import query
from listmill.checks.views import LISTINGS_SQL, RAW_SQL, listings, raw_listings, table
from listmill.functions import fields
from listmill.operators import conversations, evaluate, markup, records
from listmill.operators.market import numbered


@query("SELECT page_id, md5(url) AS id FROM pages")
def record_ids(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", F.lit(None).cast("string").alias("post_id"), F.col("url").alias("link"))
    return records.with_id(pages).select("page_id", "id")


@query(f"WITH {RAW_SQL} SELECT k, coalesce(post_id, md5(link)) AS id FROM raw")
def record_ids_of_listings(spark, sf):
    return records.with_id(raw_listings(spark, sf).select("k", "post_id", "link")).select("k", "id")


@query("""SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
CAST(day(ts) AS INTEGER) AS day FROM events""")
def ingest_partitions(spark, sf):
    return records.with_ingest_date(table(spark, sf, "events").select("event_id", "ts"), F.col("ts")).drop("ts")


@query("SELECT event_id, strftime(ts, '%Y/%m/%d %H:%M:%S') AS created_at FROM events")
def created_stamp(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts")
    return records.with_created_at(events, F.col("ts")).drop("ts")


@query("SELECT min(doc_id) AS doc_id, md5(text) AS digest, lang FROM documents GROUP BY text, lang")
def dedup_keep_first(spark, sf):
    kept = records.first_per_key(table(spark, sf, "documents"), ["text", "lang"], "doc_id")
    return kept.select("doc_id", F.md5("text").alias("digest"), "lang")


@query("SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def remove_by_id(spark, sf):
    toxic = table(spark, sf, "labels").where("toxic = 1")
    return records.remove_ids(table(spark, sf, "documents").select("doc_id", "lang"), toxic, "doc_id")


# Batch view: all orders as of their day. Speed view: open orders, re-priced and stamped later or, for some, earlier.
_VIEWS_SQL = """batch AS (SELECT o_orderkey AS id, o_totalprice AS price, strftime(o_orderdate, '%Y/%m/%d %H:%M:%S') AS created_at
  FROM orders WHERE o_orderstatus <> 'P'),
speed AS (SELECT o_orderkey AS id, o_totalprice * 2 AS price, CASE WHEN o_orderpriority = '1-URGENT' THEN '1990/01/01 00:00:00'
  ELSE strftime(o_orderdate + INTERVAL 1 DAY, '%Y/%m/%d %H:%M:%S') END AS created_at FROM orders WHERE o_orderstatus <> 'F')"""


def _views(spark, sf):
    orders = table(spark, sf, "orders")
    later = fields.stamp(F.col("o_orderdate") + F.expr("INTERVAL 1 DAY"))
    batch = orders.where("o_orderstatus <> 'P'").select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"), fields.stamp(F.col("o_orderdate")).alias("created_at")
    )
    speed = orders.where("o_orderstatus <> 'F'").select(
        F.col("o_orderkey").alias("id"), (F.col("o_totalprice") * 2).alias("price"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("1990/01/01 00:00:00")).otherwise(later).alias("created_at"),
    )
    return batch, speed


@query(f"""WITH {_VIEWS_SQL} SELECT coalesce(b.id, s.id) AS id, CASE WHEN b.id IS NULL OR s.created_at >= b.created_at THEN s.price ELSE b.price END AS price,
CASE WHEN b.id IS NULL OR s.created_at >= b.created_at THEN s.created_at ELSE b.created_at END AS created_at
FROM batch b FULL JOIN speed s ON b.id = s.id""")
def lambda_merge(spark, sf):
    return records.merge_views(*_views(spark, sf))


@query("""SELECT l_orderkey AS id, max(l_shipdate)::DATE AS version, count(*) AS versions,
arg_max(l_partkey, row(l_shipdate, l_linenumber, l_partkey)) AS part, max(row(l_shipdate, l_linenumber, l_partkey))[2] AS line
FROM lineitem GROUP BY l_orderkey""")
def latest_version(spark, sf):
    """The line shipped last, of equal dates the one with the highest number and part."""
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.to_date("l_shipdate").alias("version"), F.col("l_partkey").alias("part"),
        F.col("l_linenumber").alias("line"),
    )
    latest = records.latest_per_id(lines, "id", "version", F.desc("line"), F.desc("part"))
    counts = lines.groupBy("id").agg(F.count(F.lit(1)).alias("versions"))
    return latest.join(counts, "id")


@query(f"""WITH {LISTINGS_SQL} SELECT CAST(id AS VARCHAR) AS id, post_id, district, province, ward, coalesce(price, 0) AS price,
round(coalesce(price_per_m2, 0), 6) AS price_per_square, coalesce(square, 0) AS square, no_bedrooms, 0 AS phones, title FROM listings""")
def reader_records(spark, sf):
    rows = records.reader_record(listings(spark, sf))
    return rows.select(
        "id", "post_id", "address.district", "address.province", "address.ward", "price",
        F.round("price_per_square", 6).alias("price_per_square"), "square", "extra_infos.no_bedrooms",
        F.size("contact_info.phone").alias("phones"), "title",
    )


@query(f"""WITH {LISTINGS_SQL} SELECT id, CAST(price AS DOUBLE) AS price, CAST(square AS FLOAT) AS square,
CAST(no_bedrooms AS INTEGER) AS no_bedrooms FROM listings""")
def typed_columns(spark, sf):
    return records.typed(listings(spark, sf)).select("id", "price", "square", "no_bedrooms")


@query(f"""WITH {LISTINGS_SQL}, a AS (SELECT district, round(avg(square), 6) AS v FROM listings GROUP BY 1)
SELECT row_number() OVER (ORDER BY v DESC, district) AS seq, district, v FROM a""")
def sequence_numbers(spark, sf):
    averages = listings(spark, sf).groupBy("district").agg(F.round(F.avg("square"), 6).alias("v"))
    return numbered(averages, F.desc("v"), "district")


# ---------------------------------------------------------------- pages

_UNESCAPE = ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&")


def unescape_sql(value):
    for entity, char in _UNESCAPE:
        value = f"replace({value}, '{entity}', '{char}')"
    return value


def strip_each_sql(value):
    from listmill.checks.fields import strip_sql

    return f"array_to_string(list_transform({value}, lambda x: {strip_sql(unescape_sql('x'))}), chr(10))"


@query(f"""SELECT page_id, {unescape_sql("regexp_extract(html, '(?is)<title[^>]*>([^<]*)', 1)")} AS page_title,
{unescape_sql("regexp_extract(html, '(?is)<h1[^>]*>([^<]*)', 1)")} AS title, url AS link,
md5({strip_each_sql("regexp_extract_all(regexp_extract(html, '(?is)<article[^>]*>(.*?)</article>', 1), '(?is)<p>(?:<b>)?([^<]+)', 1)")}) AS text
FROM pages""")
def page_record(spark, sf):
    rows = markup.article_record(table(spark, sf, "pages"))
    return rows.select("page_id", "page_title", "title", "link", F.md5("description").alias("text"))


@query(r"""WITH a AS (SELECT page_id, url, unnest(regexp_extract_all(html, '(?is)<a\b[^>]*\bhref="([^"]*)"', 1)) AS href,
  generate_subscripts(regexp_extract_all(html, '(?is)<a\b[^>]*\bhref="([^"]*)"', 1), 1) - 1 AS position FROM pages),
b AS (SELECT *, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) AS root, regexp_extract(url, '^([^?#]*)', 1) AS page FROM a)
SELECT page_id, url, position, CASE WHEN regexp_matches(href, '^[a-z]+:') THEN href WHEN starts_with(href, '//') THEN regexp_extract(url, '^([a-z]+):', 1) || ':' || href
WHEN starts_with(href, '/') THEN root || href WHEN href = '' THEN url WHEN starts_with(href, '?') THEN page || href
WHEN starts_with(href, '#') THEN regexp_extract(url, '^([^#]*)', 1) || href
ELSE CASE WHEN page = root THEN root || '/' ELSE regexp_extract(page, '^(.*/)', 1) END || href END AS link FROM b""")
def page_links(spark, sf):
    return markup.links(table(spark, sf, "pages"))


# ---------------------------------------------------------------- conversations


@query("""SELECT conv_id, turn, coalesce(string_agg(role || ':' || md5(text), ',') OVER
(PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING), '') AS context FROM conversations""")
def context_window(spark, sf):
    turns = conversations.context_window(table(spark, sf, "conversations"), "conv_id", "turn", ["role", "text"])
    shown = F.transform("context", lambda t: F.concat(t["role"], F.lit(":"), F.md5(t["text"])))
    return turns.select("conv_id", "turn", F.array_join(shown, ",").alias("context"))


# Positions with gaps, most of them beyond the border of a block.
@query("""SELECT conv_id, turn * turn * 97 AS place, coalesce(string_agg(role || ':' || md5(text), ',') OVER
(PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING), '') AS context FROM conversations""")
def context_window_gaps(spark, sf):
    turns = table(spark, sf, "conversations").withColumn("place", F.col("turn") * F.col("turn") * 97)
    turns = conversations.context_window(turns, "conv_id", "place", ["role", "text"])
    shown = F.transform("context", lambda t: F.concat(t["role"], F.lit(":"), F.md5(t["text"])))
    return turns.select("conv_id", "place", F.array_join(shown, ",").alias("context"))


@query("""SELECT conv_id, string_agg(role || ': ' || text || chr(10), '' ORDER BY turn) AS transcript FROM conversations GROUP BY 1""")
def transcript(spark, sf):
    return conversations.transcript(table(spark, sf, "conversations"), "conv_id", "turn", "role", "text")


# The stored chats are the users' turns, the update brings the assistants' turns of longer conversations.
@query("""WITH cur AS (SELECT conv_id, count(*) AS turns, min(text) AS title FROM conversations WHERE role = 'user' AND turn >= 2 GROUP BY 1),
upd AS (SELECT conv_id, count(*) AS turns, max(text) AS title FROM conversations WHERE role = 'assistant' GROUP BY 1)
SELECT coalesce(c.conv_id, u.conv_id) AS conv_id, CASE WHEN u.conv_id IS NOT NULL THEN u.turns ELSE c.turns END AS turns,
CASE WHEN u.conv_id IS NOT NULL THEN u.title ELSE c.title END AS title,
CASE WHEN u.conv_id IS NOT NULL THEN c.conv_id IS NULL END AS is_new FROM cur c FULL JOIN upd u ON c.conv_id = u.conv_id""")
def conversation_upsert(spark, sf):
    turns = table(spark, sf, "conversations")
    current = turns.where("role = 'user' AND turn >= 2").groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("turns"), F.min("text").alias("title")
    )
    updates = turns.where("role = 'assistant'").groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("turns"), F.max("text").alias("title")
    )
    return conversations.upsert(current, updates, "conv_id")


@query("""SELECT turn, role, md5(text) AS digest FROM conversations WHERE conv_id = 7 ORDER BY turn DESC""")
def history_newest_first(spark, sf):
    history = conversations.newest_first(table(spark, sf, "conversations"), "conv_id", 7, "turn")
    return history.select("turn", "role", F.md5("text").alias("digest"))


# ---------------------------------------------------------------- evaluation

_CASES_SQL = """cases AS (SELECT doc_id AS id, quality, toxic, n_chars, lang, source FROM labels LEFT JOIN documents USING (doc_id))"""


def cases(spark, sf):
    """Labels as expected values, with predictions from the document's form."""
    docs = table(spark, sf, "documents").drop("text")
    return evaluate.join_predictions(table(spark, sf, "labels"), docs, "doc_id")


def tool_columns(df):
    def tools(a, b):
        return F.array_compact(F.array(F.when(a, F.lit("search")), F.when(b, F.lit("advise"))))

    return df.withColumns(
        {
            "expected_tools": tools(F.col("quality") == 1, F.col("toxic") == 0),
            "selected_tools": tools(F.col("n_chars") > 1000, F.col("lang") != "de"),
        }
    )


@query(f"""WITH {_CASES_SQL}, r AS (SELECT (quality = 1) = (n_chars > 1000) AND (toxic = 0) = (lang <> 'de') AS ok FROM cases)
SELECT count(*) AS total, count(*) FILTER (ok) AS correct, round(100.0 * count(*) FILTER (ok) / count(*), 6) AS accuracy FROM r""")
def tool_accuracy(spark, sf):
    result = evaluate.tool_accuracy(tool_columns(cases(spark, sf)), "expected_tools", "selected_tools")
    return result.withColumn("accuracy", F.round("accuracy", 6))


_CONFUSION_SQL = f"""{_CASES_SQL},
c AS (SELECT count(*) FILTER (quality = 1 AND toxic = 0) AS tp, count(*) FILTER (quality = 0 AND toxic = 1) AS tn,
  count(*) FILTER (quality = 0 AND toxic <> 1) AS fp, count(*) FILTER (quality = 1 AND toxic <> 0) AS fn FROM cases),
m AS (SELECT *, (tp + tn) / (tp + tn + fp + fn) AS accuracy, coalesce(tp / nullif(tp + fp, 0), 0) AS precision_positive,
  coalesce(tp / nullif(tp + fn, 0), 0) AS recall_positive, coalesce(tn / nullif(tn + fn, 0), 0) AS precision_negative,
  coalesce(tn / nullif(tn + fp, 0), 0) AS recall_negative FROM c),
k AS (SELECT *, coalesce(2 * precision_positive * recall_positive / nullif(precision_positive + recall_positive, 0), 0) AS f1_positive,
  coalesce(2 * precision_negative * recall_negative / nullif(precision_negative + recall_negative, 0), 0) AS f1_negative FROM m)"""
_RATES = ["accuracy", "precision_positive", "recall_positive", "precision_negative", "recall_negative", "f1_positive", "f1_negative"]


# quality is expected, "not toxic" is the prediction
@query(f"WITH {_CONFUSION_SQL} SELECT tp, tn, fp, fn, {', '.join(f'round({r}, 6) AS {r}' for r in _RATES)} FROM k")
def confusion_metrics(spark, sf):
    predicted = cases(spark, sf).withColumn("predicted", 1 - F.col("toxic"))
    result = evaluate.confusion_metrics(predicted, "quality", "predicted", 1, 0)
    return result.withColumns({r: F.round(r, 6) for r in _RATES})


def param_columns(df):
    return df.withColumns(
        {
            "expected_params": F.struct(
                F.array("lang").alias("estate_type"), F.col("quality").alias("no_bedrooms"), F.col("source").alias("district"),
                F.lit(None).cast("double").alias("price"),
            ),
            "predicted_params": F.struct(
                F.array("lang").alias("estate_type"), F.col("toxic").alias("no_bedrooms"), F.col("source").alias("district"),
                F.when(F.col("n_chars") > 2000, F.lit(1.0)).alias("price"),
            ),
        }
    )


PARAM_FIELDS = ["estate_type", "no_bedrooms", "district", "price"]


@query(f"""WITH {_CASES_SQL}, r AS (SELECT quality IS NOT DISTINCT FROM toxic AND NOT coalesce(n_chars > 2000, false) AS ok FROM cases)
SELECT count(*) AS total, count(*) FILTER (ok) AS correct, round(avg(ok::INTEGER), 6) AS param_accuracy FROM r""")
def param_accuracy(spark, sf):
    result = evaluate.param_accuracy(param_columns(cases(spark, sf)), "expected_params", "predicted_params", PARAM_FIELDS)
    return result.withColumn("param_accuracy", F.round("param_accuracy", 6))


@query(f"""WITH {_CASES_SQL}, t AS (SELECT round(100.0 * avg(((quality = 1) = (n_chars > 1000) AND (toxic = 0) = (lang <> 'de'))::INTEGER), 6) AS v FROM cases),
p AS (SELECT round(avg((quality IS NOT DISTINCT FROM toxic AND NOT coalesce(n_chars > 2000, false))::INTEGER), 6) AS v FROM cases),
{_CONFUSION_SQL[len(_CASES_SQL) + 2:]}
SELECT 'tool_accuracy' AS metric, v AS value FROM t UNION ALL SELECT 'param_accuracy', v FROM p
{' '.join(f"UNION ALL SELECT '{r}', round({r}, 6) FROM k" for r in ['tp', 'tn', 'fp', 'fn', *_RATES])}""")
def evaluation_report(spark, sf):
    from listmill.plans.jobs import evaluation_report as report

    rows = param_columns(tool_columns(cases(spark, sf)))
    rows = rows.withColumns({"expected": F.col("quality"), "predicted": 1 - F.col("toxic")})
    return report(rows, 1, 0, PARAM_FIELDS).withColumn("value", F.round("value", 6))


@query(f"""WITH {LISTINGS_SQL}, r AS (SELECT district, price BETWEEN 250000 * 0.9 AND 250000 * 1.1 AS ok FROM listings)
SELECT district, count(*) AS n, round(avg(coalesce(ok, false)::INTEGER), 6) AS rate, avg(coalesce(ok, false)::INTEGER) >= 0.3 AS passed
FROM r GROUP BY district""")
def quality_gate(spark, sf):
    from listmill.functions.predicates import near

    meets = near(F.col("price"), F.lit(250000.0), 0.1)
    gate = evaluate.quality_gate(listings(spark, sf), "district", meets)
    return gate.withColumn("rate", F.round("rate", 6))


@query("""SELECT CAST(item_id AS VARCHAR) AS id, text AS question, false AS is_paraphrased, NULL AS original_id FROM benchmark
UNION ALL SELECT 'p' || item_id, lower(text), true, CAST(item_id AS VARCHAR) FROM benchmark""")
def extend_cases(spark, sf):
    items = table(spark, sf, "benchmark").withColumn("item_id", F.col("item_id").cast("string"))
    originals = items.select(F.col("item_id").alias("id"), F.col("text").alias("question"))
    paraphrases = items.select(
        F.concat(F.lit("p"), "item_id").alias("id"), F.lower("text").alias("question"), F.col("item_id").alias("original_id")
    )
    return evaluate.extend_cases(originals, paraphrases)
