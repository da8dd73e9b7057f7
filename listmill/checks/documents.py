"""Text vectors, near-duplicates, similar pairs, fuzzy match."""

from pyspark.sql import functions as F

from listmill.checks.registry import query
from listmill.checks.views import documents, table
from listmill.operators import lookback, search, similar
from listmill.session import settle

TOKENS_SQL = r"list_filter(regexp_split_to_array(lower({}), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '')"


def keep_first_sql(pairs: str, key: str = "doc_id", source: str = "documents") -> str:
    """Greedy keep-first over a relation ``pairs(later, earlier)``, row by row in key order."""
    return f"""near AS (SELECT later, list(earlier) AS e FROM ({pairs}) GROUP BY later),
o AS (SELECT row_number() OVER (ORDER BY {key}) AS i, {key} AS id, e FROM {source} LEFT JOIN near ON later = {key}),
rec AS (SELECT 0::BIGINT AS i, []::BIGINT[] AS kept UNION ALL
  SELECT r.i + 1, CASE WHEN o.e IS NULL OR NOT list_has_any(r.kept, o.e) THEN list_append(r.kept, o.id) ELSE r.kept END
  FROM rec r JOIN o ON o.i = r.i + 1),
kept AS (SELECT unnest(kept) AS id FROM rec WHERE i = (SELECT max(i) FROM o))"""


def _decision(df, key):
    return df.select(key, (F.col("kept_as") == F.col(key)).alias("kept"))


_TF_SQL = f"""tf AS (SELECT doc_id, w AS token, count(*) AS tf FROM
  (SELECT doc_id, unnest({TOKENS_SQL.format('text')}) AS w FROM documents) GROUP BY 1, 2),
dfs AS (SELECT token, count(*) AS df FROM tf GROUP BY token),
raww AS (SELECT doc_id, token, tf * (ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1) AS w FROM tf JOIN dfs USING (token)),
wt AS (SELECT doc_id, token, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS w FROM raww)"""


@query(f"WITH {_TF_SQL} SELECT token, df FROM dfs")
def document_frequency(spark, sf):
    return similar.document_frequency(documents(spark, sf), "text")


@query(f"""WITH {_TF_SQL} SELECT doc_id, count(*) AS n, round(sum(w), 6) AS total, round(max(w), 6) AS top FROM wt GROUP BY doc_id""")
def tfidf_weights(spark, sf):
    docs = documents(spark, sf)
    counts = similar.term_counts(docs, "doc_id", "text")
    weights = similar.weigh(counts, similar.fit_idf(docs, "text"), "doc_id")
    return weights.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("w"), 6).alias("total"), F.round(F.max("w"), 6).alias("top")
    )


_JACCARD_SQL = f"""post AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM
  (SELECT doc_id, list_distinct({TOKENS_SQL.format('text')}) AS s FROM documents))"""
_JACCARD_PAIRS = """SELECT a.doc_id AS later, b.doc_id AS earlier FROM post a JOIN post b ON a.t = b.t AND b.doc_id < a.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING count(*) / (a.n + b.n - count(*)) >= 0.7"""


@query(f"""WITH RECURSIVE {_JACCARD_SQL}, {keep_first_sql(_JACCARD_PAIRS)}
SELECT doc_id, doc_id IN (SELECT id FROM kept) AS kept FROM documents""")
def near_dup_jaccard_exact(spark, sf):
    return _decision(similar.near_duplicates_jaccard(documents(spark, sf), "doc_id", "text", 0.7), "doc_id")


@query()
def near_dup_lsh(spark, sf):
    decided = similar.near_duplicates_jaccard(documents(spark, sf), "doc_id", "text", 0.7, "minhash")
    return _decision(decided, "doc_id")


@query("SELECT true AS partners_alike, true AS recall_ok")
def near_dup_lsh_quality(spark, sf):
    """Every dropped row is like the row it was dropped for, and 95 of 100 rows that the exact form drops are dropped."""
    docs = documents(spark, sf)
    found = settle(similar.near_duplicates_jaccard(docs, "doc_id", "text", 0.7, "minhash").select("doc_id", "kept_as"))
    exact = similar.near_duplicates_jaccard(docs, "doc_id", "text", 0.7).where("kept_as <> doc_id").select("doc_id")
    words = F.array_distinct(F.filter(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"), lambda w: w != ""))
    sets = docs.select("doc_id", words.alias("w"))
    pairs = found.where("kept_as <> doc_id").join(sets, "doc_id").join(sets.withColumnsRenamed({"doc_id": "kept_as", "w": "k"}), "kept_as")
    common = F.size(F.array_intersect("w", "k"))
    alike = pairs.agg(F.coalesce(F.min(common >= 0.7 * (F.size("w") + F.size("k") - common)), F.lit(True)).alias("partners_alike"))
    met = exact.join(found.select("doc_id", (F.col("kept_as") != F.col("doc_id")).alias("dropped")), "doc_id")
    recall = met.agg(F.coalesce(F.count_if("dropped") >= 0.95 * F.count(F.lit(1)), F.lit(True)).alias("recall_ok"))
    return alike.crossJoin(recall)  # one row each


_COSINE_PAIRS = """SELECT later, earlier FROM (SELECT a.doc_id AS later, b.doc_id AS earlier, sum(a.w * b.w) AS c FROM wt a JOIN wt b
  ON a.token = b.token AND b.doc_id < a.doc_id GROUP BY 1, 2) JOIN documents x ON x.doc_id = later
  JOIN documents y ON y.doc_id = earlier WHERE c > 0.99 OR (c > 0.95 AND x.source = y.source)"""


@query(f"""WITH RECURSIVE {_TF_SQL}, {keep_first_sql(_COSINE_PAIRS)}
SELECT doc_id, doc_id IN (SELECT id FROM kept) AS kept FROM documents""")
def near_dup_removed(spark, sf):
    decided = similar.near_duplicates_listing(documents(spark, sf), "doc_id", "source", "text")
    return _decision(decided, "doc_id")


# Two further crawls of each vector: rounded finely, and rounded coarsely with the title of another group for odd labels.
_CRAWLS_SQL = """v AS (SELECT 3 * vec_id AS pos, label AS title, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  UNION ALL SELECT 3 * vec_id + 1, label, list_transform(embedding, lambda x: round(x::DOUBLE, 2)) FROM embeddings
  UNION ALL SELECT 3 * vec_id + 2, label + label % 2, list_transform(embedding, lambda x: round(x::DOUBLE, 1)) FROM embeddings)"""


@query(f"""WITH {_CRAWLS_SQL}, p AS (SELECT a.pos AS later, b.pos AS earlier, list_cosine_similarity(a.e, b.e) AS c,
  a.title = b.title AS one FROM v a JOIN v b ON a.pos > b.pos AND a.pos - b.pos <= 4000)
SELECT later, earlier, round(c, 6) AS cosine FROM p WHERE c > 0.99 OR (c > 0.95 AND one)""")
def cosine_pairs(spark, sf):
    pairs = lookback.similar_pairs(_crawls(spark, sf), "pos", "title", "e")
    return pairs.withColumn("cosine", F.round("cosine", 6))


def _crawls(spark, sf):
    vectors = table(spark, sf, "embeddings").withColumn("e", F.col("embedding").cast("array<double>"))
    crawls = F.array(
        F.struct((F.col("vec_id") * 3).alias("pos"), F.col("label").alias("title"), F.col("e")),
        F.struct(
            (F.col("vec_id") * 3 + 1).alias("pos"), F.col("label").alias("title"),
            F.transform("e", lambda x: F.round(x, 2)).alias("e"),
        ),
        F.struct(
            (F.col("vec_id") * 3 + 2).alias("pos"), (F.col("label") + F.col("label") % 2).alias("title"),
            F.transform("e", lambda x: F.round(x, 1)).alias("e"),
        ),
    )
    return vectors.select(F.explode(crawls).alias("c")).select("c.*")


# Each item against a list of the kept items before it, of 41 at most, whose oldest ten go when the next item comes.
_HELD = 40


@query(f"""WITH RECURSIVE {_CRAWLS_SQL}, o AS (SELECT row_number() OVER (ORDER BY pos) AS i, pos, title, e FROM v),
near AS MATERIALIZED (SELECT a.i, list(b.pos) AS like_ FROM o a JOIN o b ON b.i < a.i AND (list_cosine_similarity(a.e, b.e) > 0.99
  OR (list_cosine_similarity(a.e, b.e) > 0.95 AND a.title IS NOT DISTINCT FROM b.title)) GROUP BY a.i),
s AS MATERIALIZED (SELECT o.i, o.pos, coalesce(like_, []) AS like_ FROM o LEFT JOIN near USING (i)),
rec AS (SELECT 0::BIGINT AS i, NULL::BIGINT AS pos, false AS kept, []::BIGINT[] AS held UNION ALL
  SELECT i, pos, NOT list_has_any(old, like_), CASE WHEN list_has_any(old, like_) THEN old ELSE list_append(old, pos) END
  FROM (SELECT s.i, s.pos, s.like_, CASE WHEN len(held) > {_HELD} THEN held[{_HELD // 4 + 1}:] ELSE held END AS old
    FROM rec JOIN s ON s.i = rec.i + 1))
SELECT pos, kept FROM rec WHERE i > 0""")
def lookback_keep(spark, sf):
    """Items kept by comparison with a bounded list of kept items, its oldest quarter evicted."""
    return lookback.keep(_crawls(spark, sf), "pos", "title", "e", look_back=_HELD, block_rows=500)


@query("""WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings)
SELECT a.vec_id AS vec_id, round(list_cosine_similarity(a.e, b.e), 8) AS cosine FROM v a JOIN v b ON b.vec_id = a.vec_id - 1""")
def cosine_to_previous(spark, sf):
    """The vector similarity as a column expression, on neighbours in arrival order."""
    from listmill.functions.similarity import cosine

    rows = table(spark, sf, "embeddings").select("vec_id", "embedding")
    before = rows.select((F.col("vec_id") + 1).alias("vec_id"), F.col("embedding").alias("before"))
    joined = rows.join(before, "vec_id")
    return joined.select("vec_id", F.round(cosine(F.col("embedding"), F.col("before")), 8).alias("cosine"))


_QUERIES = [(1, "smal widgat"), (2, "rde"), (3, "coppor plate ng"), (4, "zzzzzz"), (5, "wigdet"), (6, "samll rde"), (7, "polihsde")]
_QUERIES_SQL = "VALUES " + ", ".join(f"({i}, '{q}')" for i, q in _QUERIES)


@query(f"""WITH q(query_id, query) AS ({_QUERIES_SQL}),
qt AS (SELECT query_id, unnest({TOKENS_SQL.format('query')}) AS q FROM q),
pt AS (SELECT p_partkey, unnest({TOKENS_SQL.format("p_name || ' ' || p_type")}) AS w FROM part)
SELECT DISTINCT query_id, p_partkey FROM qt JOIN pt ON damerau_levenshtein(w, q) <= CASE WHEN length(q) <= 2 THEN 0 WHEN length(q) <= 5 THEN 1 ELSE 2 END""")
def fuzzy_description(spark, sf):
    queries = spark.createDataFrame(_QUERIES, "query_id int, query string")
    parts = table(spark, sf, "part").withColumn("text", F.concat_ws(" ", "p_name", "p_type"))
    return search.fuzzy_match(parts, "text", queries, "query_id", "query", "p_partkey")
