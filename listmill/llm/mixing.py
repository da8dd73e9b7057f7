"""Sources mixed to target weights along a curriculum (operator 11).

Targets: the sources in code-point order, null last, take the weights in turn and share ``budget`` times all words by weight. No
target may be above ``most`` times its source's words; what is above is shared again among the others until none is above.

Curriculum: every source has a schedule, the piecewise linear density of its demand over training time 0 to 1. Its integral,
scaled to the target, is the number of words that the source has given by a time. The documents of a source stand in an order that
a digest fixes, pass after pass; the number of words before a document goes through the inverse of the integral, which is the
document's training position. Documents are sorted by ranges of position.

A source of any size is no task of its own: running sums go digit by digit of the digest, sixteen children under each parent, and
only a leaf with a bounded mean of rows is summed row by row. Equal rows are one row with a count until the end.

Defined results: null and empty texts have size 0, are taken 0 times and have no position; a null doc_id counts as an empty one in the
order; repeated rows take neighbouring places and are rows of their own; the last document of a source's demand is taken in part, so
that the taken words of a source are its target rounded to a whole number; an empty table, or one without words, takes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listmill.llm.sharding import numbered
from listmill.session import settle, small

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
MOST = 2
# Density of demand over training time as (time, density) points, given to the sources in turn: early, even, late.
SCHEDULES = (
    ((0.0, 1.5), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.25), (0.5, 0.5), (1.0, 2.0)),
)
# Mean rows of the largest source that one leaf of the digest holds.
LEAF_ROWS = 4096
_WORD = r"[^\x20\x09-\x0D]+"


def size_of(text: Column) -> Column:
    """The number of words of a text; none for null."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights=WEIGHTS, budget: float = BUDGET, most: int = MOST) -> DataFrame:
    """rank, source, source_size and target of each row of ``sources`` (source, source_size).

    A round asks for two sums over the sources: what those above their bound give, and what the others weigh. The level by
    which weights are multiplied only rises, so a source once above stays so, and the rounds end.
    """
    ranked = numbered(sources.withColumn("_none", F.col("source").isNull()), ["_none", "source"])
    ranked = ranked.withColumnRenamed("row_number", "rank")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = settle(ranked.select("rank", "source", "source_size", weight.alias("weight")))
    bound = F.lit(most) * F.col("source_size")
    wanted = budget * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    level, above = 0.0, -1
    while True:
        over = bound < F.col("weight") * level
        full, heavy, count = ranked.agg(
            F.coalesce(F.sum(F.when(over, bound)), F.lit(0)), F.sum(F.when(~over, F.col("weight"))), F.count_if(over)
        ).first()
        if count == above or heavy is None:
            break
        level, above = (wanted - full) / heavy, count
    # sources left without a share by their bound, all of them at the end, stop there
    share = bound.cast("double") if heavy is None else F.least(bound.cast("double"), F.col("weight") * level)
    return ranked.select("rank", "source", "source_size", share.alias("target"))


def _inverse(schedule, part: Column) -> Column:
    """The time by which a schedule has given ``part`` (0 to 1) of its whole demand."""
    areas = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(schedule, schedule[1:])]
    whole, before, out = sum(areas), 0.0, None
    y = part * F.lit(whole)
    pieces = []
    for (start, low), (end, high), area in zip(schedule, schedule[1:], areas):
        slope = (high - low) / (end - start)
        rest = y - F.lit(before)
        root = F.sqrt(F.greatest(F.lit(low * low) + F.lit(2 * slope) * rest, F.lit(0.0)))
        time = F.lit(start) + F.when(rest <= 0, F.lit(0.0)).otherwise(F.lit(2.0) * rest / (F.lit(low) + root))
        before += area
        pieces.append((before, F.least(time, F.lit(end))))
    out = pieces[-1][1]
    for until, time in reversed(pieces[:-1]):
        out = F.when(y < F.lit(until), time).otherwise(out)
    return out


def position(rank: Column, part: Column, schedules=SCHEDULES) -> Column:
    """The training time of a place in a source's demand, by the schedule of the source's rank."""
    out = _inverse(schedules[-1], part)
    for k, schedule in list(enumerate(schedules))[:-1]:
        out = F.when(rank % len(schedules) == k, _inverse(schedule, part)).otherwise(out)
    return out


def _before(rows: DataFrame, digits: int) -> DataFrame:
    """rank, the first ``digits`` digits of the digest, and the words of the source that stand before them."""
    level = F.lit(0).cast("long")
    known = None
    leaves = settle(rows.groupBy("rank", F.substring("_digest", 1, digits).alias("_leaf")).agg(F.sum(F.col("size") * F.col("_rows")).alias("_words")))
    for k in range(1, digits + 1):
        parent, child = F.substring("_leaf", 1, k - 1), F.substring("_leaf", 1, k)
        sums = leaves.groupBy("rank", parent.alias("_parent"), child.alias("_child")).agg(F.sum("_words").alias("_words"))
        inside = Window.partitionBy("rank", "_parent").orderBy("_child").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("_ahead", F.coalesce(F.sum("_words").over(inside), level))
        if known is not None:
            up = known.select("rank", F.col("_child").alias("_parent"), F.col("_start"))
            sums = sums.join(up, ["rank", "_parent"]).withColumn("_ahead", F.col("_ahead") + F.col("_start")).drop("_start")
        known = sums.select("rank", "_child", F.col("_ahead").alias("_start"))
    return known.withColumnRenamed("_child", "_leaf")


def mix(
    docs: DataFrame,
    weights=WEIGHTS,
    budget: float = BUDGET,
    most: int = MOST,
    schedules=SCHEDULES,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per document: doc_id, source, ``keep``, size, source_size, target, taken, and for each pass its words and position.

    ``passes`` holds (words, position) of the passes that take words of the document, at most ``most`` of them. Only narrow columns
    are shuffled; ``keep`` names others to carry along, the text for example.
    """
    carried = [F.col(c).alias(f"_keep_{k}") for k, c in enumerate(keep)]
    sized = docs.select("doc_id", "source", size_of(F.col("text")).alias("size"), *carried)
    digest = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("size").cast("string")).cast("binary"))
    kept = [f"_keep_{k}" for k in range(len(keep))]
    rows = sized.withColumn("_digest", digest).groupBy("source", "doc_id", "size", "_digest", *kept).agg(F.count(F.lit(1)).alias("_rows"))
    rows = settle(rows)
    sources = settle(rows.groupBy("source").agg(F.sum(F.col("size") * F.col("_rows")).alias("source_size"), F.count(F.lit(1)).alias("_n")))
    largest = sources.agg(F.max("_n")).first()[0] or 0
    digits = 1
    while largest > LEAF_ROWS * 16**digits:
        digits += 1
    told = targets(sources.drop("_n"), weights, budget, most).withColumnRenamed("source", "_source")
    rows = rows.join(small(told), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    rows = rows.withColumn("_leaf", F.substring("_digest", 1, digits))
    rows = rows.join(_before(rows, digits), ["rank", "_leaf"])
    inside = Window.partitionBy("rank", "_leaf").orderBy("_digest", "size", "doc_id", *kept)
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    words = F.col("size") * F.col("_rows")
    rows = rows.withColumn("_at", F.col("_start") + F.coalesce(F.sum(words).over(inside), F.lit(0)))
    rows = rows.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_rows") - 1)))
    rows = rows.withColumn("_at", F.col("_at") + F.col("_copy") * F.col("size"))
    quota = F.floor(F.col("target") + 0.5).cast("long")
    passes = []
    for k in range(most):
        start = F.lit(k) * F.col("source_size") + F.col("_at")
        given = F.greatest(F.least(quota - start, F.col("size")), F.lit(0).cast("long"))
        time = position(F.col("rank"), start.cast("double") / quota.cast("double"), schedules)
        passes.append(F.when(given > 0, F.struct(given.alias("words"), time.alias("position"))))
    rows = rows.withColumn("passes", F.filter(F.array(*passes), lambda p: p.isNotNull()))
    taken = F.aggregate("passes", F.lit(0).cast("long"), lambda total, p: total + p["words"])
    return rows.select(
        "doc_id", "source", *(F.col(f"_keep_{k}").alias(c) for k, c in enumerate(keep)), "size", "source_size", "target",
        taken.alias("taken"), "passes",
    )


def training_order(docs: DataFrame, **settings) -> DataFrame:
    """The documents as they are to be read in training: text, pass, words taken and position, sorted by ranges of position."""
    mixed = mix(docs, keep=("text",), **settings)
    shown = mixed.select("doc_id", "source", "text", F.posexplode("passes").alias("pass", "_p"))
    shown = shown.select("doc_id", "source", "text", "pass", F.col("_p.words").alias("words"), F.col("_p.position").alias("position"))
    return shown.orderBy("position", "source", "doc_id", "pass")


def report(docs: DataFrame, **settings) -> DataFrame:
    """doc_id, source, sizes, target, taken, and the positions of the first and the second pass, sorted by ranges of position."""
    first, second = F.get("passes", F.lit(0)), F.get("passes", F.lit(1))
    return mix(docs, **settings).select(
        "doc_id", "source", "size", "source_size", "target", "taken",
        first["position"].alias("position"), second["position"].alias("second_position"),
    ).orderBy(F.col("position").asc_nulls_last(), "source", "doc_id")


def _sql_inverse(schedule, part: str) -> str:
    areas = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(schedule, schedule[1:])]
    whole, before, cases = sum(areas), 0.0, []
    for (start, low), (end, high), area in zip(schedule, schedule[1:], areas):
        slope = (high - low) / (end - start)
        rest = f"({part} * {whole!r}::DOUBLE - {before!r}::DOUBLE)"
        time = (
            f"least({start!r}::DOUBLE + CASE WHEN {rest} <= 0 THEN 0 ELSE 2 * {rest} / ({low!r}::DOUBLE"
            f" + sqrt(greatest({low * low!r}::DOUBLE + {2 * slope!r}::DOUBLE * {rest}, 0))) END, {end!r}::DOUBLE)"
        )
        before += area
        cases.append((before, time))
    out = cases[-1][1]
    for until, time in reversed(cases[:-1]):
        out = f"CASE WHEN {part} * {whole!r}::DOUBLE < {until!r}::DOUBLE THEN {time} ELSE {out} END"
    return out


def _sql_position(part: str) -> str:
    cases = " ".join(f"WHEN {k} THEN {_sql_inverse(s, part)}" for k, s in enumerate(SCHEDULES))
    return f"CASE rank % {len(SCHEDULES)} {cases} END"


SQL = rf"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS rank
    FROM sized GROUP BY source
), weighed AS (
    SELECT *, CASE rank % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END::DOUBLE AS weight FROM sources
), levels AS (
    -- sources by the level at which they reach their bound; those before have reached it
    SELECT *, ({BUDGET}::DOUBLE * sum(source_size) OVER ()
               - coalesce(sum({MOST} * source_size) OVER (ORDER BY {MOST} * source_size / weight, rank
                                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
              / sum(weight) OVER (ORDER BY {MOST} * source_size / weight, rank
                                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM weighed
), told AS (
    SELECT source, rank, source_size, least({MOST} * source_size::DOUBLE, weight * (
        SELECT max(level) FROM levels WHERE {MOST} * source_size / weight >= level)) AS target
    FROM weighed
), placed AS (
    SELECT d.*, rank, source_size, target, floor(target + 0.5)::BIGINT AS quota,
        coalesce(sum(size) OVER (PARTITION BY rank ORDER BY md5(coalesce(doc_id::VARCHAR, '') || ':' || size::VARCHAR), size, doc_id
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead
    FROM sized d JOIN told t ON d.source IS NOT DISTINCT FROM t.source
), passes AS (
    SELECT *, greatest(least(quota - ahead, size), 0)::BIGINT AS one, greatest(least(quota - source_size - ahead, size), 0)::BIGINT AS two
    FROM placed
), timed AS (
    SELECT *, ahead::DOUBLE / quota AS part_one, (source_size + ahead)::DOUBLE / quota AS part_two FROM passes
)
SELECT doc_id, source, size, source_size, target, (one + two)::BIGINT AS taken,
    CASE WHEN one > 0 THEN {_sql_position('part_one')} END AS position,
    CASE WHEN two > 0 THEN {_sql_position('part_two')} END AS second_position
FROM timed
"""
