r"""Benchmark decontamination by template windows (operator 9), in DataFrame functions only.

Texts become templates: numbers, units after a number, and names (up to four capitalised words) turn into typed placeholders, all else is
lower-cased words. Windows of eight template tokens are hashed, and the hashes of documents are joined with those of the
benchmark. A document holds an item when it has half of the item's distinct windows, or a long run's worth of them, in one alignment,
and the values behind placeholders agree there: one value of the item stands for one value in the document. If they do not,
only the windows without placeholders count.

Forms: as a capital may be a name or begin a sentence, every text is taken with names as words (0), with capitalised words inside a
sentence as names (1), and with all capitalised words as names (2), on both sides. Windows with fewer literal words than half their
length are no templates, as lists of numbers would meet each other. Items that have such windows, or are too short for a template,
are also looked for as they stand (3), by windows of their literal values. An item found in any form counts.

Alignments: a matching window stands at a place of the document and at the place of the item where it first occurs; all places are kept.
The windows at one distance between the two, those at distances of the same stretch of 64, and all of a document are judged apart,
each window by its first place there, so a sibling with other values elsewhere in the document spoils nothing.

Only the benchmark's windows meet the documents' windows. They are counted first: few are sent to all tasks, many are
shuffled by their hash.

Defined results: null or empty texts hold nothing; a document without an id is not looked at, an item without an id neither; items
of five to seven tokens have windows of five, shorter ones are a single literal window, and items of one or two tokens are found only
where they are the whole document; items with equal templates and equally repeated values are one template and are all reported;
documents that share an id are looked at one by one and reported once; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listmill.session import settle, small

WINDOW, SHORT, ALONE = 8, 5, 2
SHARE, RUN = 0.5, 13
# Distances between places in document and item that are looked at together.
STRETCH = 64
PLAIN, INSIDE, CAPITAL, LITERAL = range(4)
# Windows of the benchmark that are sent to every task at most, 40 bytes each; more are shuffled.
BROADCAST_WINDOWS = 500_000
# Bytes of the places of slots in documents that are sent to every task at most; more are shuffled beside the texts they are in.
BROADCAST_SPOTS = 16 << 20

# Words that are units when they follow a number.
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms pound pounds ounce ounces "
    "ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month months "
    "year years dollar dollars cent cents euro euros percent degree degrees meter meters metre metres mph kmh watt watts"
).split()

# A capitalised word after a letter, digit, comma or semicolon and one blank, or anywhere, with up to three more such words.
NAME = {
    INSIDE: r"([\p{L}\p{N},;] )(\p{Lu}\p{L}+)((?: \p{Lu}\p{L}+){0,3})",
    CAPITAL: r"(^|[^\p{L}\p{N}])(\p{Lu}\p{L}+)((?: \p{Lu}\p{L}+){0,3})",
}
TOKEN = r"0name\p{L}+|[0-9][0-9.,]*|[\p{L}\p{N}]+"


def tokens(text: Column, form: Column) -> Column:
    """Tokens with their values; names are marked in the forms that have them."""
    marked = text
    for number, pattern in NAME.items():
        marked = F.when(form == number, F.regexp_replace(text, pattern, "$1 0name$2 ")).otherwise(marked)
    return F.regexp_extract_all(F.lower(marked), F.lit(TOKEN), F.lit(0))


def _number(token: Column) -> Column:
    return F.substring(token, 1, 1).between("0", "9") & ~token.startswith("0name")


def template(values: Column) -> Column:
    """Tokens with placeholders for values."""

    def one(token: Column, at: Column) -> Column:
        before = F.get(values, at - 1)
        unit = token.isin(UNITS) & (at > 0) & _number(before)
        return (
            F.when(token.startswith("0name"), "0name")
            .when(_number(token), "0num")
            .when(unit, "0unit")
            .otherwise(token)
        )

    return F.transform(values, one)


def is_slot(token: Column) -> Column:
    return token.isin("0name", "0num", "0unit")


def window_hashes(df: DataFrame, width: int | list[int], words: str = "words", name: str = "hashes") -> DataFrame:
    """``df`` with the hashes of all windows of ``width`` tokens as an array; empty if there are fewer tokens.

    Windows of 1, 2, 4, ... tokens are columns of their own, so that each is computed once; the widths are put together from them.
    With several widths the columns are called by name and width.
    """

    def joined(a: str, b: str, shift: int) -> Column:
        return F.zip_with(a, F.slice(b, shift + 1, F.greatest(F.size(b) - shift, F.lit(0))), lambda x, y: F.xxhash64(x, y))

    widths = [width] if isinstance(width, int) else width
    df, done = df.withColumn("_w1", F.transform(words, lambda w: F.xxhash64(w))), 1
    while done * 2 <= max(widths):
        df = df.withColumn(f"_w{done * 2}", joined(f"_w{done}", f"_w{done}", done))
        done *= 2
    for n in widths:
        total, have, power = None, 0, 1
        while power <= n:
            if n & power:
                column = f"_t{n}_{power}"
                df = df.withColumn(column, F.col(f"_w{power}") if total is None else joined(total, f"_w{power}", have))
                total, have = column, have + power
            power *= 2
        cut = F.slice(total, 1, F.greatest(F.size(words) - (n - 1), F.lit(0)))
        df = df.withColumn(name if isinstance(width, int) else f"{name}{n}", cut)
    return df.drop(*(c for c in df.columns if c.startswith(("_w", "_t"))))


def forms(df: DataFrame, key: str, text: str, every: bool, literal: Column | None = None, sought=tuple(NAME)) -> DataFrame:
    """id, part (a hash of the text), form, values (tokens), words (template).

    A text has the forms of ``sought`` where it has such names, or all with ``every``, and the literal one where ``literal`` holds.
    """
    rows = df.filter(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).alias("id"), F.col(text).alias("text"))
    rows = rows.withColumns({"part": F.xxhash64("text"), "digits": F.col("text").rlike("[0-9]")})
    named = [F.lit(True) if every else F.col("text").rlike(p) if n in sought else None for n, p in NAME.items()]
    has = [F.lit(True), *named, F.lit(True) if every else literal]
    taken = F.array_compact(F.array(*(F.when(h, n) for n, h in enumerate(has) if h is not None)))
    rows = rows.withColumn("form", F.explode_outer(taken))
    rows = rows.select("id", "part", "form", "digits", tokens(F.col("text"), F.col("form")).alias("values"))
    # without digits only names are placeholders, without names no token is
    named = F.transform("values", lambda token: F.when(token.startswith("0name"), "0name").otherwise(token))
    numbered = F.col("digits") & (F.col("form") != LITERAL)
    words = F.when(numbered, template(F.col("values"))).when(F.col("form").isin(*NAME), named).otherwise(F.col("values"))
    return rows.withColumn("words", words)


def _width(size: Column, form: Column) -> Column:
    """The width of an item's windows; none for an item that is too short for its form."""
    short = F.when(form == LITERAL, size).when(size >= SHORT, F.lit(SHORT))
    return F.when(size >= WINDOW, F.lit(WINDOW)).when((form == LITERAL) & (size >= SHORT), F.lit(SHORT)).otherwise(short)


def _labels(kinds: Column, values: Column) -> Column:
    """Placeholders with their values, which a closing point or comma is no part of."""
    return F.zip_with(kinds, values, lambda k, v: F.concat_ws(":", k, F.rtrim(v, F.lit(".,"))))


def benchmark_windows(benchmark: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Windows and members of the benchmark's templates.

    windows: rep (a template's number), form, width, alone, hash, place (first), values and kinds of the window, slots (placeholders
    in it), n_windows and n_literal (of the template); members: rep and the id of each item that is this template. Items are
    one template when their words are equal and the same values of theirs are equal, so that what agrees with one agrees with all.
    """
    rows = forms(benchmark, key, text, every=True).withColumn("width", _width(F.size("words"), F.col("form")))
    rows = rows.filter(F.col("width") > 0)
    label = _labels(F.col("words"), F.col("values"))
    pattern = F.transform(label, lambda x: F.when(is_slot(F.split_part(x, F.lit(":"), F.lit(1))), F.array_position(label, x)).otherwise(F.lit(0)))
    # without a name a form with names is the plain form again
    rows = rows.filter(~F.col("form").isin(*NAME) | F.array_contains("words", "0name"))
    grouped = rows.withColumn("pattern", pattern).groupBy("form", "width", "words", "pattern")
    # items of one template are many, but the benchmark is a stated set
    grouped = grouped.agg(F.min(F.struct("id", "values")).alias("s"), F.collect_set("id").alias("ids"))
    grouped = settle(grouped.select("form", "width", "words", "s.values", "ids").withColumn("rep", F.monotonically_increasing_id()))
    starts = F.sequence(F.lit(1), F.size("words") - F.col("width") + 1)
    places = grouped.select("rep", "form", "width", "words", "values", F.explode(starts).alias("start"))
    cut = {"kinds": F.slice("words", F.col("start"), F.col("width")), "values": F.slice("values", F.col("start"), F.col("width"))}
    places = places.withColumns(cut).withColumn("slots", F.when(F.col("form") == LITERAL, 0).otherwise(F.size(F.filter("kinds", is_slot))))
    # the same mixing of word hashes as in documents, window by window
    sound = 2 * (F.col("width") - F.col("slots")) >= F.col("width")
    hashed = None
    for r in places.select("width").distinct().collect():  # widths up to eight
        part = window_hashes(places.filter(F.col("width") == r["width"]), r["width"], "kinds", "hashes")
        part = part.withColumn("hash", F.element_at("hashes", 1)).drop("hashes", "words")
        hashed = part if hashed is None else hashed.unionByName(part)
    empty = benchmark.sparkSession.createDataFrame
    members = grouped.select("rep", "form", F.explode("ids").alias("item"))
    if hashed is None:
        return empty([], _WINDOWS), members.select("rep", "item")
    places = settle(hashed.withColumn("sound", sound))
    # as it stands, an item is looked for only where a window of its plain form is no template, or it has no plain form
    plain = members.filter(F.col("form") == PLAIN).join(places.groupBy("rep").agg(F.min("sound").alias("sound")), "rep")
    whole = plain.groupBy("item").agg(F.min("sound").alias("sound")).filter("sound").select("item")
    kept = members.filter(F.col("form") == LITERAL).join(whole, "item", "left_anti").select("rep").distinct()
    used = places.filter("sound").filter(F.col("form") != LITERAL).unionByName(places.filter(F.col("form") == LITERAL).join(kept, "rep", "left_semi"))
    first = used.groupBy("rep", "form", "width", "hash").agg(F.min(F.struct((F.col("start") - 1).alias("place"), "values", "kinds", "slots")).alias("s"))
    first = settle(first.select("rep", "form", "width", "hash", "s.*"))
    sizes = first.groupBy("rep").agg(F.count(F.lit(1)).alias("n_windows"), F.count_if(F.col("slots") == 0).alias("n_literal"))
    windows = first.join(sizes, "rep").withColumn("alone", F.col("width") <= ALONE)
    return settle(windows), settle(members.select("rep", "item"))


_WINDOWS = (
    "rep long, form int, width int, hash long, place int, values array<string>, kinds array<string>, slots int, n_windows long, n_literal long,"
    " alone boolean"
)


def _literal(windows: DataFrame) -> Column | None:
    """Which documents are also taken as they stand: those with digits, or all where a literal window has none."""
    literal = windows.filter(F.col("form") == LITERAL)
    plain = ~F.exists("kinds", lambda k: k.rlike("^[0-9]"))
    n, without = literal.agg(F.count(F.lit(1)), F.count_if(plain)).first()
    return None if not n else F.lit(True) if without else F.col("digits")


def _met(docs: DataFrame, windows: DataFrame, key: str, text: str, literal: Column | None) -> DataFrame:
    """id, part, form, rep, place and the place in the document (at) of every window that a document and a template both have."""
    shapes = {}
    for r in windows.select("width", "form").distinct().collect():  # a few widths and four forms
        shapes.setdefault(r["width"], []).append(r["form"])
    few = windows.count() <= BROADCAST_WINDOWS
    sought = {f for found in shapes.values() for f in found}
    rows = forms(docs, key, text, every=False, literal=literal, sought=sought).select("id", "part", "form", "words", F.size("words").alias("size"))

    def placed(width: int) -> Column:
        found = F.transform(f"_h{width}", lambda h, i: F.struct(F.lit(width).alias("width"), h.alias("hash"), i.cast("int").alias("at")))
        return F.when(F.col("form").isin(*shapes[width]), found)

    if shapes:
        rows = window_hashes(rows, sorted(shapes), name="_h")
    # outer, so that no filter inferred from the join computes the windows anew
    every = F.flatten(F.array_compact(F.array(*(placed(w) for w in shapes)))) if shapes else F.array()
    if not shapes:
        return docs.sparkSession.createDataFrame([], f"id {docs.schema[key].dataType.simpleString()}, part long, form int, rep long, place int, at int")
    own = rows.select("id", "part", "form", "size", F.explode_outer(every).alias("w"))
    own = own.select("id", "part", "form", "size", "w.width", "w.hash", "w.at")
    sought = windows.select("rep", "form", "width", "hash", "place", "alone")
    found = own.join(F.broadcast(sought) if few else sought, ["form", "width", "hash"])
    found = found.filter(~F.col("alone") | (F.col("size") == F.col("width")))
    return found.select("id", "part", "form", "rep", "place", "at").distinct()


_ONE = ["id", "part", "form", "rep", "kind", "near"]


def contaminated(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", item: str = "item_id", text: str = "text",
    share: float = SHARE, run: int = RUN,
) -> DataFrame:
    """key, item, n_matched, n_windows, share and consistent for every document that holds an item, and its best form."""
    windows, members = benchmark_windows(benchmark, item, text)
    literal = _literal(windows)
    met = settle(_met(docs, windows, key, text, literal))
    apart = F.col("at") - F.col("place")
    way = lambda kind, near: F.struct(F.lit(kind).alias("kind"), near.cast("long").alias("near"))
    ways = F.array(
        way(0, apart), way(1, F.floor(apart / STRETCH)), way(2, F.floor((apart + STRETCH // 2) / STRETCH)), way(3, F.lit(0))
    )
    joined = met.withColumn("way", F.explode(ways)).select("id", "part", "form", "rep", "way.*", "place", "at")
    joined = joined.groupBy(*_ONE, "place").agg(F.min("at").alias("at"))
    joined = joined.join(small(windows.select("rep", "place", "slots", "n_windows", "n_literal")), ["rep", "place"])
    held = joined.groupBy(*_ONE).agg(
        F.count(F.lit(1)).alias("n_matched"), F.count_if(F.col("slots") == 0).alias("literal"),
        F.first("n_windows").alias("n_windows"), F.first("n_literal").alias("n_literal"), F.max("slots").alias("slots"),
    )
    enough = (F.col("n_matched") >= share * F.col("n_windows")) | (F.col("n_matched") >= run)
    held = settle(held.filter(enough))

    # the values of the slots, only for documents that meet a template in a window with slots
    slotted = joined.filter("slots > 0").select(*_ONE, "place", "at").join(held.filter("slots > 0").select(*_ONE), _ONE, "left_semi")
    label = lambda kind, value: F.concat_ws(":", kind, F.rtrim(value, F.lit(".,")))
    asked = F.zip_with("kinds", "values", lambda k, v: F.struct(is_slot(k).alias("slot"), label(k, v).alias("theirs")))
    asked = F.transform(asked, lambda x, i: F.struct(i.alias("ahead"), x["slot"].alias("slot"), x["theirs"].alias("theirs")))
    asked = windows.filter("slots > 0").select("rep", "place", F.filter(asked, lambda x: x["slot"]).alias("asked"))
    slots = slotted.join(small(asked), ["rep", "place"]).select(*_ONE, "at", F.inline("asked"))
    # windows overlap, and so do alignments: each slot of a document once, and each place in a text once for all of its slots
    slots = settle(slots.select(*_ONE, (F.col("at") + F.col("ahead")).cast("int").alias("spot"), "theirs").distinct())
    spots = settle(slots.groupBy("id", "part", "form").agg(F.collect_set("spot").alias("spots")))
    # few ids, counted, are sent to all tasks, so that no text is shuffled
    ids = small(spots.select("id").distinct().withColumnRenamed("id", key))
    again = forms(docs.select(key, text).join(ids, key, "left_semi"), key, text, every=False).select("id", "part", "form", "values")
    few = (spots.agg(F.sum(F.size("spots") * 4 + 64)).first()[0] or 0) <= BROADCAST_SPOTS
    seen = again.join(F.broadcast(spots) if few else spots, ["id", "part", "form"])
    mine = F.transform("spots", lambda at: F.struct(at.alias("spot"), F.rtrim(F.get("values", at), F.lit(".,")).alias("mine")))
    slots = slots.join(seen.select("id", "part", "form", F.inline(mine)), ["id", "part", "form", "spot"])
    # more than one value behind one value of the item
    split = slots.groupBy(*_ONE, "theirs").agg((F.min("mine") != F.max("mine")).alias("split"))
    split = split.groupBy(*_ONE).agg(F.max("split").alias("split"))

    held = held.join(split, _ONE, "left").withColumn("consistent", ~F.coalesce("split", F.lit(False)))
    held = held.withColumns({
        "n_matched": F.when(F.col("consistent"), F.col("n_matched")).otherwise(F.col("literal")),
        "n_windows": F.when(F.col("consistent"), F.col("n_windows")).otherwise(F.col("n_literal")),
    })
    held = held.filter((F.col("n_matched") > 0) & enough)
    held = held.withColumn("share", F.col("n_matched") / F.col("n_windows"))
    best = F.max(F.struct("share", "n_matched", "n_windows", "consistent")).alias("best")
    # the best alignment of a template first, so that its members meet one row
    held = held.groupBy("id", "rep").agg(best).join(small(members), "rep")
    return held.groupBy("id", "item").agg(F.max("best").alias("best")).select(
        F.col("id").alias(key), F.col("item").alias(item), "best.n_matched", "best.n_windows", "best.share", "best.consistent"
    )


def clean(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that hold no item, with all their columns."""
    found = settle(contaminated(docs, benchmark, key, text=text).select(key).distinct())
    return docs.join(small(found), key, "left_anti").select(docs.columns)


# ---------------------------------------------------------------- the same in SQL

_INSIDE_SQL, _CAPITAL_SQL = NAME[INSIDE], NAME[CAPITAL]


def _sql_forms(name: str, table: str, key: str, literal: str) -> str:
    """Values and words of all forms; those of documents without names are left out, which changes nothing but the time."""
    units = "[" + ", ".join(f"'{u}'" for u in UNITS) + "]"
    return rf"""{name}_text AS (SELECT {key} AS id, text, form, CASE form WHEN {INSIDE} THEN regexp_replace(text, '{_INSIDE_SQL}', '\1 0name\2 ', 'g')
    WHEN {CAPITAL} THEN regexp_replace(text, '{_CAPITAL_SQL}', '\1 0name\2 ', 'g') ELSE text END AS t
  FROM {table}, (VALUES ({PLAIN}), ({INSIDE}), ({CAPITAL}), ({LITERAL})) f(form)
  WHERE {key} IS NOT NULL AND text IS NOT NULL AND (form <> {LITERAL} OR {literal})),
{name}_values AS (SELECT id, text, form, regexp_extract_all(lower(t), '{TOKEN}') AS v FROM {name}_text),
{name}_words AS (SELECT id, text, form, v, CASE WHEN form = {LITERAL} THEN v ELSE list_transform(range(1, len(v) + 1), lambda i: CASE
    WHEN starts_with(v[i], '0name') THEN '0name'
    WHEN regexp_matches(v[i], '^[0-9]') THEN '0num'
    WHEN i > 1 AND regexp_matches(v[i - 1], '^[0-9]') AND NOT starts_with(v[i - 1], '0name') AND list_contains({units}, v[i]) THEN '0unit'
    ELSE v[i] END) END AS w FROM {name}_values)"""


_SLOTS_SQL = "('0name', '0num', '0unit')"
_SIZED_SQL = f"""CASE WHEN len(w) >= {WINDOW} THEN {WINDOW} WHEN len(w) >= {SHORT} THEN {SHORT} WHEN form = {LITERAL} THEN len(w) ELSE 0 END"""
_SQL_WINDOWS = """SELECT r, id, form, n, {width} AS width, place, list(t) OVER f{width} AS x, list(y) OVER f{width} AS v FROM d_tokens
  WINDOW f{width} AS (PARTITION BY r, form ORDER BY place ROWS BETWEEN CURRENT ROW AND {ahead} FOLLOWING)"""

SQL = rf"""WITH {_sql_forms("b", "benchmark", "item_id", "true")},
labelled AS (SELECT *, {_SIZED_SQL} AS width, list_transform(range(1, len(w) + 1), lambda i: w[i] || ':' || rtrim(v[i], '.,')) AS lab FROM b_words),
reps AS MATERIALIZED (SELECT *, row_number() OVER () AS rep FROM (SELECT form, width, w, arg_min(v, id) AS v, list(DISTINCT id) AS ids
  FROM (SELECT *, list_transform(range(1, len(w) + 1), lambda i: CASE WHEN w[i] IN {_SLOTS_SQL} AND form <> {LITERAL} THEN list_position(lab, lab[i]) ELSE 0 END)
    AS pattern FROM labelled WHERE width > 0 AND (form IN ({PLAIN}, {LITERAL}) OR list_contains(w, '0name'))) GROUP BY form, width, w, pattern)),
places AS (SELECT rep, form, width, s.* FROM (SELECT rep, form, width, unnest(list_transform(range(1, len(w) - width + 2),
  lambda p: {{'place': p, 'x': w[p:p + width - 1], 'v': v[p:p + width - 1]}})) AS s FROM reps)),
slots AS MATERIALIZED (SELECT *, CASE WHEN form = {LITERAL} THEN 0 ELSE len(list_filter(x, lambda t: t IN {_SLOTS_SQL})) END AS slots FROM places),
members AS MATERIALIZED (SELECT rep, form, unnest(ids) AS item FROM reps),
whole AS (SELECT item FROM members JOIN slots USING (rep) WHERE members.form = {PLAIN} GROUP BY item HAVING bool_and(2 * (width - slots) >= width)),
used AS (SELECT * FROM slots WHERE CASE WHEN form = {LITERAL} THEN rep IN (SELECT rep FROM members WHERE form = {LITERAL} AND item NOT IN (SELECT item FROM whole))
  ELSE 2 * (width - slots) >= width END),
wins AS MATERIALIZED (SELECT rep, form, width, x, min(place) AS place, arg_min(v, place) AS v, any_value(slots) AS slots FROM used GROUP BY rep, form, width, x),
sizes AS MATERIALIZED (SELECT rep, count(*) AS n_windows, count(*) FILTER (slots = 0) AS n_literal FROM wins GROUP BY rep),
{_sql_forms("d", "documents", "doc_id", f"EXISTS (SELECT 1 FROM wins w WHERE w.form = {LITERAL})")},
d_rows AS (SELECT *, row_number() OVER () AS q, dense_rank() OVER (ORDER BY id, text) AS r FROM (SELECT DISTINCT * FROM d_words)),
d_tokens AS (SELECT r, id, form, len(w) AS n, unnest(w) AS t, unnest(v) AS y, unnest(range(1, len(w) + 1)) AS place FROM d_rows),
d_places AS ({" UNION ALL ".join(_SQL_WINDOWS.format(width=w, ahead=w - 1) for w in (1, 2, 3, 4, SHORT, WINDOW))}),
found AS MATERIALIZED (SELECT r, d.id, d.form, rep, wins.place, d.place AS spot, d.v AS mine, wins.v AS theirs, wins.x, slots, d.width
  FROM d_places d JOIN wins ON d.form = wins.form AND d.width = wins.width AND d.x = wins.x
  WHERE d.width > {ALONE} OR d.n = d.width),
ways AS (SELECT *, unnest([{{'kind': 0, 'near': spot - place}}, {{'kind': 1, 'near': floor((spot - place) / {STRETCH})::BIGINT}},
  {{'kind': 2, 'near': floor((spot - place + {STRETCH // 2}) / {STRETCH})::BIGINT}}, {{'kind': 3, 'near': 0}}]) AS way FROM found),
met AS MATERIALIZED (SELECT r, id, form, rep, way, place, arg_min(mine, spot) AS mine, any_value(theirs) AS theirs, any_value(x) AS x, any_value(slots) AS slots,
  any_value(width) AS width FROM ways GROUP BY r, id, form, rep, way, place),
held AS (SELECT r, id, form, rep, way, count(*) AS n_matched, count(*) FILTER (slots = 0) AS literal FROM met GROUP BY r, id, form, rep, way),
pairs AS (SELECT r, form, rep, way, x[k] || ':' || rtrim(theirs[k], '.,') AS theirs, rtrim(mine[k], '.,') AS mine
  FROM (SELECT *, unnest(range(1, width + 1)) AS k FROM met WHERE slots > 0) WHERE x[k] IN {_SLOTS_SQL}),
split AS (SELECT DISTINCT r, form, rep, way FROM (SELECT r, form, rep, way, theirs FROM pairs GROUP BY ALL HAVING min(mine) <> max(mine))),
judged AS (SELECT h.id, h.rep, s.r IS NULL AS consistent,
    CASE WHEN s.r IS NULL THEN h.n_matched ELSE h.literal END AS n_matched,
    CASE WHEN s.r IS NULL THEN z.n_windows ELSE z.n_literal END AS n_windows
  FROM held h JOIN sizes z USING (rep) LEFT JOIN split s ON s.r = h.r AND s.form = h.form AND s.rep = h.rep AND s.way = h.way
  WHERE h.n_matched >= {SHARE}e0 * z.n_windows OR h.n_matched >= {RUN}),
best AS (SELECT id, item, max(row(n_matched / n_windows, n_matched, n_windows, consistent)) AS b
  FROM judged JOIN members USING (rep) WHERE n_matched > 0 AND (n_matched >= {SHARE}e0 * n_windows OR n_matched >= {RUN}) GROUP BY id, item)
SELECT id AS doc_id, item AS item_id, b[2] AS n_matched, b[3] AS n_windows, b[1] AS share, b[4] AS consistent FROM best"""
