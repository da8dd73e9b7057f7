"""The free-form attribute map of a listing, read into typed columns."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listmill import fixed
from listmill.functions.fields import extract_number
from listmill.functions.text import let, strip

_WHOLE = ("no_bedrooms", "no_bathrooms", "no_floors", "yo_construction")


def first_key(extras: Column, keys: list[str]) -> Column:
    """Value of the first of ``keys`` that the map holds."""
    found = F.when(F.map_contains_key(extras, keys[0]), extras[keys[0]])
    for key in keys[1:]:
        found = found.when(F.map_contains_key(extras, key), extras[key])
    return found


def _clean(value: Column) -> Column:
    return F.regexp_replace(F.translate(value, ",²", ".2"), r"[^\p{L}\p{N}. ]", "")


def extras_struct(extras: Column) -> Column:
    """Attributes by exact source key, cleaned and cast; null for a null map."""
    fields = []
    for name, keys in fixed.EXTRA_KEYS.items():
        value = _clean(first_key(extras, keys))
        if name in _WHOLE:
            value = value.try_cast("int")
        elif name in ("front_road", "front_face"):
            value = F.replace(value, F.lit("m"), F.lit("")).try_cast("double")
        elif name == "ultilization_square":
            value = F.replace(value, F.lit("m2"), F.lit("")).try_cast("double")
        fields.append(value.alias(name))
    return F.when(extras.isNotNull(), F.struct(*fields))


def first_key_with(entries: Column, words: list[str]) -> Column:
    """Value of the first of ``struct<key, value>`` entries whose lower-cased key holds one of ``words``."""
    wanted = [F.lit(w) for w in dict.fromkeys(w.lower() for w in words)]
    hits = F.filter(entries, lambda e: reduce(or_, [F.contains(e["key"], w) for w in wanted]))
    return F.get(hits, F.lit(0))["value"]


def extras_by_word(extras: Column) -> Column:
    """Attributes by words inside the source keys, numbers taken out of dirty text."""

    def read(entries: Column) -> Column:
        fields = []
        for name, words in fixed.EXTRA_WORDS.items():
            value = first_key_with(entries, words)
            if name in _WHOLE:
                value = extract_number(value).try_cast("int")
            elif name in ("direction", "legal"):
                value = strip(value)
            else:
                value = extract_number(value)
            fields.append(value.alias(name))
        return F.struct(*fields)

    low = F.transform(
        F.map_entries(extras), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"))
    )
    return let(low, read)


def flatten(df: DataFrame, column: str = "extra_infos") -> DataFrame:
    """Lift the fields of a struct to the top level and drop it."""
    return df.select("*", f"{column}.*").drop(column)


def pairs_to_map(pairs: Column) -> Column:
    """Map from an array of ``struct<label, value>``; the last value of a label wins, null pairs are left out."""
    kept = F.filter(pairs, lambda p: p.isNotNull())
    last = F.filter(kept, lambda p, i: ~F.exists(F.slice(kept, i + 2, F.size(kept)), lambda q: q["label"] == p["label"]))
    return F.map_from_entries(last)


def extra_keys(df: DataFrame, column: str = "extra_infos") -> DataFrame:
    """Distinct keys found in the attribute maps."""
    return df.select(F.explode(F.map_keys(column)).alias("key")).distinct()
