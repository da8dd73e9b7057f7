"""JSON in text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listmill.functions.text import let

_CORRUPT = "_corrupt_record"


def decode(text: Column, schema: T.StructType) -> Column:
    """Text or bytes to the declared struct; malformed input gives null fields."""
    return F.from_json(text.cast("string"), schema)


def encode(*columns: str | Column) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def decode_lenient(text: Column, schema: T.StructType) -> Column:
    """Read JSON that a generator wrapped in code fences, wrote with Python literals or cut off.

    Readings are tried from strict to patched; the first that parses wins, null when none does.
    """
    marked = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    options = {"allowUnquotedControlChars": "true", "columnNameOfCorruptRecord": _CORRUPT}
    plain = F.trim(F.regexp_replace(text, "```json|```", ""))
    pythonic = F.regexp_replace(
        F.regexp_replace(F.regexp_replace(plain, r":\s*None\b", ": null"), r":\s*True\b", ": true"),
        r":\s*False\b",
        ": false",
    )
    closed = F.when(~F.endswith(plain, F.lit("}")), F.concat(plain, F.lit('"}')))

    def whole(parsed: Column) -> Column:
        fields = F.struct(*[parsed[f.name].alias(f.name) for f in schema.fields])
        return F.when(parsed.isNotNull() & parsed[_CORRUPT].isNull(), fields)

    readings = []
    for candidate in (plain, pythonic, closed):
        readings.append(let(F.from_json(candidate, marked, options), whole))
    return F.coalesce(*readings)
