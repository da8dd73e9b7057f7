"""Numbers, prices, areas and dates out of dirty text. Unreadable input gives null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from listmill import fixed
from listmill.functions.text import let, squeeze, strip

BILLION = 1e9
MILLION = 1e6


def to_number(value: Column) -> Column:
    return value.try_cast("double")


def safe_casts(value: Column) -> Column:
    """All scalar readings of a text at once."""
    return F.struct(
        value.try_cast("string").alias("as_string"),
        F.when(value.isNotNull(), value != "").alias("as_boolean"),
        value.try_cast("int").alias("as_int"),
        value.try_cast("double").alias("as_double"),
    )


def unit_price(price: Column, square: Column) -> Column:
    """Price per square metre; null when the area is null or zero."""
    return F.try_divide(price.try_cast("double"), square.try_cast("double"))


def extract_number(text: Column) -> Column:
    """Comma read as decimal point, everything but digits and points dropped, then read as a number."""
    return F.regexp_replace(F.replace(text, F.lit(","), F.lit(".")), r"[^0-9.]", "").try_cast("double")


def parse_area(text: Column) -> Column:
    """Area in square metres; a negative one is null."""
    value = F.regexp_replace(strip(text), "m2|m²|m", "").try_cast("double")
    return F.when(value >= 0, value)


def price_text(text: Column) -> Column:
    """Normalised price text: one decimal comma, tight slashes, lower case."""
    out = F.regexp_replace(text, r"^([^,]*),", "$1.")
    out = F.replace(F.replace(out, F.lit(" /"), F.lit("/")), F.lit("/ "), F.lit("/"))
    agreed = F.lit(fixed.PRICE_ON_REQUEST)
    return let(strip(F.lower(out)), lambda t: F.when(F.contains(t, agreed), agreed).otherwise(t))


def parse_price_crawl(text: Column, square: Column) -> Column:
    """Price of a crawled listing from ``<number> <unit>``; null when the text has another form.

    Here a unit price is multiplied by the area for both units (compare :func:`parse_price_job`).
    """

    def read(parts: Column) -> Column:
        number, unit = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
        factor = (
            F.when(unit == "tỷ", F.lit(BILLION))
            .when(unit == "triệu", F.lit(MILLION))
            .when(unit == "tỷ/m2", BILLION * square)
            .when(unit == "triệu/m2", MILLION * square)
        )
        readable = (F.size(parts) == 2) & number.rlike(r"^([0-9]+\.?[0-9]*|\.[0-9]+)$")
        return F.when(readable, number.try_cast("double") * factor)

    return let(F.split(squeeze(price_text(text)), " "), read)


def parse_price_job(text: Column, square: Column) -> Column:
    """Price of a lake row: a plain number, millions per m² times the area, or billions per m².

    The last form is read as a total whose unit was mistyped, so the area does not enter.
    """
    first = F.get(F.split(strip(text), rf"[\s\p{{Z}}]+"), F.lit(0)).try_cast("double")
    per_metre = (
        F.when(text.rlike(r"triệu\s*/\s*m"), first * MILLION * square)
        .when(text.rlike(r"tỷ\s*/\s*m"), first * BILLION)
    )
    return F.coalesce(text.try_cast("double"), F.when(square.isNotNull(), per_metre))


def parse_post_date(text: Column) -> Column:
    """``day/month/year`` with or without padding, as a date."""
    return F.to_date(F.try_to_timestamp(text, F.lit("d/M/yyyy")))


def date_part_of_stamp(text: Column) -> Column:
    """The part in front of the first dash of ``date - time``."""
    return strip(F.get(F.split(text, "-"), F.lit(0)))


def day_label(day: Column) -> Column:
    return F.date_format(day, "dd-MM-yyyy")


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def stamp(moment: Column) -> Column:
    return F.date_format(moment, fixed.STAMP_FORMAT)


def dashboard_amount(value: Column) -> Column:
    """Null as zero, rounded half-even to thousands."""
    return F.bround(F.coalesce(value, F.lit(0.0)), -3).cast("long")


def dashboard_area(value: Column) -> Column:
    return F.bround(F.coalesce(value, F.lit(0.0)), 0).cast("long")
