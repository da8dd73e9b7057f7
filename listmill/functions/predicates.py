"""Row predicates of the serving queries."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from listmill import fixed


def is_rent(estate_type: Column) -> Column:
    """The category text names a rental; a missing text does not."""
    named = reduce(or_, [F.contains(estate_type, F.lit(w)) for w in fixed.RENT_WORDS])
    return F.coalesce(named, F.lit(False))


def listing_type(estate_type: Column, kind: str) -> Column:
    return is_rent(estate_type) if kind == "rent" else ~is_rent(estate_type)


def near(value: Column, target: Column, share: float) -> Column:
    """``value`` lies within ``share`` of ``target``."""
    return value.between(target - target * share, target + target * share)


def any_equal(pairs: list[tuple[Column, object]]) -> Column:
    return reduce(or_, [c == v for c, v in pairs])


def all_equal(pairs: list[tuple[Column, object]]) -> Column:
    return reduce(and_, [c == v for c, v in pairs])


def day_between(day: Column, start: Column, end: Column) -> Column:
    """Closed range; a bound that is no date leaves nothing."""
    return F.coalesce(day.between(F.try_to_date(start), F.try_to_date(end)), F.lit(False))


def positive(value: Column) -> Column:
    return value > 0
