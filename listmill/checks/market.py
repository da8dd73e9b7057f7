"""Outlier bounds, district and day aggregates, heat layers."""

from pyspark.sql import functions as F

from listmill.checks.registry import query
from listmill.checks.views import COORDINATES_SQL, LISTINGS_SQL, PLACES_SQL, coordinates, listings, places, table
from listmill.functions import fields
from listmill.operators import geo, market, outliers

_UNIT_SQL = "SELECT p_type, l_extendedprice / NULLIF(l_quantity, 0) AS v FROM lineitem JOIN part ON l_partkey = p_partkey"


def _unit_prices(spark, sf):
    rows = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return rows.select("p_type", fields.unit_price(F.col("l_extendedprice"), F.col("l_quantity")).alias("v"))


def _rounded(df, *names, digits=4):
    return df.withColumns({n: F.round(n, digits) for n in names})


def _quantiles(source, group, value):
    return f"""SELECT {group}, count({value}) AS n, quantile_cont({value}, 0.05) AS lo, quantile_cont({value}, 0.95) AS hi
      FROM {source} WHERE {value} IS NOT NULL GROUP BY {group}"""


@query(f"""WITH u AS ({_UNIT_SQL}), q AS ({_quantiles('u', 'p_type', 'v')})
SELECT p_type, round(greatest(lo - (hi - lo) * 5, 0), 4) AS lower_bound, round(hi + (hi - lo) * 5, 4) AS upper_bound FROM q""")
def unit_price_bounds_exact(spark, sf):
    bounds = outliers.exact_bounds(_unit_prices(spark, sf), "p_type", "v")
    return _rounded(bounds, "lower_bound", "upper_bound")


@query()
def unit_price_bounds_approx(spark, sf):
    return outliers.approx_bounds(_unit_prices(spark, sf), "p_type", "v")


@query()
def global_bounds(spark, sf):
    return outliers.approx_bounds(_unit_prices(spark, sf), None, "v")


@query()
def trimmed_by_global_bounds(spark, sf):
    kept = outliers.trim_global(_unit_prices(spark, sf), "v")
    return kept.groupBy("p_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.max("v"), 4).alias("top"))


def _within(df, group, bounds):
    """Whether the approximate bounds lie within the rank error that their accuracy allows, per group."""
    error = 1.0 / outliers.ACCURACY
    keys = [group] if group else []
    rows = df.where(F.col("v").isNotNull())
    joined = rows.join(bounds, group) if group else rows.crossJoin(F.broadcast(bounds))  # one row of bounds
    def ok(bound, p):
        below, upto = (F.count_if(c) / F.count(F.lit(1)) for c in (F.col("v") < F.col(bound), F.col("v") <= F.col(bound)))
        return (below - error <= p) & (upto + error >= p)
    grouped = joined.groupBy(*keys)
    return grouped.agg(ok("lower_bound", outliers.LOWER).alias("low_ok"), ok("upper_bound", outliers.UPPER).alias("high_ok"))


@query("SELECT p_type, true AS low_ok, true AS high_ok FROM part JOIN lineitem ON l_partkey = p_partkey GROUP BY p_type")
def approx_bounds_rank_error(spark, sf):
    """The quantiles themselves (spreads of 0) against the counted ranks of each group."""
    prices = _unit_prices(spark, sf)
    return _within(prices, "p_type", outliers.approx_bounds(prices, "p_type", "v", spreads=0.0))


@query("SELECT true AS low_ok, true AS high_ok")
def global_bounds_rank_error(spark, sf):
    prices = _unit_prices(spark, sf)
    return _within(prices, None, outliers.approx_bounds(prices, None, "v", spreads=0.0))


@query(f"WITH {LISTINGS_SQL} SELECT * REPLACE (round(price_per_m2, 6) AS price_per_m2) FROM listings")
def listing_view(spark, sf):
    return _rounded(listings(spark, sf), "price_per_m2", digits=6)


# spreads of 0 leave the quantiles themselves as bounds, so that the supplied prices have something to trim
_TRIM_SQL = f"""WITH {LISTINGS_SQL},
q AS ({_quantiles('listings', 'estate_type', 'price_per_m2')}),
j AS (SELECT l.*, lo, hi FROM listings l LEFT JOIN q USING (estate_type))"""


def _trimmed(spark, sf, keep_null):
    rows = listings(spark, sf)
    bounds = outliers.exact_bounds(rows, "estate_type", "price_per_m2", spreads=0.0)
    return outliers.trim(rows, bounds, "estate_type", "price_per_m2", keep_null)


@query(f"{_TRIM_SQL} SELECT id, estate_type, round(price_per_m2, 8) AS price_per_m2 FROM j WHERE price_per_m2 BETWEEN lo AND hi")
def trimmed_listings(spark, sf):
    kept = _trimmed(spark, sf, False).select("id", "estate_type", "price_per_m2")
    return _rounded(kept, "price_per_m2", digits=8)


@query(f"""{_TRIM_SQL} SELECT id, estate_type, round(price_per_m2, 8) AS price_per_m2 FROM j
WHERE price_per_m2 IS NULL OR price_per_m2 BETWEEN lo AND hi""")
def trimmed_listings_keep_null(spark, sf):
    kept = _trimmed(spark, sf, True).select("id", "estate_type", "price_per_m2")
    return _rounded(kept, "price_per_m2", digits=8)


_BUY = "NOT (estate_type LIKE '%thuê%' OR estate_type LIKE '%thue%')"
_RENT = "(estate_type LIKE '%thuê%' OR estate_type LIKE '%thue%')"


@query(f"""{_TRIM_SQL}, t AS (SELECT * FROM j WHERE price_per_m2 IS NULL OR price_per_m2 BETWEEN lo AND hi),
p AS ({PLACES_SQL}),
a AS (SELECT district, avg(price) AS v FROM t WHERE {_BUY} GROUP BY district),
f AS (SELECT p.district, coalesce(v, 0) AS v FROM p LEFT JOIN a USING (district))
SELECT row_number() OVER (ORDER BY round(v, 2) DESC, district) AS seq, district, round(v, 2) AS avg_price FROM f""")
def trimmed_price_by_district(spark, sf):
    averages = market.by_district(_trimmed(spark, sf, True), places(spark, sf).select("district"), "price")
    return market.numbered(_rounded(averages, "avg_price", digits=2), F.desc("avg_price"), "district")


def _district_sql(metric, kind, category, shown):
    where = f"{_BUY if kind == 'buy' else _RENT} AND category = '{category}'"
    return f"""WITH {LISTINGS_SQL}, p AS ({PLACES_SQL}),
a AS (SELECT district, avg({metric}) AS v FROM listings WHERE {where} GROUP BY district),
f AS (SELECT p.district, round(coalesce(v, 0), 2) AS avg_{metric} FROM p LEFT JOIN a USING (district))
SELECT row_number() OVER (ORDER BY avg_{metric} DESC, district) AS seq, district, avg_{metric},
  CAST({shown.format(f'avg_{metric}')} AS BIGINT) AS shown FROM f"""


def _by_district(spark, sf, metric, kind, category, shown):
    averages = market.by_district(
        listings(spark, sf), places(spark, sf).select("district"), metric, kind, category
    )
    averages = _rounded(averages, f"avg_{metric}", digits=2)
    averages = averages.withColumn("shown", shown(F.col(f"avg_{metric}")))
    return market.numbered(averages, F.desc(f"avg_{metric}"), "district")


@query(_district_sql("price", "buy", "nhamatpho_index", "round_even({}, -3)"))
def avg_price_by_district(spark, sf):
    return _by_district(spark, sf, "price", "buy", "nhamatpho_index", fields.dashboard_amount)


@query(_district_sql("price_per_m2", "rent", "chungcu_index", "round_even({}, -3)"))
def avg_unit_price_by_district(spark, sf):
    return _by_district(spark, sf, "price_per_m2", "rent", "chungcu_index", fields.dashboard_amount)


@query(_district_sql("square", "buy", "bietthu_index", "round_even({}, 0)"))
def avg_area_by_district(spark, sf):
    return _by_district(spark, sf, "square", "buy", "bietthu_index", fields.dashboard_area)


@query(f"""WITH {LISTINGS_SQL}, p AS ({PLACES_SQL}),
a AS (SELECT province, district, avg(price) AS v FROM listings WHERE {_BUY} GROUP BY ALL)
SELECT p.province, p.district, round(coalesce(v, 0), 2) AS avg_price FROM p LEFT JOIN a USING (province, district)""")
def avg_price_by_province_district(spark, sf):
    averages = market.by_district(listings(spark, sf), places(spark, sf), "price", with_province=True)
    return _rounded(averages, "avg_price", digits=2)


def _day_sql(metric, where):
    return f"""WITH {LISTINGS_SQL},
d AS (SELECT post_date AS day, avg({metric}) AS v FROM listings WHERE {where} GROUP BY 1),
s AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM d)
SELECT s.day, strftime(s.day, '%d-%m-%Y') AS label, round(coalesce(v, 0), 6) AS avg_{metric}
FROM s LEFT JOIN d USING (day)"""


_SPAN = "district = 'NATION_3' AND post_date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'"


def _by_day(spark, sf, metric, kind):
    series = market.by_day(listings(spark, sf), metric, "NATION_3", "1996-01-01", "1997-12-31", kind)
    series = _rounded(series, f"avg_{metric}", digits=6)
    return series.withColumn("label", fields.day_label(F.col("day"))).orderBy("day")


@query(_day_sql("price", f"{_SPAN} AND {_BUY}"))
def avg_price_by_day(spark, sf):
    return _by_day(spark, sf, "price", "buy")


@query(_day_sql("price_per_m2", f"{_SPAN} AND {_RENT}"))
def avg_unit_price_by_day(spark, sf):
    return _by_day(spark, sf, "price_per_m2", "rent")


@query(f"""WITH {LISTINGS_SQL}, d AS (SELECT post_date AS day, avg(price) AS v FROM listings
WHERE {_SPAN} AND price > 0 GROUP BY 1) SELECT day, round(v, 6) AS avg_price,
CAST(date_trunc('month', day) AS DATE) AS month FROM d WHERE v <> 0""")
def priced_days(spark, sf):
    """The older day series: positive prices only, empty days left out."""
    from listmill.functions.predicates import day_between, positive

    span = day_between(F.col("post_date"), F.lit("1996-01-01"), F.lit("1997-12-31"))
    rows = listings(spark, sf).where((F.col("district") == "NATION_3") & span & positive(F.col("price")))
    daily = rows.groupBy(F.col("post_date").alias("day")).agg(F.avg("price").alias("avg_price"))
    return (
        _rounded(daily.where(F.col("avg_price") != 0), "avg_price", digits=6)
        .withColumn("month", fields.month_start(F.col("day")))
    )


@query("""WITH d AS (SELECT CAST(ts AS DATE) AS day, avg(value) AS v FROM events GROUP BY 1),
s AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM d)
SELECT day, round(coalesce(v, 0), 4) AS avg_value FROM s LEFT JOIN d USING (day)""")
def event_daily_series(spark, sf):
    daily = table(spark, sf, "events").groupBy(F.to_date("ts").alias("day")).agg(F.avg("value").alias("avg_value"))
    return _rounded(market.fill_days(daily, "day", "avg_value"), "avg_value")


_HEAT_SQL = f"""WITH {LISTINGS_SQL}, c AS ({COORDINATES_SQL}),
m AS (SELECT province, district, round(avg(price), 2) AS avg_price FROM listings GROUP BY ALL),
x AS (SELECT min(avg_price) AS lo, max(avg_price) AS hi FROM m),
h AS (SELECT province, district, lat, lon, avg_price,
  CASE WHEN hi > lo THEN (avg_price - lo) / (hi - lo) ELSE 0.5 END AS weight
  FROM m JOIN c USING (province, district), x WHERE lat IS NOT NULL AND lon IS NOT NULL)"""


def _heat(spark, sf):
    metric = listings(spark, sf).groupBy("province", "district").agg(F.round(F.avg("price"), 2).alias("avg_price"))
    return geo.heat_layer(metric, coordinates(spark, sf), "avg_price")


@query(f"""{_HEAT_SQL} SELECT province, district, round(lat, 4) AS lat, round(lon, 4) AS lon, avg_price,
round(weight, 6) AS weight FROM h""")
def heat_layer(spark, sf):
    return _rounded(_rounded(_heat(spark, sf), "lat", "lon"), "weight", digits=6)


@query(f"""{_HEAT_SQL} SELECT round(avg(lat), 6) AS centre_lat, round(avg(lon), 6) AS centre_lon,
round(min(lat), 4) AS min_lat, round(max(lat), 4) AS max_lat, round(min(lon), 4) AS min_lon,
round(max(lon), 4) AS max_lon FROM h""")
def map_extent(spark, sf):
    extent = geo.map_extent(_heat(spark, sf))
    extent = _rounded(extent, "centre_lat", "centre_lon", digits=6)
    return _rounded(extent, "min_lat", "max_lat", "min_lon", "max_lon")


@query(f"WITH {LISTINGS_SQL} SELECT category, count(*) AS n FROM listings GROUP BY category")
def category_counts(spark, sf):
    return market.counts_per_category(listings(spark, sf), "category")


@query(f"WITH {LISTINGS_SQL} SELECT DISTINCT estate_type FROM listings WHERE estate_type IS NOT NULL")
def distinct_categories(spark, sf):
    return market.distinct_categories(listings(spark, sf), "estate_type")
