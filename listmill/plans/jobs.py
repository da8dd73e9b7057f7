"""The user-level jobs, composed from the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listmill import fixed
from listmill.functions import extras, fields, text
from listmill.operators import evaluate, gazetteer, market, outliers, records, routing, similar
from listmill.functions.predicates import listing_type
from listmill.session import settle
from listmill.sources.messages import as_messages


def clean_listing(df: DataFrame, moment: Column | None = None, labels: dict | None = None) -> DataFrame:
    """The row-wise cleaning shared by batch and stream: text, category label, price, unit price, attributes."""
    out = records.with_id(df)
    for name in ("title", "description"):
        out = out.withColumn(name, text.collapse_punctuation(text.strip_special(F.col(name))))
    out = out.withColumn("estate_type", text.category_label(F.col("estate_type"), labels))
    out = out.withColumn("price", fields.parse_price_job(F.col("price"), F.col("square")))
    out = out.withColumn("price_per_m2", fields.unit_price(F.col("price"), F.col("square")))
    out = out.withColumn("extra_infos", extras.extras_struct(F.col("extra_infos")))
    return records.with_created_at(out, F.current_timestamp() if moment is None else moment)


def stream_clean(df: DataFrame, moment: Column | None = None) -> DataFrame:
    return clean_listing(df, moment, fixed.LABEL_MAP_STREAM)


def _scoped(*scope: str) -> Column:
    """One grouping key out of several columns; null when the last one is."""
    return F.when(F.col(scope[-1]).isNotNull(), F.concat_ws("\u0001", *scope))


def batch_clean(
    lake: DataFrame, moment: Column | None = None, keep_null: bool = False, approximate: bool = False,
    lower: float = outliers.LOWER, upper: float = outliers.UPPER, spreads: float = outliers.SPREADS,
) -> DataFrame:
    """The lake, cleaned and trimmed of unit-price outliers per topic and category, with its served table.

    One plan for all topics. The bounds are computed from the pruned price columns only.
    """
    clean = routing.by_topic(clean_listing(lake, moment)).withColumn("_scope", _scoped("topic", "estate_type"))
    make = outliers.approx_bounds if approximate else outliers.exact_bounds
    bounds = make(clean, "_scope", "price_per_m2", lower=lower, upper=upper, spreads=spreads)
    return outliers.trim(clean, bounds, "_scope", "price_per_m2", keep_null).drop("_scope")


def file_etl(crawl: DataFrame, position: str, moment: Column | None = None, min_rows: int = 10) -> DataFrame:
    """Crawl files to typed documents: routing by file name, cleaning, keep-first per file, trimming of large groups."""
    out = crawl.withColumn("table", routing.by_file_name(F.col("file_name")))
    out = out.withColumns(
        {
            "title": text.simple_clean(F.col("title")),
            "description": text.simple_clean(F.col("description")),
            "estate_type": text.trimmed_label(F.col("estate_type")),
            "extra_infos": extras.extras_by_word(F.col("extra_infos")),
            "price": fields.to_number(F.col("price")),
            "square": fields.to_number(F.col("square")),
        }
    )
    out = extras.flatten(records.flatten_address(out))
    out = records.first_per_key(out, ["file_name", "title", "description"], position)
    out = out.withColumn("price_per_m2", fields.unit_price(F.col("price"), F.col("square")))
    # read three times from here on: settled once, rather than de-duplicated three times
    out = settle(out.withColumn("_scope", _scoped("file_name", "estate_type")))
    bounds = outliers.exact_bounds(out, "_scope", "price_per_m2", min_rows=min_rows)
    kept = outliers.trim(out, bounds, "_scope", "price_per_m2", keep_null=True).drop("_scope")
    return records.typed(records.with_created_at(kept, F.current_timestamp() if moment is None else moment))


def ingest_clean(crawled: DataFrame, places: DataFrame, position: str, slugs: dict | None = None) -> DataFrame:
    """Cleaning before publishing: text, address, area, price, phones, date, near-duplicates.

    ``crawled`` has text ``price`` and ``square`` and a URL slug as ``address.province``.
    """
    out = crawled.withColumns(
        {
            "title": text.normalise_text(F.col("title")),
            "description": text.normalise_text(F.col("description")),
            "_address": text.normalise_text(F.col("address.full_address")),
            "_given": text.lookup(F.col("address.province"), fixed.PROVINCE_SLUGS if slugs is None else slugs),
        }
    )
    out = gazetteer.resolve(out, places, "_address", "_given")
    out = out.withColumn(
        "address",
        F.struct("district", text.strip(F.col("_address")).alias("full_address"), "province", "ward"),
    ).drop("district", "province", "ward", "_address", "_given")
    out = out.withColumn("square", fields.parse_area(F.col("square")))
    total = fields.parse_price_crawl(F.col("price"), F.col("square"))
    out = out.withColumns(
        {
            "price": F.coalesce(total.cast("string"), fields.price_text(F.col("price"))),
            "contact_info": F.struct(
                F.col("contact_info.name").alias("name"), text.clean_phones(F.col("contact_info.phone")).alias("phone")
            ),
            "post_date": F.date_format(fields.parse_post_date(F.col("post_date")), "yyyy/MM/dd"),
        }
    )
    # the comparison reads the cleaned rows several times
    out = settle(out)
    decided = similar.near_duplicates_listing(out, position, "title", "description")
    kept = decided.where(F.col("kept_as") == F.col(position)).select(position)
    return out.join(kept, position, "left_semi")


def ingest_messages(crawled: DataFrame, places: DataFrame, position: str, topic: str = "topic") -> DataFrame:
    return as_messages(ingest_clean(crawled, places, position), topic, "post_id")


def dashboard(
    listings: DataFrame, domain: DataFrame, coordinates: DataFrame, district: str, start: str, end: str,
    kind: str = "buy", category: str | None = None,
) -> DataFrame:
    """All parts of the market view as ``(section, label, place, value)`` rows.

    The three district metrics come from one aggregation, the two day series from another.
    """
    rows = listings.where(listing_type(F.col("estate_type"), kind))
    if category is not None:
        rows = rows.where(F.col("category") == category)
    metrics = ["price", "price_per_m2", "square"]
    averages = rows.groupBy("province", "district").agg(*[F.avg(m).alias(m) for m in metrics])
    full = domain.join(averages, ["province", "district"], "left")
    full = full.withColumns({m: F.coalesce(F.col(m), F.lit(0.0)) for m in metrics})
    shown = full.select(
        "district",
        F.explode(
            F.array(
                F.struct(F.lit("district price").alias("section"), fields.dashboard_amount(F.col("price")).alias("v")),
                F.struct(F.lit("district unit price").alias("section"), fields.dashboard_amount(F.col("price_per_m2")).alias("v")),
                F.struct(F.lit("district area").alias("section"), fields.dashboard_area(F.col("square")).alias("v")),
            )
        ).alias("s"),
    ).select("s.section", F.col("district").alias("label"), F.lit(None).cast("string").alias("place"),
             F.col("s.v").cast("double").alias("value"))

    from listmill.operators.geo import heat_layer

    parts = [shown]
    for metric, name in (("price", "heat price"), ("price_per_m2", "heat unit price")):
        layer = heat_layer(full.select("province", "district", metric), coordinates, metric)
        parts.append(
            layer.select(
                F.lit(name).alias("section"), F.col("district").alias("label"),
                F.concat_ws(",", F.format_number("lat", 4), F.format_number("lon", 4)).alias("place"),
                F.round("weight", 6).alias("value"),
            )
        )
    for metric, name in (("price", "day price"), ("price_per_m2", "day unit price")):
        series = market.by_day(listings, metric, district, start, end, kind, category)
        parts.append(
            series.where(F.col(f"avg_{metric}") != 0).select(
                F.lit(name).alias("section"), fields.day_label(F.col("day")).alias("label"),
                F.lit(None).cast("string").alias("place"),
                fields.dashboard_amount(F.col(f"avg_{metric}")).cast("double").alias("value"),
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def evaluation_report(cases: DataFrame, positive, negative, fields_: list[str]) -> DataFrame:
    """Tool accuracy, class metrics and parameter accuracy as ``(metric, value)``.

    ``cases`` has ``expected_tools, selected_tools, expected, predicted, expected_params, predicted_params``.
    """
    tools = evaluate.tool_accuracy(cases, "expected_tools", "selected_tools").select(
        F.explode(F.create_map(F.lit("tool_accuracy"), F.col("accuracy"))).alias("metric", "value")
    )
    confusion = evaluate.confusion_metrics(cases, "expected", "predicted", positive, negative)
    names = confusion.columns
    spread = F.create_map(*[x for n in names for x in (F.lit(n), F.col(n).cast("double"))])
    params = evaluate.param_accuracy(cases, "expected_params", "predicted_params", fields_).select(
        F.explode(F.create_map(F.lit("param_accuracy"), F.col("param_accuracy"))).alias("metric", "value")
    )
    return tools.unionByName(confusion.select(F.explode(spread).alias("metric", "value"))).unionByName(params)
