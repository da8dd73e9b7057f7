"""Declared schemas of the listing message, the served listing and the search request."""

from pyspark.sql import types as T

ADDRESS = T.StructType(
    [
        T.StructField("district", T.StringType()),
        T.StructField("full_address", T.StringType()),
        T.StructField("province", T.StringType()),
        T.StructField("ward", T.StringType()),
    ]
)

CONTACT = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("phone", T.ArrayType(T.StringType())),
    ]
)

LISTING_MESSAGE = T.StructType(
    [
        T.StructField("address", ADDRESS),
        T.StructField("contact_info", CONTACT),
        T.StructField("description", T.StringType()),
        T.StructField("estate_type", T.StringType()),
        T.StructField("extra_infos", T.MapType(T.StringType(), T.StringType())),
        T.StructField("link", T.StringType()),
        T.StructField("post_date", T.StringType()),
        T.StructField("post_id", T.StringType()),
        T.StructField("price", T.StringType()),
        T.StructField("square", T.DoubleType()),
        T.StructField("title", T.StringType()),
    ]
)

# column -> type of the served table; columns not named here are stored as they are
SERVED_TYPES = {
    "estate_type": "string",
    "province": "string",
    "district": "string",
    "price": "double",
    "square": "float",
    "price_per_m2": "double",
    "no_bedrooms": "int",
    "no_bathrooms": "int",
    "no_floors": "int",
    "direction": "string",
    "legal": "string",
    "link": "string",
    "title": "string",
    "description": "string",
}

REQUEST = T.StructType(
    [
        T.StructField("request_id", T.IntegerType()),
        T.StructField("estate_type", T.ArrayType(T.StringType())),
        T.StructField("is_latest_posted", T.BooleanType()),
        T.StructField("is_latest_created", T.BooleanType()),
        T.StructField("province", T.ArrayType(T.StringType())),
        T.StructField("district", T.ArrayType(T.StringType())),
        T.StructField("ward", T.ArrayType(T.StringType())),
        T.StructField("front_face", T.DoubleType()),
        T.StructField("front_road", T.DoubleType()),
        T.StructField("no_bathrooms", T.IntegerType()),
        T.StructField("no_bedrooms", T.IntegerType()),
        T.StructField("no_floors", T.IntegerType()),
        T.StructField("ultilization_square", T.DoubleType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("min_price", T.DoubleType()),
        T.StructField("max_price", T.DoubleType()),
        T.StructField("price_per_square", T.DoubleType()),
        T.StructField("square", T.DoubleType()),
        T.StructField("description", T.StringType()),
    ]
)
