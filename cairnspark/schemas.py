"""Declared schemas; nothing is inferred.  Missing strings are empty, missing lists too; what may be null says so."""

from __future__ import annotations

from pyspark.sql import types as T

KINDS = {
    "string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(), "short": T.ShortType(), "double": T.DoubleType(), "float": T.FloatType(),
    "boolean": T.BooleanType(), "binary": T.BinaryType(), "strings": T.ArrayType(T.StringType()),
    "box": T.StructType([T.StructField(k, T.DoubleType()) for k in ("xmin", "ymin", "xmax", "ymax")]),
}


def schema(text: str) -> T.StructType:
    """name kind, ...: kinds as above.  Needs no session."""
    return T.StructType([T.StructField(name, KINDS[kind]) for name, kind in (field.split() for field in text.split(","))])


ENTITY = schema(
    "qid string, lat double, lon double, instance_of string, instance_of_qid string, country string, population long, "
    "geonames_id string, osm_relation long, p18_image string, related_images strings"
)
PAGEVIEW_MONTH = schema("month string, page_id int, title string, views long")
FEATURE = schema(
    "osm_type string, osm_id long, qid string, wiki_lang string, wiki_title string, "
    "xmin double, ymin double, xmax double, ymax double, antimeridian boolean, extent_km float, area_km2 float"
)
SEARCH_INDEX = schema("label string, lon double, lat double, inlink_count int")
ARTICLE = schema(
    "geometry binary, page_id int, qid string, label string, description string, instance_of string, instance_of_qid string, "
    "country string, population long, geonames_id string, elevation short, gt_type string, page_len int, inlink_count int, "
    "wikipedia_url string, image_url string, related_images strings, pageviews_month int, extent_km float, area_km2 float, "
    "osm_source string, bbox box"
)
