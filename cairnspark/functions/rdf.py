"""Objects of RDF triples: points, entities, numbers, quoted text, URIs.

Null where an object does not have the form asked for: what cannot be read is
no value, and must be dropped before a first or last value is chosen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Properties of the knowledge base and the forms of their objects.
POINT, INSTANCE_OF, COUNTRY, POPULATION, GEONAMES, OSM_RELATION, IMAGE, RELATED_IMAGE = "P625", "P31", "P17", "P1082", "P1566", "P402", "P18", "P6802"
PROPERTIES = (POINT, INSTANCE_OF, COUNTRY, POPULATION, GEONAMES, OSM_RELATION, IMAGE, RELATED_IMAGE)
EARTH = "/entity/Q2"
POINT_FORM = r'"(?:<([^>]+)>\s+)?Point\(([^ ]+) ([^)]+)\)"'
LINE_FORM = r"^<https?://www\.wikidata\.org/entity/(Q\d+)>\s+<https?://www\.wikidata\.org/prop/direct/(P\d+)>\s+(.+?)\s*\.\s*$"


def _first(value: Column, form: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(value, form, group), F.lit(""))


def point(value: Column) -> Column:
    """struct<lat, lon> of a point on Earth within range; null otherwise.  Numbers that cannot be read give null."""
    globe = F.regexp_extract(value, POINT_FORM, 1)
    lon, lat = (_first(value, POINT_FORM, k).try_cast("double") for k in (2, 3))
    fine = ((globe == "") | globe.endswith(EARTH)) & lat.between(-90, 90) & lon.between(-180, 180)
    return F.when(fine, F.struct(lat.alias("lat"), lon.alias("lon")))


def entity(value: Column) -> Column:
    return _first(value, r"entity/(Q\d+)")


def whole_number(value: Column) -> Column:
    """The integer that a quoted literal begins with."""
    return _first(value, r'"([+-]?\d+)').try_cast("long")


def quoted_text(value: Column) -> Column:
    return _first(value, r'"([^"]+)"')


def digits(value: Column) -> Column:
    return _first(value, r'"(\d+)"').try_cast("long")


def secure_uri(value: Column) -> Column:
    """The URI, with http at its head made https."""
    return F.regexp_replace(_first(value, r"<(http[^>]+)>"), "^http://", "https://")
