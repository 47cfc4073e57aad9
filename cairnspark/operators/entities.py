"""Entities from triples: one row per entity that has a place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rdf


def first(value: Column, order: Column, where: Column) -> Column:
    """The value first in order among the rows where it is not null and ``where`` holds."""
    return F.min_by(value, F.when(where & value.isNotNull(), order))


def last(value: Column, order: Column, where: Column) -> Column:
    return F.max_by(value, F.when(where & value.isNotNull(), order))


def in_order(value: Column, order: Column, where: Column) -> Column:
    """All values in order, as an array."""
    pairs = F.collect_list(F.when(where & value.isNotNull(), F.struct(order.alias("o"), value.alias("v"))))
    return F.transform(F.array_sort(pairs), lambda p: p["v"])


def entities(triples: DataFrame) -> DataFrame:
    """ENTITY rows.  Of class, country and relation the first value counts, of place, people, gazetteer and image the last, of related images all, each in the order of ``seq`` among the values that can be read.

    All rows of an entity are taken together wherever they stand; in a dump
    that is grouped by entity that is what reading it in order gives.
    """
    v, p, seq = F.col("value"), F.col("prop"), F.col("seq")
    # entities without a point need no further work: theirs are most of the triples
    placed = triples.where(p == rdf.POINT).where(rdf.point(v).isNotNull()).select("qid").distinct()
    rows = triples.join(placed, "qid", "left_semi")
    of = lambda prop: p == prop
    wide = rows.groupBy("qid").agg(
        last(rdf.point(v), seq, of(rdf.POINT)).alias("place"),
        first(rdf.entity(v), seq, of(rdf.INSTANCE_OF)).alias("instance_of_qid"),
        first(rdf.entity(v), seq, of(rdf.COUNTRY)).alias("country"),
        last(rdf.whole_number(v), seq, of(rdf.POPULATION)).alias("population"),
        last(rdf.quoted_text(v), seq, of(rdf.GEONAMES)).alias("geonames_id"),
        first(rdf.digits(v), seq, of(rdf.OSM_RELATION)).alias("osm_relation"),
        last(rdf.secure_uri(v), seq, of(rdf.IMAGE)).alias("p18_image"),
        in_order(rdf.secure_uri(v), seq, of(rdf.RELATED_IMAGE)).alias("related_images"),
    )
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    return wide.select(
        "qid", "place.lat", "place.lon", F.coalesce("instance_of_qid", F.lit("")).alias("instance_of"), text("instance_of_qid"), text("country"),
        "population", text("geonames_id"), "osm_relation", text("p18_image"), "related_images",
    )
