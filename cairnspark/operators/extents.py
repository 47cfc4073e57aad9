"""The largest map feature of a page."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def largest_extent(pages: DataFrame, features: DataFrame, language: str = "en") -> DataFrame:
    """page_id, extent_km, area_km2, osm_source: of the features with an extent that a page meets by entity, by title or by relation, the largest; of equal ones the smallest id, then the first kind.

    Both sides are laid out by (kind of key, key), up to three rows each, and
    meet in one equi-join: a condition with OR would compare everything with
    everything, a join for each kind would read both sides three times.  The
    largest is an aggregate, combined before the shuffle.
    """
    key = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.cast("string").alias("key"))
    keyed = lambda df, *keys: df.withColumn("by", F.explode(F.array(*keys))).where("by.key is not null")
    c = F.col
    asked = keyed(pages, key("entity", c("qid")), key("title", c("title")), key("relation", c("osm_relation"))).select("page_id", "by")
    named, related = F.when(c("wiki_lang") == language, c("wiki_title")), F.when(c("osm_type") == "relation", c("osm_id"))
    offered = keyed(features.where("extent_km > 0"), key("entity", c("qid")), key("title", named), key("relation", related)).select("by", "osm_type", "osm_id", "extent_km", "area_km2")
    hits = asked.join(offered, "by")
    best = hits.groupBy("page_id").agg(F.min_by(F.struct("osm_type", "osm_id", "extent_km", "area_km2"), F.struct((-F.col("extent_km")).alias("larger"), "osm_id", "osm_type")).alias("b"))
    return best.select("page_id", "b.extent_km", "b.area_km2", F.concat_ws("/", "b.osm_type", F.col("b.osm_id").cast("string")).alias("osm_source"))
