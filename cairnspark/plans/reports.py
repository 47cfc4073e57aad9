"""Coverage reports: map features of natural places, views of named pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.titles import title_of
from ..operators.extents import largest_extent
from ..operators.views import median_views

# Words of classes that are natural or protected areas, and words that make them something else.
NATURAL = (
    r"\b(lake|reservoir|lagoon|loch|lough|pond|wetland|swamp|marsh|bog|island|islet|archipelago|atoll|peninsula|cape|headland|"
    r"park|reserve|refuge|wilderness|forest|woodland|mountain|range|ridge|massif|hill|peak|summit|volcano|caldera|crater|"
    r"plateau|mesa|desert|dune|salt flat|salt pan|playa|canyon|gorge|valley|basin|glacier|ice field|ice cap|ice sheet|"
    r"bay|gulf|sea|strait|sound|fjord|inlet|estuary|delta)\b"
)
NOT_NATURAL = (
    r"\b(amusement|theme|water|skate|sports?|business|industrial|office|science|technology|trailer|car|caravan|holiday|mobile home|retirement|"
    r"shooting|driving|rifle|eruption|monster|cemetery|stadium|arena|mountain hut|ranger|railway|station|hotel|resort|company|team|"
    r"township|municipality|district|county|village|town|city)\b"
)


def is_natural(instance_of: Column) -> Column:
    low = F.lower(instance_of)
    return low.rlike(NATURAL) & ~low.rlike(NOT_NATURAL)


def natural_top(articles: DataFrame, ranks: DataFrame, k: int) -> DataFrame:
    """page_id, label, rank: the ``k`` natural places with most views, then most links."""
    ranked = articles.where(is_natural(F.col("instance_of"))).join(ranks.select("page_id", F.col("views").alias("rank")), "page_id", "left")
    ranked = ranked.withColumn("rank", F.coalesce("rank", F.lit(0)))
    return ranked.orderBy(F.col("rank").desc(), F.col("inlink_count").desc(), F.col("page_id").asc()).limit(k).select("page_id", "label", "rank", "inlink_count")


def extent_coverage(articles: DataFrame, features: DataFrame, views: DataFrame, k: int = 2000) -> dict[str, DataFrame]:
    """The report's parts: ``overall`` (n, matched), ``natural`` (the top places with their features), ``summary`` (of these: n, with_extent, with_area)."""
    pages = articles.select("page_id", "qid", title_of(F.col("label")).alias("title"), F.lit(None).cast("long").alias("osm_relation"))
    sized = largest_extent(pages, features)
    overall = articles.select("page_id").join(sized.select("page_id", "osm_source"), "page_id", "left").agg(F.count(F.lit(1)).alias("n"), F.count("osm_source").alias("matched"))
    top = natural_top(articles, median_views(views, pages), k).join(sized, "page_id", "left")
    summary = top.agg(F.count(F.lit(1)).alias("n"), F.count("extent_km").alias("with_extent"), F.count("area_km2").alias("with_area"))
    return {"overall": overall, "natural": top, "summary": summary}


# Pages whose views a build is looked at by.
NAMED_PAGES = ("Mount Rushmore", "Coon Rapids Dam", "Black Hills", "Mount Rainier", "Minneapolis", "Glen Canyon Dam", "Bear Butte", "Medicine Rocks State Park")


def view_coverage(articles: DataFrame, views: DataFrame, labels: tuple[str, ...] | list[str] = NAMED_PAGES) -> dict[str, DataFrame]:
    """``overall`` (n, with_views) and the medians of named pages."""
    pages = articles.select("page_id", title_of(F.col("label")).alias("title"), "label")
    median = median_views(views, pages)
    joined = pages.join(median, "page_id", "left")
    return {"overall": joined.agg(F.count(F.lit(1)).alias("n"), F.count("views").alias("with_views")), "named": joined.where(F.col("label").isin(*labels)).select("label", "views")}
