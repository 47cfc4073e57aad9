"""The build: from raw exports to the article table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import assemble, entities, extents, inlinks, labels, pages, views
from ..sources.elevation import Sampler, sample_elevations
from ..staging import written


@dataclass
class Inputs:
    """Parsed inputs.  What is optional may be None; its columns are then null or 0."""

    triples: DataFrame
    page_props: DataFrame
    geo_tags: DataFrame
    pages: DataFrame
    link_targets: DataFrame
    page_links: DataFrame
    labels: DataFrame
    views: DataFrame | None = None
    features: DataFrame | None = None
    sampler: Sampler | None = None


def build(inputs: Inputs) -> DataFrame:
    """ARTICLE rows: entities with a place, their pages, labels, types, links, views, sizes and elevations."""
    placed = pages.with_entities(pages.page_properties(inputs.page_props), entities.entities(inputs.triples))
    own = placed.join(pages.articles(inputs.pages), "page_id")
    # labels are looked up once it is known which pages stay
    own = labels.resolved(own, inputs.labels, "instance_of", "country")
    # links, views, sizes and elevations all ask for these pages: written once, so that no dump is parsed again for each
    own = written(own.join(pages.place_types(inputs.geo_tags), "page_id", "left"), "pages")
    own = inlinks.with_inlinks(own, inlinks.inlink_counts(inputs.page_links, inputs.link_targets, own))
    if inputs.views is not None:
        own = own.join(views.median_views(inputs.views, own.select("page_id", "title")).withColumnRenamed("views", "pageviews_month"), "page_id", "left")
    if inputs.features is not None:
        own = own.join(extents.largest_extent(own, inputs.features), "page_id", "left")
    if inputs.sampler is not None:
        own = own.join(sample_elevations(own.select("page_id", F.col("lat"), F.col("lon")), inputs.sampler), "page_id", "left")
    return assemble.assemble(own)
