"""Pages: properties pivoted, joined with entities, reduced to articles, given their place types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.titles import image_url
from .entities import first, last

# Names of the properties.
QID, PAGE_IMAGE, DESCRIPTION = "wikibase_item", "page_image_free", "wikibase-shortdesc"


def page_properties(props: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """page_id and a column per wanted property: the last non-empty value in the order of ``seq``."""
    names = names or {QID: "qid", PAGE_IMAGE: "page_image", DESCRIPTION: "description"}
    rows = props.where(F.col("propname").isin(*names) & (F.col("value") != ""))
    return rows.groupBy("page_id").agg(*[last(F.col("value"), F.col("seq"), F.col("propname") == n).alias(c) for n, c in names.items()])


def with_entities(properties: DataFrame, entities: DataFrame) -> DataFrame:
    """Pages whose entity is known, with its columns, image and description; an entity may have many pages."""
    own = properties.where("qid is not null").join(entities, "qid")
    image = image_url(F.coalesce("page_image", F.lit("")), F.nullif("p18_image", F.lit("")))
    return own.withColumns({"image_url": image, "description": F.coalesce("description", F.lit(""))}).drop("page_image", "p18_image")


def place_types(tags: DataFrame) -> DataFrame:
    """page_id, gt_type: of the tags on Earth that have a type, the first primary one, else the first, in the order of ``seq``."""
    rows = tags.where((F.col("globe") == "earth") & (F.col("gt_type") != ""))
    order = F.struct((F.coalesce("is_primary", F.lit(0)) != 1).alias("secondary"), "seq")
    return rows.groupBy("page_id").agg(first(F.col("gt_type"), order, F.lit(True)).alias("gt_type"))


def articles(pages: DataFrame) -> DataFrame:
    """page_id, title, page_len of main-namespace pages that are no redirects.  A null namespace is another, a null redirect flag is none; an empty title is no page."""
    rows = pages.where(F.col("ns").eqNullSafe(0) & ~F.col("is_redirect").eqNullSafe(1) & (F.col("title") != ""))
    return rows.select("page_id", "title", F.coalesce("page_len", F.lit(0)).alias("page_len"))
