"""Queries that a reader's map asks: what is notable, in this box, of this name, on this page."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import display
from ..functions.geo import wkt_point


def most_notable(articles: DataFrame, k: int = 20) -> DataFrame:
    top = articles.orderBy(F.col("inlink_count").desc(), F.col("page_id").asc()).limit(k)
    return top.select("page_id", "label", "instance_of", "country", "inlink_count", wkt_point(F.col("bbox.xmin"), F.col("bbox.ymin")).alias("point"))


def in_box(articles: DataFrame, xmin: float, ymin: float, xmax: float, ymax: float, k: int = 20) -> DataFrame:
    """The most linked articles of a box.  The bounds reach the scan through the bbox column, whose row groups are apart on the map."""
    inside = articles.where(F.col("bbox.xmin").between(xmin, xmax) & F.col("bbox.ymin").between(ymin, ymax))
    return inside.orderBy(F.col("inlink_count").desc(), F.col("page_id").asc()).limit(k).select("page_id", "label", "instance_of", "country", "inlink_count")


def search(index: DataFrame, text: str, k: int = 8) -> DataFrame:
    """The most linked labels that begin with ``text``: a range of the sorted index, from it up to it and a tilde.

    Labels whose next character is beyond ASCII lie outside that range, as they
    do in the map's own search; ``begins_with`` has them.
    """
    q = text.lower()
    rows = index.where((F.col("label") >= q) & (F.col("label") < q + "~")) if q.strip() else index.limit(0)
    return rows.orderBy(F.col("inlink_count").desc(), F.col("label").asc(), F.col("lon").asc()).limit(k).select("label", "lon", "lat", display.title_case(F.col("label")).alias("title"))


def begins_with(index: DataFrame, text: str, k: int = 8) -> DataFrame:
    return index.where(F.col("label").startswith(text.lower())).orderBy(F.col("inlink_count").desc(), F.col("label").asc(), F.col("lon").asc()).limit(k).select("label", "lon", "lat")


def page_of(rows: DataFrame, order: list, size: int, offset: int) -> DataFrame:
    """``size`` rows from place ``offset`` (0 is the first) in a total order."""
    return rows.orderBy(*order).offset(offset).limit(size)


def details(articles: DataFrame, page_id: int) -> DataFrame:
    """What a popup shows of a page."""
    columns = ("description", "image_url", "gt_type", "page_len", "elevation", "instance_of", "country", "population")
    return articles.where(F.col("page_id") == page_id).limit(1).select(*columns)


def by_label(articles: DataFrame, label: str) -> DataFrame:
    """Rows of a label; the text is a parameter, never part of the query."""
    return articles.sparkSession.sql("SELECT * FROM {articles} WHERE label = :label", args={"label": label}, articles=articles)


def popups(articles: DataFrame) -> DataFrame:
    c = F.col
    text = display.popup_text(c("instance_of"), c("gt_type"), c("country"), c("population"), c("page_len"), c("inlink_count"), c("elevation"))
    return articles.select("page_id", text.alias("popup"), display.circle_radius(c("inlink_count")).alias("radius"))
