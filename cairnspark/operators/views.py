"""Median monthly views of pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INT_MAX = 2147483647


def monthly_totals(views: DataFrame, pages: DataFrame) -> DataFrame:
    """page_id, month, views: rows that name the page and rows that only have its title, together.

    views: month, page_id, title, views; pages: page_id, title.
    """
    by_id = views.where("page_id is not null").groupBy("page_id", "month").agg(F.sum("views").alias("views"))
    by_title = views.where("page_id is null").groupBy("title", "month").agg(F.sum("views").alias("views"))
    ids = by_id.join(pages.select("page_id"), "page_id").select("page_id", "month", "views")
    titles = by_title.join(pages.select("page_id", "title"), "title").select("page_id", "month", "views")
    return ids.unionByName(titles).groupBy("page_id", "month").agg(F.sum("views").alias("views"))


def median_views(views: DataFrame, pages: DataFrame) -> DataFrame:
    """page_id, views: the median over all months of ``views``, months without a row counting as zero, as an integer (halves to even, at most INT_MAX).  Pages of no month are left out.

    The grid of pages and months is not built: a page's months, a handful, are
    collected, and the zeros of the other months stand before
    them in order.
    """
    months = views.agg(F.count_distinct("month")).scalar()
    per_page = monthly_totals(views, pages).groupBy("page_id").agg(F.array_sort(F.collect_list("views")).alias("v"))
    n = months.cast("int")
    # place k of the sorted, zero-filled list of n (views are not negative)
    at = lambda k: F.coalesce(F.when(k >= n - F.size("v"), F.get("v", k - (n - F.size("v")))), F.lit(0))
    low, high = F.floor((n - 1) / 2).cast("int"), F.floor(n / 2).cast("int")
    median = (at(low).cast("double") + at(high).cast("double")) / 2
    return per_page.select("page_id", F.least(F.bround(median, 0), F.lit(float(INT_MAX))).cast("int").alias("views"))
