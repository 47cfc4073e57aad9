"""Inbound links of articles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def inlink_counts(links: DataFrame, targets: DataFrame, pages: DataFrame) -> DataFrame:
    """page_id, inlink_count.  Every link counts whose target has a page's title, links to itself as well.

    links: target_id; targets: target_id, title; pages: page_id, title.  Links
    are counted by target before any join, so that a page with a large share
    of all links is a row by then.
    """
    per_target = links.groupBy("target_id").agg(F.count(F.lit(1)).alias("n"))
    wanted = targets.join(pages.select("page_id", "title"), "title").select("target_id", "page_id")
    return wanted.join(per_target, "target_id").groupBy("page_id").agg(F.sum("n").cast("long").alias("inlink_count"))


def with_inlinks(pages: DataFrame, counts: DataFrame) -> DataFrame:
    return pages.join(counts, "page_id", "left").withColumn("inlink_count", F.coalesce("inlink_count", F.lit(0)).cast("int"))
