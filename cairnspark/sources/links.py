"""Link tables of the dumps.  Only main-namespace rows are looked at: the pattern holds the namespace, other rows are never taken apart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .insert_dump import unescaped

LINK_TARGET = r"(?s)\((\d+),0,'((?:[^'\\]++|\\.)*+)'\)"
PAGE_LINK = r"\((\d+),0,(\d+)\)"


def link_targets(lines: DataFrame) -> DataFrame:
    """target_id, title of a link-target dump's main-namespace rows.  lines: value."""
    v = F.make_valid_utf8(F.col("value"))
    pairs = F.arrays_zip(F.regexp_extract_all(v, F.lit(LINK_TARGET), F.lit(1)).alias("id"), F.regexp_extract_all(v, F.lit(LINK_TARGET), F.lit(2)).alias("title"))
    rows = lines.where(F.contains("value", F.lit(",0,'"))).select(F.explode(pairs).alias("p"))
    title = F.when(F.contains("p.title", F.lit("\\")), unescaped(F.col("p.title"))).otherwise(F.col("p.title"))
    return rows.select(F.col("p.id").cast("long").alias("target_id"), title.alias("title"))


def page_links(lines: DataFrame) -> DataFrame:
    """target_id of each link from a main-namespace page: a row for each link."""
    found = F.regexp_extract_all("value", F.lit(PAGE_LINK), F.lit(2))
    return lines.where(F.contains("value", F.lit(",0,"))).select(F.explode(F.transform(found, lambda x: x.cast("long"))).alias("target_id"))
