"""The article table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import hilbert, wkb_point
from ..functions.titles import article_url, label_of
from ..schemas import ARTICLE


def assemble(pages: DataFrame) -> DataFrame:
    """ARTICLE rows of pages that have all their parts; what may be missing is left null or made empty as the schema says."""
    lon, lat = F.col("lon"), F.col("lat")
    made = {
        "geometry": wkb_point(lon, lat),
        "label": label_of(F.col("title")),
        "wikipedia_url": article_url(F.col("title")),
        "bbox": F.struct(lon.alias("xmin"), lat.alias("ymin"), lon.alias("xmax"), lat.alias("ymax")),
    }
    out = []
    for f in ARTICLE:
        kind = f.dataType.simpleString()
        c = made.get(f.name, F.col(f.name) if f.name in pages.columns else F.lit(None))
        if kind == "string" and f.name != "osm_source":
            c = F.coalesce(c, F.lit(""))
        elif kind == "array<string>":
            c = F.coalesce(c, F.array().cast(kind))
        elif f.name in ("page_len", "inlink_count", "elevation"):
            c = F.coalesce(c, F.lit(0))
        out.append(c.cast(f.dataType).alias(f.name))
    return pages.where(F.col("title") != "").select(*out)


def spatially_sorted(articles: DataFrame, parts: int | None = None) -> DataFrame:
    """Dealt by ranges of the Hilbert key and sorted by it: neighbours on the map are neighbours in the files."""
    keyed = articles.withColumn("__hilbert", hilbert(F.col("bbox.xmin"), F.col("bbox.ymin")))
    dealt = keyed.repartitionByRange(parts, "__hilbert", "page_id") if parts else keyed.repartitionByRange("__hilbert", "page_id")
    return dealt.sortWithinPartitions("__hilbert", "page_id").drop("__hilbert")
