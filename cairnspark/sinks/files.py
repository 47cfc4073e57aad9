"""The other outputs: caches, search index, features for tiles, label cache."""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import geojson_point, mercator_tile
from ..operators.labels import merged


def write_cache(df: DataFrame, path: str, force: bool = False) -> None:
    """Parquet that is written once: left alone if it is there, unless forced.  Spark's committer publishes whole files only."""
    df.write.mode("overwrite" if force else "ignore").option("compression", "zstd").parquet(path)


def search_index(articles: DataFrame) -> DataFrame:
    """label (lower case), lon, lat, inlink_count."""
    return articles.select(F.lower("label").alias("label"), F.col("bbox.xmin").alias("lon"), F.col("bbox.ymin").alias("lat"), "inlink_count")


def write_search_index(articles: DataFrame, path: str) -> None:
    """Sorted over all files: a prefix lies in a range of one file's row groups or of two neighbours'."""
    search_index(articles).orderBy("label", "lon", "lat").write.mode("overwrite").option("compression", "zstd").option("parquet.block.row.count.limit", 25_000).parquet(path)


def features(articles: DataFrame) -> DataFrame:
    """value: a GeoJSON feature per article, null properties kept."""
    point = F.from_json(geojson_point(F.col("bbox.xmin"), F.col("bbox.ymin")), "type string, coordinates array<double>")
    properties = F.struct("page_id", "label", "inlink_count", "instance_of_qid")
    feature = F.struct(F.lit("Feature").alias("type"), point.alias("geometry"), properties.alias("properties"))
    return articles.select(F.to_json(feature, {"ignoreNullFields": "false"}).alias("value"))


def write_features(articles: DataFrame, path: str) -> None:
    features(articles).write.mode("overwrite").text(path)


def tile_selection(points: DataFrame, zoom: int, most: int, lon: str = "lon", lat: str = "lat", rank: str = "inlink_count", key: str = "page_id") -> DataFrame:
    """z, x, y and the points' columns: the ``most`` points of each tile with the most links (of equal ones the smallest key).

    A rank below a bound: Spark keeps the best of each task before the shuffle,
    so that a crowded tile sends no more than its selection from each.
    """
    from pyspark.sql import Window

    tiled = points.withColumn("__t", mercator_tile(F.col(lon), F.col(lat), zoom)).select("__t.z", "__t.x", "__t.y", *points.columns)
    n = F.row_number().over(Window.partitionBy("z", "x", "y").orderBy(F.col(rank).desc(), F.col(key).asc()))
    return tiled.withColumn("__n", n).where(F.col("__n") <= most).drop("__n")


def write_label_cache(old: DataFrame, new: DataFrame, path: str) -> int:
    """One JSON object by key, both caches merged, the new one first; returns its size.  A label cache is a file that the driver reads and writes."""
    rows = merged(old, new).orderBy("qid").toLocalIterator()
    draft, n = f"{path}.{uuid.uuid4().hex[:8]}", 0
    with open(draft, "w", encoding="utf-8") as f:
        f.write("{")
        for r in rows:
            f.write(("," if n else "") + f"\n{json.dumps(r['qid'])}: {json.dumps(r['label'], ensure_ascii=False)}")
            n += 1
        f.write("\n}\n")
    os.replace(draft, path)
    return n
