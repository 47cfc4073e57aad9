"""The driver's tables in the engine's terms: articles, points, features and views derived from orders, lineitem and events.

Each relation is one SELECT that Spark and an oracle both read; what their
dialects have in different words is put in by name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SPARK = {"list2": "array('a', 'b')", "list0": "cast(array() AS array<string>)", "day": "date_format(ts, 'yyyy-MM-dd')"}
ORACLE = {"list2": "['a', 'b']", "list0": "CAST([] AS VARCHAR[])", "day": "strftime(ts, '%Y-%m-%d')"}

POINTS = """
SELECT CAST(o_orderkey AS INT) AS page_id, CAST((o_orderkey * 7919) % 36000 AS DOUBLE) / CAST(100 AS DOUBLE) - 180 AS lon,
       CAST((o_orderkey * 104729) % 18000 AS DOUBLE) / CAST(100 AS DOUBLE) - 90 AS lat,
       CAST(floor(o_totalprice) AS INT) % 20000 AS inlink_count
FROM orders
"""

ARTICLES = """
SELECT page_id, concat('Q', custkey) AS qid,
       CASE page_id WHEN 5 THEN 'Machu Picchu' WHEN 6 THEN 'Mount Rushmore' WHEN 7 THEN 'Lake Superior' WHEN 33 THEN 'Black Hills'
            ELSE concat(replace(c_name, '#', ' '), ' ', page_id) END AS label, description, instance_of,
       CASE WHEN instance_of = '' THEN '' ELSE concat('Q', page_id % 5) END AS instance_of_qid,
       CASE WHEN page_id % 7 = 0 THEN '' ELSE n_name END AS country,
       CASE WHEN page_id % 3 = 0 THEN NULL ELSE CAST(floor(price) AS BIGINT) * 10 END AS population,
       CASE WHEN page_id % 9 = 0 THEN '' ELSE concat('', page_id) END AS geonames_id,
       CAST(page_id % 3000 AS SMALLINT) AS elevation, gt_type, CAST(floor(price) AS INT) AS page_len, inlink_count,
       CASE WHEN page_id % 2 = 0 THEN '' ELSE concat('https://i/', page_id) END AS image_url,
       CASE WHEN page_id % 4 = 0 THEN {list2} ELSE {list0} END AS related_images,
       CASE WHEN page_id % 4 = 1 THEN NULL ELSE page_id % 1000 END AS pageviews_month,
       CASE WHEN page_id % 6 = 0 THEN NULL ELSE CAST(page_id % 500 + 1 AS FLOAT) END AS extent_km,
       CASE WHEN page_id % 6 <= 1 THEN NULL ELSE CAST(page_id % 500 + 1 AS FLOAT) / CAST(2 AS FLOAT) END AS area_km2,
       CASE WHEN page_id % 6 = 0 THEN NULL ELSE concat('way/', page_id) END AS osm_source, lon, lat
FROM (
  SELECT p.*, o.o_custkey AS custkey, o.o_totalprice AS price, o.o_orderpriority AS description, o.o_orderstatus AS gt_type, c.c_name, n.n_name,
         CASE p.page_id % 5 WHEN 0 THEN '' WHEN 1 THEN 'mountain' WHEN 2 THEN 'city park' WHEN 3 THEN 'railway station' ELSE 'Lake' END AS instance_of
  FROM ({points}) p JOIN orders o ON o.o_orderkey = p.page_id JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
) x
"""

FEATURES = """
SELECT CASE WHEN l_linenumber % 2 = 0 THEN 'relation' ELSE 'way' END AS osm_type, l_orderkey * 8 + l_linenumber AS osm_id, concat('Q', l_partkey) AS qid,
       CASE WHEN l_suppkey % 2 = 0 THEN 'en' ELSE 'de' END AS wiki_lang, concat('T', l_suppkey) AS wiki_title,
       CAST(l_quantity AS FLOAT) AS extent_km, CAST(l_quantity / 2 AS FLOAT) AS area_km2
FROM lineitem
"""

FEATURE_PAGES = """
SELECT CAST(o_orderkey AS INT) AS page_id, concat('Q', o_custkey) AS qid, concat('T', o_orderkey) AS title,
       CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey * 8 + 2 ELSE NULL END AS osm_relation
FROM orders
"""

VIEWS = """
SELECT {day} AS month, CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(user_id AS INT) END AS page_id,
       CASE WHEN event_id % 3 = 0 THEN concat('user_', user_id) ELSE NULL END AS title, CAST(floor(value) AS BIGINT) AS views
FROM events
"""

VIEW_PAGES = "SELECT CAST(c_custkey AS INT) AS page_id, concat('user_', c_custkey) AS title FROM customer"

#: What is written of the stand-in's articles.
ARTICLE_COLUMNS = (
    "geometry", "page_id", "qid", "label", "instance_of", "country", "population", "elevation", "inlink_count", "pageviews_month", "extent_km", "area_km2", "osm_source", "bbox",
)

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages")


def oracle(text: str) -> str:
    return text.format(points=POINTS, **ORACLE) if "{" in text else text


def frame(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """The SELECT over the folder's tables; they are parameters of this query alone, no views are made."""
    text = text.format(points=POINTS, **SPARK) if "{" in text else text
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if f" {t}\n" in text + "\n" or f" {t} " in text}
    for t in used:
        text = text.replace(f"FROM {t}", f"FROM {{{t}}}").replace(f"JOIN {t}", f"JOIN {{{t}}}")
    return spark.sql(text, **used)


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With geometry and bbox, as the engine's operators expect them."""
    from pyspark.sql import functions as F

    from ..functions.geo import wkb_point

    box = F.struct(F.col("lon").alias("xmin"), F.col("lat").alias("ymin"), F.col("lon").alias("xmax"), F.col("lat").alias("ymax"))
    return frame(spark, sf_dir, ARTICLES).withColumns({"geometry": wkb_point(F.col("lon"), F.col("lat")), "bbox": box})
