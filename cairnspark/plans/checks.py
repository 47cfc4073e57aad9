"""Quality checks of a finished article table: one aggregation for all of them."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import footers


# The bounds within which a full build is taken as sound, and well-known articles.
@dataclass(frozen=True)
class Bounds:
    rows: tuple[int, int] = (400_000, 3_000_000)
    coverage: float = 0.3
    viewed: float = 0.5
    linked: float = 0.5
    top_links: int = 10_000
    elevation: tuple[int, int] = (-12_000, 9_000)
    longest_km: int = 20_000
    known_elevation: dict[str, tuple[float, float]] = field(default_factory=lambda: {"Machu Picchu": (1800, 3000)})
    known_views: dict[str, tuple[float, float]] = field(default_factory=lambda: {"Mount Rushmore": (10_000, 1_000_000), "Coon Rapids Dam": (50, 5_000)})
    known_extent: dict[str, tuple[float, float]] = field(default_factory=lambda: {"Lake Superior": (500, 700)})


TIERS = (50, 500, 2000, 5000)
WELL_KNOWN = ("Eiffel Tower", "Statue of Liberty", "Great Wall of China", "Machu Picchu", "Taj Mahal", "Colosseum", "Sydney Opera House")
RAW_IDENTIFIER = r"^Q[0-9]+\z"


def _n(condition: Column) -> Column:
    return F.count_if(condition)


def _known(values: dict[str, tuple[float, float]], column: str, must: bool) -> dict[str, Column]:
    """A named article's value within its range; if it is missing, the check fails (``must``) or passes."""
    out = {}
    for label, (low, high) in values.items():
        v = F.max(F.when(F.col("label") == label, F.col(column)))
        out[f"{label}: {column} within {low:g} to {high:g}"] = F.coalesce(v.between(low, high), F.lit(not must))
    return out


def checks(articles: DataFrame, bounds: Bounds | None = None) -> dict[str, Column]:
    """name -> aggregate that is true if the check passes.  Checks of optional columns are left out where the column is."""
    b, have, c = bounds or Bounds(), set(articles.columns), F.col
    n = F.count(F.lit(1))
    lon, lat = c("bbox.xmin"), c("bbox.ymin")
    out = {
        "rows within bounds": n.between(*b.rows),
        "no geometry is null": _n(c("geometry").isNull()) == 0,
        "coordinates in range": _n(~(lon.between(-180, 180) & lat.between(-90, 90))) == 0,
        "instance_of covers enough": _n(c("instance_of") != "") > n * b.coverage,
        "country covers enough": _n(c("country") != "") > n * b.coverage,
        "instance_of has no raw identifiers": _n(c("instance_of").rlike(RAW_IDENTIFIER)) == 0,
        "country has no raw identifiers": _n(c("country").rlike(RAW_IDENTIFIER)) == 0,
        "some article has many inlinks": F.coalesce(F.max("inlink_count") > b.top_links, F.lit(False)),
        "enough articles have inlinks": _n(c("inlink_count") > 0) > n * b.linked,
        "elevation is never null": _n(c("elevation").isNull()) == 0,
        "elevation is not too low": F.coalesce(F.min("elevation") > b.elevation[0], F.lit(False)),
        "elevation is not too high": F.coalesce(F.max("elevation") < b.elevation[1], F.lit(False)),
    }
    if "instance_of_qid" in have:
        q = c("instance_of_qid")
        out |= {
            "instance_of_qid covers enough": _n(q != "") > n * b.coverage,
            "instance_of_qid is well formed": _n((q != "") & ~q.rlike(RAW_IDENTIFIER)) == 0,
            # one way only: an identifier without an English label keeps no label
            "instance_of implies instance_of_qid": _n((c("instance_of") != "") & (q == "")) == 0,
        }
    if "pageviews_month" in have:
        seen = F.count("pageviews_month")
        out |= {"enough articles have views": seen > n * b.viewed, "some articles have no views": n > seen} | _known(b.known_views, "pageviews_month", True)
    if {"extent_km", "area_km2", "osm_source"} <= have:
        e, a, s = c("extent_km"), c("area_km2"), c("osm_source")
        out |= {
            "extent, area and source agree": _n((e.isNull() != s.isNull()) | (a.isNotNull() & e.isNull())) == 0,
            "extent and area are plausible": _n((e <= 0) | (e > b.longest_km) | (a <= 0)) == 0,
        } | _known(b.known_extent, "extent_km", False)
    return out | _known(b.known_elevation, "elevation", False)


def run_checks(articles: DataFrame, bounds: Bounds | None = None) -> DataFrame:
    """name, passed: a row per check, in order, from one pass."""
    made = checks(articles, bounds)
    pairs = F.array(*[F.struct(F.lit(k).alias("name"), v.alias("passed")) for k, v in made.items()])
    return articles.agg(pairs.alias("c")).select(F.explode("c").alias("c")).select("c.name", "c.passed")


def missing_labels(articles: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """Labels of ``expected`` (the well-known ones) that no article has."""
    if expected is None:
        expected = articles.sparkSession.createDataFrame([(x,) for x in WELL_KNOWN], "label string")
    return expected.join(articles.select("label").distinct(), "label", "left_anti")


def file_checks(spark: SparkSession, paths: list[str]) -> DataFrame:
    """name, passed, of the footers of all files: geo metadata with its primary column, encoding and covering; columns and their types; months on record."""
    types: dict[str, dict] = {p: {} for p in paths}
    values: dict[str, dict] = {p: {} for p in paths}
    for r in footers.columns(spark, paths).collect():  # some dozens of rows a file
        types[r["file"]][r["name"]] = r["type"]
    for r in footers.key_values(spark, paths).collect():
        values[r["file"]][r["key"]] = r["value"]
    passed: dict[str, bool] = {}
    for p in paths:
        for name, fine in _footer_checks(types[p], values[p]):
            passed[name] = passed.get(name, True) and fine
    return spark.createDataFrame(list(passed.items()), "name string, passed boolean")


def _footer_checks(types: dict[str, str], values: dict[str, str]) -> list[tuple[str, bool]]:
    geo = json.loads(values.get("geo", "{}"))
    column = geo.get("columns", {}).get(geo.get("primary_column", ""), {})
    return [
        ("geo metadata is there", bool(geo)),
        ("primary column is geometry", geo.get("primary_column") == "geometry"),
        ("geometry is WKB", column.get("encoding") == "WKB"),
        ("bbox covers the geometry", "bbox" in column.get("covering", {})),
        ("bbox column is there", "bbox.xmin" in types),
        ("pageviews_month is INT32", types.get("pageviews_month") == "INT32"),
        ("months are on record", "pageviews_months" in values),
        *((f"{c} is {t}", types.get(c) == t) for c, t in (("extent_km", "FLOAT"), ("area_km2", "FLOAT"), ("osm_source", "BYTE_ARRAY"))),
    ]


class ChecksFailed(ValueError):
    """Some checks did not pass; the message names them."""


def tally(results: DataFrame) -> DataFrame:
    """passed, failed: how many checks did either.  A null counts as failed."""
    fine = F.coalesce(F.col("passed"), F.lit(False))
    return results.agg(F.count_if(fine).alias("passed"), F.count_if(~fine).alias("failed"))


def require(results: DataFrame) -> int:
    """The number of checks that passed; ChecksFailed if any did not."""
    rows = results.collect()  # one row a check
    if failed := [r["name"] for r in rows if not r["passed"]]:
        raise ChecksFailed(f"{len(failed)} of {len(rows)}: " + "; ".join(failed))
    return len(rows)


def breakdown(df: DataFrame, column: str, k: int) -> DataFrame:
    """The ``k`` most frequent values with their share in percent."""
    total = df.agg(F.count(F.lit(1))).scalar()
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.col("n").desc(), F.col("value").asc_nulls_last()).limit(k).select("value", "n", (F.col("n") * F.lit(100.0) / total).alias("percent"))


def profile(articles: DataFrame) -> DataFrame:
    """Counts, extremes and means that a build prints, in one row."""
    c = F.col
    return articles.agg(
        F.count(F.lit(1)).alias("n"), _n(c("qid") != "").alias("with_qid"), _n(c("instance_of") != "").alias("with_class"), _n(c("country") != "").alias("with_country"),
        F.count("population").alias("with_population"), _n(c("geonames_id") != "").alias("with_geonames"), _n(c("image_url") != "").alias("with_image"),
        _n(F.size("related_images") > 0).alias("with_related"), _n(c("gt_type") != "").alias("with_type"), F.count("pageviews_month").alias("with_views"),
        F.count("extent_km").alias("with_extent"), F.count("area_km2").alias("with_area"),
        F.max("inlink_count").alias("top_links"), F.min("elevation").alias("lowest"), F.max("elevation").alias("highest"),
        F.avg("elevation").alias("mean_elevation"), F.avg("page_len").alias("mean_len"), F.max("page_len").alias("longest"),
    )


def tiers(articles: DataFrame) -> DataFrame:
    """tier, n: articles with at least so many inlinks (0: more than none)."""
    made = F.array(*[F.struct(F.lit(t).alias("tier"), _n(F.col("inlink_count") >= max(1, t)).alias("n")) for t in (0, *TIERS)])
    return articles.agg(made.alias("t")).select(F.explode("t").alias("t")).select("t.tier", "t.n")
