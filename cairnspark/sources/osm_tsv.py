"""Map features as the tab-separated answer of an endpoint: feature, entity, article, envelope, area."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo
from ..functions.titles import wiki_reference

# The form of a feature's address, the first name of the header.
FEATURE_FORM = r"^<https://www\.openstreetmap\.org/(way|relation)/(\d+)>"
HEADER = "?x"


class UnexpectedAnswer(ValueError):
    """The answer does not begin with the header."""


def features(lines: DataFrame) -> DataFrame:
    """The lines of an answer (value; no header) as features.  Lines of fewer than five fields, of other kinds of objects, or without an envelope give none."""
    f = F.split("value", "\t")
    field = lambda k: F.get(f, F.lit(k))
    rows = lines.where(F.size(f) >= 5).select(
        F.regexp_extract(field(0), FEATURE_FORM, 1).alias("osm_type"), F.regexp_extract(field(0), FEATURE_FORM, 2).alias("id"),
        F.nullif(F.regexp_extract(field(1), r"(Q\d+)", 1), F.lit("")).alias("qid"),
        wiki_reference(field(2)).alias("wiki"), geo.envelope(field(3)).alias("box"), geo.area_km2(field(4)).alias("area"),
    )
    rows = rows.where((F.col("osm_type") != "") & F.col("box").isNotNull())
    box = [F.col(f"box.{k}") for k in ("xmin", "ymin", "xmax", "ymax")]
    return rows.select(
        "osm_type", F.col("id").cast("long").alias("osm_id"), "qid", F.col("wiki.lang").alias("wiki_lang"), F.col("wiki.title").alias("wiki_title"),
        *box, geo.crosses_antimeridian(box[0], box[2]).alias("antimeridian"),
        geo.extent_km(*box).cast("float").alias("extent_km"), F.col("area").cast("float").alias("area_km2"),
    )


def read_answers(spark: SparkSession, path: str) -> DataFrame:
    """Features of landed answers, one file a page; each must begin with the header."""
    lines = spark.read.text(path).select("value", F.input_file_name().alias("file"))
    per_file = lines.groupBy("file").agg(F.count_if(F.substring_index("value", "\t", 1) == HEADER).alias("n"))
    bad = per_file.where("n = 0").select("file").first()
    if bad:
        raise UnexpectedAnswer(bad["file"])
    return features(lines.where(F.substring_index("value", "\t", 1) != HEADER))


def paged(query: Callable[[int, int], str], page: int = 250_000) -> Iterator[str]:
    """Answers of ``query(limit, offset)``, until one has fewer than ``page`` lines below its header.  The caller lands them as files."""
    offset = 0
    while True:
        answer = query(page, offset)
        lines = answer.splitlines()
        if not lines or lines[0].split("\t")[0] != HEADER:
            raise UnexpectedAnswer(answer[:200])
        yield answer
        if len(lines) - 1 < page:
            return
        offset += page


def feature_families(objects: DataFrame, wikidata: DataFrame, wikipedia: DataFrame, envelope: DataFrame, area: DataFrame) -> DataFrame:
    """x, qid, wp, env, area: the two families of typed objects (x).  Those with an entity, and those with an article and no entity; article and area may be missing."""
    extra = lambda df: df.join(envelope, "x").join(area, "x", "left")
    first = extra(objects.join(wikidata, "x")).join(wikipedia, "x", "left").select("x", "qid", "wp", "env", "area")
    second = extra(objects.join(wikidata, "x", "left_anti").join(wikipedia, "x")).select("x", F.lit(None).cast("string").alias("qid"), "wp", "env", "area")
    return first.unionByName(second)
