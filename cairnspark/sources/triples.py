"""RDF triples, one to a line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rdf import LINE_FORM, PROPERTIES
from .insert_dump import ordered_lines


def triples(lines: DataFrame) -> DataFrame:
    """seq, qid, prop, value of the wanted properties' lines.  lines: value, and seq where order matters.

    A cheap test for the property comes before the pattern.
    """
    if "seq" not in lines.columns:
        lines = lines.withColumn("seq", F.monotonically_increasing_id())
    wanted = F.col("value").rlike("/direct/(" + "|".join(PROPERTIES) + ")>")
    parts = [F.regexp_extract("value", LINE_FORM, k) for k in (1, 2, 3)]
    rows = lines.where(wanted).select("seq", parts[0].alias("qid"), parts[1].alias("prop"), parts[2].alias("value"))
    return rows.where((F.col("qid") != "") & F.col("prop").isin(*PROPERTIES))


def read_triples(spark: SparkSession, path: str) -> DataFrame:
    return triples(ordered_lines(spark, path))
