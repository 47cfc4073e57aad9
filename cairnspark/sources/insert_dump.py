"""SQL dumps: the tuples of INSERT statements, by regular expressions within Spark.

A dump file holds one table, as whole statements on a line or one tuple to a
line.  Lines are read as text (gzip and bzip2 by their names), tuples found by a
pattern that steps over quoted text, so that ``),(`` or ``;`` inside a string
ends nothing, and fields by a second one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUOTED = r"'(?:[^'\\]++|\\.)*+'"
TUPLE = rf"(?s)\((?:{QUOTED}|[^'()]++)*+\)"
FIELD = rf"(?s)(?<=[(,])(?:{QUOTED}|[^',()]*+)(?=[,)])"
#: Stands for an escaped backslash while the other escapes are resolved; no character of Unicode text.
HOLD = "﷐"


def unescaped(s: Column) -> Column:
    r"""Escapes of a string resolved: \n \t \r \0 \b \Z, any other character stands for itself."""
    s = F.replace(s, F.lit("\\\\"), F.lit(HOLD))
    for escape, char in (("n", "\n"), ("t", "\t"), ("r", "\r"), ("0", "\0"), ("b", "\b"), ("Z", "\x1a")):
        s = F.replace(s, F.lit("\\" + escape), F.lit(char))
    return F.replace(F.regexp_replace(s, r"(?s)\\(.)", "$1"), F.lit(HOLD), F.lit("\\"))


def _value(raw: Column) -> Column:
    text = F.substring(raw, 2, F.length(raw) - 2)
    return F.when(raw == "NULL", F.lit(None).cast("string")).when(raw.startswith("'"), F.when(F.contains(raw, F.lit("\\")), unescaped(text)).otherwise(text)).otherwise(raw)


def tuples(lines: DataFrame, table: str) -> DataFrame:
    """seq, fields (array of string; NULL is null, quoted NULL a string): a row for each tuple.

    lines: value, and seq (of any type that has an order) where order matters.
    The tuples' ``seq`` is a struct of the line's and of the place within it.  Bytes that are no UTF-8 become
    U+FFFD.
    """
    if "seq" not in lines.columns:
        lines = lines.withColumn("seq", F.monotonically_increasing_id())
    value = F.make_valid_utf8(F.col("value"))
    head = F.col("value").startswith(f"INSERT INTO `{table}` VALUES")
    rows = lines.where(head | F.ltrim("value").startswith("("))
    found = rows.select("seq", F.posexplode(F.regexp_extract_all(value, F.lit(TUPLE), F.lit(0))).alias("k", "tuple"))
    fields = F.transform(F.regexp_extract_all("tuple", F.lit(FIELD), F.lit(0)), _value)
    return found.select(F.struct(F.col("seq").alias("line"), "k").alias("seq"), fields.alias("fields"))


def ordered_lines(spark: SparkSession, path: str) -> DataFrame:
    """value, seq: the lines of files.  ``seq`` is in the order of paths, of splits within a file, of lines within a split, whatever order Spark reads splits in."""
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("line"))
    return spark.read.text(path).select("value", place.alias("seq"))


def read_dump(spark: SparkSession, path: str, table: str) -> DataFrame:
    """``tuples`` of a dump file, or of several in the order of their paths."""
    return tuples(ordered_lines(spark, path), table)


def columns(rows: DataFrame, least: int, **at: tuple[int, str]) -> DataFrame:
    """seq and named, typed fields of the tuples that have ``least`` fields; what cannot be read as its type is null."""
    long = rows.where(F.size("fields") >= least)
    return long.select("seq", *[F.get("fields", F.lit(i)).try_cast(kind).alias(name) for name, (i, kind) in at.items()])


# Positions of the fields that are used.
def page_props(rows: DataFrame) -> DataFrame:
    return columns(rows, 3, page_id=(0, "int"), propname=(1, "string"), value=(2, "string"))


def geo_tags(rows: DataFrame) -> DataFrame:
    return columns(rows, 8, page_id=(1, "int"), globe=(2, "string"), is_primary=(3, "int"), gt_type=(7, "string"))


def pages(rows: DataFrame) -> DataFrame:
    return columns(rows, 10, page_id=(0, "int"), ns=(1, "int"), title=(2, "string"), is_redirect=(3, "int"), page_len=(9, "int"))
