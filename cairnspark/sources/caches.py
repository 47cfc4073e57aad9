"""Which cached files a build reads: the last months, the newest extract, the entity cache of any age."""

from __future__ import annotations

import datetime
import warnings

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.months import month_names
from ..schemas import ENTITY, PAGEVIEW_MONTH
from .footers import is_complete

LOOKBACK_MONTHS = 12
MONTH_IN_NAME = r"(\d{4})-?(\d{2})"


def _kind(path: str) -> str:
    """file, folder or nothing, on any file system that has a URI."""
    fs, inner = pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)
    return {pafs.FileType.File: "file", pafs.FileType.Directory: "folder"}.get(fs.get_file_info(inner).type, "")


def available_months(spark: SparkSession, folder: str) -> DataFrame:
    """month, file: what a folder has, by the months in the files' names; listed by Spark's own file systems."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(at)
    rows = spark.createDataFrame([(f.getPath().getName(),) for f in found], "file string")
    month = F.concat_ws("-", F.regexp_extract("file", MONTH_IN_NAME, 1), F.regexp_extract("file", MONTH_IN_NAME, 2))
    return rows.where(F.col("file").rlike(MONTH_IN_NAME) & ~F.col("file").rlike("^[._]")).select(month.alias("month"), "file")


def month_paths(folder: str, n: int, day: datetime.date, form: str = "{month}.parquet") -> dict[str, str]:
    """month -> file, of the last ``n`` months before that of ``day``.  Missing and incomplete ones are left out with a warning."""
    have = {}
    for month in month_names(n, day):
        path = f"{folder.rstrip('/')}/{form.format(month=month)}"
        kind = _kind(path)
        if not kind:
            warnings.warn(f"no extract for {month}", stacklevel=2)
        elif kind == "file" and not is_complete(path):
            warnings.warn(f"{path} is marked as incomplete", stacklevel=2)
        else:
            have[month] = path
    return have


def newest(folder: str, day: datetime.date, form: str = "extent-{month}.parquet", months: int = LOOKBACK_MONTHS) -> str | None:
    """The newest extract of this month and those before it; null beyond ``months``."""
    paths = (f"{folder.rstrip('/')}/{form.format(month=m)}" for m in month_names(months, day, current=True))
    return next((p for p in paths if _kind(p)), None)


def read_months(spark: SparkSession, paths: list[str]) -> DataFrame:
    """All months as one table."""
    return spark.read.schema(PAGEVIEW_MONTH).parquet(*paths)


def read_entities(spark: SparkSession, path: str) -> DataFrame:
    """The entity cache, whatever columns its age has: without the class's identifier that is the class itself; without a relation there is none.  Missing strings and lists are empty."""
    df = spark.read.parquet(path)
    have = set(df.columns)
    qid = F.coalesce(F.nullif("instance_of_qid", F.lit("")), F.col("instance_of")) if "instance_of_qid" in have else F.col("instance_of")
    relation = F.col("osm_relation") if "osm_relation" in have else F.lit(None).cast("long")
    df = df.withColumns({"instance_of_qid": qid, "osm_relation": relation})
    empty = {"string": F.lit(""), "array<string>": F.array().cast("array<string>")}
    return df.select(*[F.coalesce(F.col(f.name), empty[f.dataType.simpleString()]).alias(f.name) if f.dataType.simpleString() in empty else F.col(f.name).cast(f.dataType) for f in ENTITY])
