"""Traffic months as they come in: new files only, by a stream that stops when it has caught up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.pageviews import ARTICLE, PROJECT, views_and_marks

MONTH_IN_NAME = r"(\d{4})-?(\d{2})"
STORED = "month string, file string, page_id int, title string, views long"


def ingest_months(spark: SparkSession, folder: str, out: str, checkpoint: str, project: str = PROJECT) -> None:
    """Add the files in ``folder`` that the checkpoint has not seen to ``out``, partitioned by month and file.

    The month is in the file's name.  A file that does not go from the project
    to a later one is a partial month: none of it is published, its name is
    kept (``refused``).  Every trigger reads its files once, writes what it made
    of them, and publishes from there; a trigger that is run again replaces its
    own files, so that nothing counts twice and no other file is touched.
    """
    stream = spark.readStream.format("text").load(folder).select("value", F.substring_index(F.col("_metadata.file_path"), "/", -1).alias("file"))

    def add(batch: DataFrame, number: int) -> None:
        made = f"{out}/_made/trigger={number}"
        views_and_marks(batch, project, "file").write.mode("overwrite").parquet(made)
        rows = spark.read.schema("file string, kind int, page_id int, title string, views long").parquet(made)
        marks = rows.where(F.col("kind") != ARTICLE).groupBy("file").agg(F.count_distinct("kind").alias("marks"))
        month = F.concat_ws("-", F.regexp_extract("file", MONTH_IN_NAME, 1), F.regexp_extract("file", MONTH_IN_NAME, 2))
        whole = rows.where(F.col("kind") == ARTICLE).join(marks.where("marks = 2").select("file"), "file").select("page_id", "title", "views", month.alias("month"), "file")
        whole.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month", "file").parquet(f"{out}/months")
        seen = batch.select("file").distinct().join(marks.where("marks = 2"), "file", "left_anti")
        seen.write.mode("overwrite").parquet(f"{out}/_refused/trigger={number}")

    stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def months(spark: SparkSession, out: str) -> DataFrame:
    """month, page_id, title, views of all published files; those of one month are added up."""
    rows = spark.read.schema(STORED).parquet(f"{out}/months")
    return rows.groupBy("month", "page_id", "title").agg(F.sum("views").alias("views"))


def refused(spark: SparkSession, out: str) -> DataFrame:
    """file: the partial months."""
    return spark.read.schema("file string").parquet(f"{out}/_refused").select("file").distinct()
