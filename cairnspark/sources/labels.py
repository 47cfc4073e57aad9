"""Labels of entities: a JSON object in a file, and batches of keys for a label service."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BATCH = 50


def parse_labels(text: DataFrame) -> DataFrame:
    """qid, label of JSON objects (value).  Keys without the Q, empty and non-string labels, and what is no JSON, are left out."""
    # as variants, strings are told apart from other values
    rows = text.select(F.try_parse_json("value").alias("v")).where("v is not null")
    pairs = rows.lateralJoin(rows.sparkSession.tvf.variant_explode(F.col("v").outer())).select("key", "value")
    pairs = pairs.where((F.schema_of_variant("value") == "STRING") & F.col("key").startswith("Q"))
    return pairs.select(F.col("key").alias("qid"), F.col("value").cast("string").alias("label")).where("label <> ''")


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    return parse_labels(spark.read.text(path, wholetext=True))


def batches(keys: DataFrame, key: str = "qid", size: int = BATCH) -> DataFrame:
    """part, batch, keys: keys in order, up to ``size`` together; a request for a label service each.  Every part of the keys' range is batched for itself."""
    dealt = keys.select(key).repartitionByRange(key).withColumn("part", F.spark_partition_id())
    n = F.row_number().over(Window.partitionBy("part").orderBy(key))
    return dealt.withColumn("batch", F.ceil(n / size).cast("int")).groupBy("part", "batch").agg(F.array_sort(F.collect_list(key)).alias("keys"))
