import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls in every column, empty and long texts, ties, repeated rows, and columns of clashing names."""
    rows = [
        (1, "a b c d e f g h i j k", "en", "s1", 5, "x", "y"),
        (2, "a  b\tc d e f g h i j k", "en", "s1", 5, "x", "y"),
        (2, "a  b\tc d e f g h i j k", "en", "s1", 5, "x", "y"),
        (None, "a b c d e f g h i j k", None, None, None, None, None),
        (3, "", "de", "s2", 0, None, "y"), (4, None, "de", "s2", None, "x", None), (5, " \n\t ", None, "s2", 3, "x", "y"),
        (6, "word " * 60_000, "en", "s3", 300_000, "x", "y"),
        (7, "une phrase très courte", "fr", None, 22, "x", "y"), (7, "zwei Zeilen\nzwei Zeilen\nund mehr davon in diesem Text hier", "de", "s2", 1, "x", "y"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, digest string, tag string")


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def hot(spark):
    """A third of the rows are one text of one source, another part near copies of one text."""
    base = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(300)), lambda k: F.concat(F.lit("w"), k)), " ")
    own = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(40)), lambda k: F.substring(F.md5(F.concat(k.cast("string"), F.lit("/"), F.col("id").cast("string")).cast("binary")), 1, 5)), " ")
    near = F.concat(base, F.lit(" end"), F.col("id").cast("string"))
    text = F.when(F.col("id") % 3 == 0, base).when(F.col("id") % 3 == 1, near).otherwise(own)
    return spark.range(600).select(F.col("id").alias("doc_id"), text.alias("text"), F.when(F.col("id") % 3 < 2, "big").otherwise(F.concat(F.lit("s"), F.col("id") % 4)).alias("source"))
