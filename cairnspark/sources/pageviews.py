"""Monthly traffic: lines ``project title page_id access views hours`` (or without page_id), sorted by project.

Spark reads bzip2 in splits, so all blocks are scanned at once, and once only; the
project's prefix is tested first, and lines before the project in the file's
order are passed over.  Nothing is sought.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..staging import written

# The project, and the prefixes of titles that are no articles.
PROJECT = "en.wikipedia"
NOT_ARTICLES = (
    "Talk", "User", "User_talk", "Wikipedia", "Wikipedia_talk", "File", "File_talk", "MediaWiki", "MediaWiki_talk",
    "Template", "Template_talk", "Help", "Help_talk", "Category", "Category_talk", "Portal", "Portal_talk",
    "Draft", "Draft_talk", "Module", "Module_talk", "TimedText", "Special", "Media", "Gadget", "Gadget_definition",
    "Event", "Event_talk",
)


class PartialMonth(ValueError):
    """The file has no row of the project, or ends within its rows."""


ARTICLE, PROJECT_SEEN, LATER_SEEN = 0, 1, 2


def views_and_marks(lines: DataFrame, project: str = PROJECT, *keep: str) -> DataFrame:
    """keep, kind, page_id, title, views: sums over the project's article lines (kind ARTICLE; one of page_id and title is set), and in the same pass a row each if lines of the project and of a later one were seen.

    Marks are combined where the lines lie: a task sends one of each kind.  A
    number that is no page's, being beyond 32 bits, is none.
    """
    name = F.substring_index("value", " ", 1)
    kinds = F.when(name == project, F.array(F.lit(ARTICLE), F.lit(PROJECT_SEEN))).otherwise(F.array(F.lit(LATER_SEEN)))
    rows = lines.where(name >= project).select(*keep, F.when(name == project, F.split("value", " ")).alias("f"), F.explode(kinds).alias("kind"))
    n, is_article = F.size("f"), F.col("kind") == ARTICLE
    title, views = F.get("f", F.lit(1)), F.get("f", n - 2).try_cast("long")
    page = F.when((n == 6) & F.get("f", F.lit(2)).rlike("^[0-9]+$"), F.get("f", F.lit(2)).try_cast("int"))
    fine = n.isin(5, 6) & views.isNotNull() & (title != "-") & ~title.rlike("^(" + "|".join(NOT_ARTICLES) + "):")
    rows = rows.where(~is_article | fine).select(
        *keep, "kind", F.when(is_article, page).alias("page_id"), F.when(is_article & page.isNull(), F.make_valid_utf8(title)).alias("title"),
        F.when(is_article, views).otherwise(F.lit(0).cast("long")).alias("views"),
    )
    return rows.groupBy(*keep, "kind", "page_id", "title").agg(F.sum("views").alias("views"))


def views(lines: DataFrame, project: str = PROJECT) -> DataFrame:
    """page_id, title, views: the sums alone."""
    own = lines.where(F.col("value").startswith(project + " "))
    return views_and_marks(own, project).where(F.col("kind") == ARTICLE).select("page_id", "title", "views")


def read_month(spark: SparkSession, path: str, month: str, project: str = PROJECT) -> DataFrame:
    """month, page_id, title, views of a file; PartialMonth unless lines of the project and of a later one are there, so that the file did not end within.  The file is read once."""
    rows = written(views_and_marks(spark.read.text(path), project), "month")
    if rows.where(F.col("kind") != ARTICLE).select("kind").distinct().count() < 2:
        raise PartialMonth(path)
    return rows.where(F.col("kind") == ARTICLE).select(F.lit(month).alias("month"), "page_id", "title", "views")
