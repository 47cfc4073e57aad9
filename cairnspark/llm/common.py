"""What the training-data operators share: scratch tables, column naming, text classes."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship

#: White space of every contract here: space and U+0009 to U+000D.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"

_own_base: str | None = None
_made: list[str] = []


def shared_base(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only with a local master (tests) may it be unset; a folder of this process
    is made then, and removed when the process ends.
    """
    global _own_base
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        if _own_base is None:
            _own_base = tempfile.mkdtemp(prefix="cairnspark-")
            atexit.register(shutil.rmtree, _own_base, ignore_errors=True)
        base = "file://" + _own_base
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing else ever writes there."""
    _made.append(f"{shared_base(spark)}/{name}-{uuid.uuid4().hex[:12]}")
    return _made[-1]


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder through Spark's own file systems; whether it was there."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def clear_scratch(spark: SparkSession, since: int = 0, last: int = 0) -> int:
    """Delete the scratch tables that this process has made, but for the first ``since`` and the ``last`` ones; returns how many.

    Results that were not written yet still read them: call it when they are.
    """
    end = max(since, len(_made) - last)
    gone, _made[since:end] = _made[since:end], []
    return sum(delete_path(spark, path) for path in gone)


def scratch_mark() -> int:
    """For ``clear_scratch(since=...)``: how many scratch tables there are."""
    return len(_made)


#: A staged table is read instead of the shuffles that made it, so these need not stay on the executors' disks.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage and fixes the rows: what is nondeterministic in ``df``
    (row tags, partition numbers) is decided once, and a lost executor costs
    a re-read, not a recomputation.  Shuffle files go when the table is written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        # a new DataFrame over the same plan: the setting is read when it is planned
        df.select("*").write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(FREE_SHUFFLES) if before is None else spark.conf.set(FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


#: Plans that give the same rows from the same files on every run.
_PLAIN = {"LogicalRelation", "SubqueryAlias", "Project", "Filter"}


def _reads_files(docs: DataFrame) -> bool:
    """Whether ``docs`` is nothing but deterministic columns and filters over Parquet files."""
    plan = docs._jdf.queryExecution().analyzed()
    while plan.getClass().getSimpleName() in _PLAIN and plan.deterministic():
        if plan.children().isEmpty():
            files = plan.relation()
            return files.getClass().getSimpleName() == "HadoopFsRelation" and files.fileFormat().getClass().getSimpleName() == "ParquetFileFormat"
        plan = plan.children().head()
    return False


def tagged(docs: DataFrame, tag: str) -> DataFrame:
    """``docs`` and ``tag``, a struct that names each row for good: whoever reads the result again sees the same tags.

    Rows of Parquet files are known by file and place there; of anything else,
    a copy is staged once.
    """
    if _reads_files(docs):
        at = docs.metadataColumn("_metadata")
        return docs.select("*", F.struct(F.xxhash64(at["file_path"]).alias("file"), at["row_index"].alias("row")).alias(tag))
    own = F.struct(F.lit(0).cast("long").alias("file"), F.monotonically_increasing_id().alias("row"))
    return staged(docs.select("*", own.alias(tag)), "tagged")


def meet(rows: DataFrame, marks: DataFrame, tag: str, how: str = "inner") -> DataFrame:
    """``rows``, which carry texts, joined to ``marks``, decisions on rows, by ``tag``, which names a row on either side once.

    Always by one shuffle on the tag, at any size: the marks of a corpus grow
    with it, so there is no bound under which to broadcast them.  A task
    hashes its marks and streams its texts past them, without sorting texts;
    tags are unique, so no task gets more than its share.
    """
    return rows.join(marks.hint("shuffle_hash"), tag, how)


def map_arrow(df: DataFrame, function: Callable, schema) -> DataFrame:
    """``mapInArrow``, with this package at hand on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def fresh(name: str, taken: list[str]) -> str:
    """``name``, lengthened until no column in ``taken`` has it (case-blind)."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name += "_"
    return name


def quoted(name: str) -> Column:
    """Column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def words_of(text: Column) -> Column:
    """The maximal runs of non-space characters, in order."""
    return F.array_remove(F.split(text, SPACE_CLASS + "+"), "")


def normalised(text: Column) -> Column:
    """Every run of white space becomes one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_CLASS + "+", " ")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
