"""Exact deduplication as a stateful stream over digests (DataFrame functions only).

1. *Digests.*  Every row gets a content locator, which names the row and so its
   text for good (file and place there), and the SHA-256 digest of its
   normalised text.  Both are written to the shared folder; the texts are not.
2. *Keyed state.*  A Structured Streaming query reads the digests' files
   (any number of triggers) and folds them into RocksDB state, keyed by digest
   and never expired: the smallest stable identifier, its content locator and
   the number of rows seen.  Map-side partial aggregation comes before the
   state's shuffle, so a text that fills a third of the corpus sends one row
   per task.
3. *Bytes on hits.*  Of digests seen more than once, and only of these, the
   texts are fetched by their locators (one join on them, for which every
   normalised text is shuffled once) and compared whole: by a hash
   aggregation on (digest, text), combined where the rows lie.  Where one
   digest covers several texts, those rows leave the state's verdict and are
   resolved by their bytes.

Defined cases.  Null text counts as empty.  A null identifier loses to any
other.  Rows that repeat an identifier and a text form one group in which
exactly one row stays.  An empty table gives an empty result.  Other columns
are never looked at and come through ``exact_dedup`` unchanged, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, meet, normalised, quoted, scratch_path, staged, table, tagged

ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # a partition's store holds no files of its own between triggers, and none before it needs them
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


#: What ``tagged`` names a row by.
LOCATOR = "struct<file: bigint, row: bigint>"


def sha256_digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


class DigestState:
    """Disk-backed state of a deduplicating stream: digest -> first identifier, locator, rows seen.

    ``absorb`` may be called again with new files of the same source: the
    streaming checkpoint remembers which files are in the state already.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, max_files_per_trigger: int = 100_000):
        self.spark, self.path, self.max_files = spark, path or scratch_path(spark, "dedup-state"), max_files_per_trigger

    def absorb(self, stream: DataFrame) -> None:
        """Fold a streaming DataFrame (digest, id, locator) into the state, until it has no more rows."""
        conf = self.spark.conf
        before = {k: conf.get(k, None) for k in ROCKSDB}
        folded = stream.groupBy("digest").agg(
            F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "locator")).alias("first"),
            F.count(F.lit(1)).alias("seen"),
        )
        out = f"{self.path}/updates"

        def keep(batch: DataFrame, number: int) -> None:
            # a trigger that is run again after a failure overwrites its own folder
            batch.write.mode("overwrite").option("compression", "zstd").parquet(f"{out}/trigger={number}")

        try:
            for k, v in ROCKSDB.items():
                conf.set(k, v)
            (
                folded.writeStream.outputMode("update").foreachBatch(keep)
                .option("checkpointLocation", f"{self.path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
            )
        finally:
            for k, v in before.items():
                conf.unset(k) if v is None else conf.set(k, v)

    def absorb_files(self, path: str, schema) -> None:
        """Fold the Parquet files (tag, id, digest) below ``path`` into the state."""
        stream = self.spark.readStream.schema(schema).option("maxFilesPerTrigger", self.max_files).parquet(path)
        self.absorb(stream.select("digest", "id", F.col("tag").alias("locator")))

    def table(self, id_type: str) -> DataFrame:
        """digest, first struct<no_id, id, locator>, seen: the state after the last trigger."""
        schema = f"digest string, first struct<no_id: boolean, id: {id_type}, locator: {LOCATOR}>, seen bigint, trigger int"
        updates = self.spark.read.schema(schema).parquet(f"{self.path}/updates")
        if len({f.split("trigger=")[1].split("/")[0] for f in updates.inputFiles() if "trigger=" in f}) <= 1:
            return updates.drop("trigger")
        # several triggers: the last word on a digest is the one that has seen most rows
        last = updates.groupBy("digest").agg(F.max_by(F.struct("first", "seen"), "seen").alias("s"))
        return last.select("digest", "s.first", "s.seen")


def _state(digests: DataFrame, id_type: str, max_files_per_trigger: int) -> DataFrame:
    """digest, first, seen: the state after all of ``digests``, a staged table."""
    spark = digests.sparkSession
    files = digests.inputFiles()
    if not files:  # no file, no row
        return spark.createDataFrame([], f"digest string, first struct<no_id: boolean, id: {id_type}, locator: {LOCATOR}>, seen bigint")
    state = DigestState(spark, max_files_per_trigger=max_files_per_trigger)
    state.absorb_files(files[0].rsplit("/", 1)[0], digests.schema)
    return state.table(id_type)


def _decided(
    rows: DataFrame, tag: str, id_col: str, text_col: str,
    digest: Callable[[Column], Column] = sha256_digest, max_files_per_trigger: int = 100_000,
) -> DataFrame:
    """tag, id, digest, keep_id, keep_tag, group_size, kept: one row for each of ``rows``, which carry their ``tag``."""
    norm = normalised(quoted(text_col))
    digests = staged(rows.select(quoted(tag).alias("tag"), quoted(id_col).alias("id"), digest(norm).alias("digest")), "dedup-digests")
    states = _state(digests, digests.schema["id"].dataType.simpleString(), max_files_per_trigger)

    hits = staged(digests.join(states.where("seen > 1").select("digest"), "digest").select("tag", "digest"), "dedup-hits")
    texts = meet(rows.select(quoted(tag).alias("tag"), norm.alias("norm")), hits, "tag")
    several = texts.groupBy("digest", "norm").agg(F.count(F.lit(1)).alias("n")).groupBy("digest").agg(F.count(F.lit(1)).alias("texts"))
    clashing = staged(several.where("texts > 1").select("digest"), "dedup-clash")

    found = digests.join(states, "digest").select("tag", "id", "digest", "first", F.col("seen").alias("group_size"))
    if not clashing.isEmpty():
        unlike = texts.join(clashing, "digest").join(digests.select("tag", "id"), "tag")
        by_text = unlike.groupBy("digest", "norm").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", F.col("tag").alias("locator"))).alias("first"), F.count(F.lit(1)).alias("group_size"))
        found = found.join(clashing, "digest", "left_anti").unionByName(unlike.join(by_text, ["digest", "norm"]).select("tag", "id", "digest", "first", "group_size"))
    return found.select(
        "tag", "id", "digest", F.col("first.id").alias("keep_id"), F.col("first.locator").alias("keep_tag"),
        "group_size", (F.col("tag") == F.col("first.locator")).alias("kept"),
    )


def dedup_decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """tag, id, digest, keep_id, keep_tag, group_size, kept: one row per input row.  ``digest``: another digest of a text; ``max_files_per_trigger``: the stream's pace."""
    tag = fresh("xd_tag", docs.columns)
    return _decided(tagged(docs, tag), tag, id_col, text_col, **kw)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The rows that stay, with the input's columns."""
    tag = fresh("xd_tag", docs.columns)
    rows = tagged(docs, tag)
    gone = _decided(rows, tag, id_col, text_col, **kw).where(~F.col("kept")).select(F.col("tag").alias(tag))
    return meet(rows, staged(gone, "dedup-gone"), tag, "left_anti").select([quoted(c) for c in docs.columns])


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    decisions = dedup_decisions(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return decisions.select(F.col("id").alias("doc_id"), "keep_id", F.col("group_size").cast("long"), "kept", F.col("digest").alias("text_sha256"))


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h FROM documents
), g AS (SELECT h, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY h)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, h AS text_sha256 FROM d JOIN g USING (h)
"""
