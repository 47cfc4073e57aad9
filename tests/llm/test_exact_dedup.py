import re

import pytest
from pyspark.sql import functions as F

from cairnspark.llm import common
from cairnspark.llm import exact_dedup as X


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def brute(rows):
    """(id, text) -> {text: (smallest id, rows)}"""
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    return {t: (min((i for i in ids if i is not None), default=None), len(ids)) for t, ids in groups.items()}


def check(docs, **kw):
    tagged = common.tagged(docs, "xd_mark")
    got = X._decided(tagged, "xd_mark", "doc_id", "text", **kw).join(tagged.select(F.col("xd_mark").alias("tag"), "text"), "tag").collect()
    rows = docs.select("doc_id", "text").collect()
    want = brute(map(tuple, rows))
    assert len(got) == len(rows)
    kept = {}
    for r in got:
        assert (r["keep_id"], r["group_size"]) == want[norm(r["text"])]
        kept[norm(r["text"])] = kept.get(norm(r["text"]), 0) + r["kept"]
        assert not r["kept"] or r["id"] == r["keep_id"]
    assert all(n == 1 for n in kept.values()) and len(kept) == len(want)


def test_odd_rows(odd):
    check(odd)


def test_many_triggers(documents):
    check(documents.repartition(7), max_files_per_trigger=2)


def test_weak_digest_is_resolved_by_bytes(documents, odd):
    weak = lambda t: F.crc32(t.cast("binary")).bitwiseAND(F.lit(3)).cast("string")
    check(documents, digest=weak)
    check(odd, digest=weak)


def test_hot_group(hot):
    check(hot)


def test_columns_come_through(odd):
    out = X.exact_dedup(odd)
    assert out.columns == odd.columns and out.schema == odd.schema
    assert out.count() == len(brute((r["doc_id"], r["text"]) for r in odd.collect()))
    taken = odd.withColumnRenamed("digest", "xd_digest").withColumnRenamed("tag", "XD_TAG")
    assert X.exact_dedup(taken).columns == taken.columns


def test_empty(odd):
    assert X.exact_dedup(odd.limit(0)).count() == 0


def test_state_goes_on_with_new_rows(spark, tmp_path):
    """A second call on the same state reads the new files only."""
    folder = str(tmp_path / "in")
    schema = f"digest string, id long, locator {X.LOCATOR}"
    rows = lambda *ids: spark.createDataFrame([("d", i, (0, i)) for i in ids], schema)
    state = X.DigestState(spark)
    for ids in ((5, 7), (3, 9)):
        rows(*ids).write.mode("append").parquet(folder)
        state.absorb(spark.readStream.schema(schema).parquet(folder))
        last = state.table("bigint").collect()
    assert [(r["digest"], r["first"]["id"], r["seen"]) for r in last] == [("d", 3, 4)]


@pytest.mark.parametrize("id_type", ["int", "string"])
def test_other_identifiers(odd, id_type):
    docs = odd.withColumn("doc_id", F.col("doc_id").cast(id_type))
    assert X.exact_dedup(docs).count() == X.exact_dedup(odd).count()


def test_only_hits_are_fetched(spark, documents):
    """Texts that no other shares a digest with are not compared."""
    rows = common.tagged(documents, "t")
    made = len(common._made)
    X._decided(rows, "t", "doc_id", "text")
    hits = next(spark.read.parquet(p) for p in common._made[made:] if "/dedup-hits-" in p)
    groups = {}
    for r in documents.select("text").collect():
        groups[norm(r["text"])] = groups.get(norm(r["text"]), 0) + 1
    assert hits.count() == sum(n for n in groups.values() if n > 1)
