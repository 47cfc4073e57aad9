"""The pipeline against the stages done by hand."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from test_exact_dedup import norm
from test_quality_rules import brute as quality_brute
from test_simhash import exact_groups, groups

from cairnspark.llm import common, mixing, quality_rules


def check_near(once, apart, columns):
    """Against exact similarity: of each component one document at least stays, the first if only one does; nine of ten pairs are found; what has no similar text stays."""
    rows = sorted((r["doc_id"], r["text"]) for r in once.select("doc_id", "text").collect())
    pairs = exact_groups(rows)
    kept = {r["doc_id"] for r in apart.collect()}
    similar = {i for p in pairs for i in p}
    assert apart.columns == columns and all(rows[i][0] in kept for i in range(len(rows)) if i not in similar)
    for group in groups(range(len(rows)), pairs):
        stay = sorted(i for i in group if rows[i][0] in kept)
        assert stay and stay[0] == min(group)
    assert sum(rows[i][0] in kept and rows[j][0] in kept for i, j in pairs) <= 0.1 * len(pairs)


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, stage = docs.columns, dict(C.STAGES)
    assert list(stage) == ["quality_rules", "exact_dedup", "simhash_dedup", "mixing", "packing"]

    kept = C.staged(stage["quality_rules"](spark, docs, sf_dir), "t")
    want = [r[0] for r in quality_brute([tuple(r) for r in docs.select("doc_id", "text", "source").collect()], quality_rules.MIN_DOCS, quality_rules.MAX_SHARE) if r[7]]
    assert kept.columns == columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(want)

    once = C.staged(stage["exact_dedup"](spark, kept, sf_dir), "t")
    first = {}
    for r in kept.collect():
        first[norm(r["text"])] = min(r["doc_id"], first.get(norm(r["text"]), r["doc_id"]))
    assert once.columns == columns and sorted(r["doc_id"] for r in once.collect()) == sorted(first.values())

    apart = C.staged(stage["simhash_dedup"](spark, once, sf_dir), "t")
    check_near(once, apart, columns)

    mixed = C.staged(stage["mixing"](spark, apart, sf_dir), "t")
    plan = {(r["source"], r["id"]): r["copies"] for r in mixing.mix(apart).collect()}
    got = Counter((r["source"], r["doc_id"]) for r in mixed.collect())
    assert mixed.columns == columns and got == Counter({k: n for k, n in plan.items() if n})

    packed = stage["packing"](spark, mixed, sf_dir).collect()
    assert Counter(r["doc_id"] for r in packed if r["piece"] == 0) == Counter(r["doc_id"] for r in mixed.collect())
    sequences = Counter()
    for r in packed:
        sequences[r["sequence_id"]] += r["length"]
    assert max(sequences.values()) <= 2048 and len(sequences) <= 1.02 * math.ceil(sum(sequences.values()) / 2048) + 1

    run = C.run(spark, sf_dir).collect()
    assert Counter((r["doc_id"], r["piece"], r["ids_crc32"]) for r in run) == Counter((r["doc_id"], r["piece"], r["ids_crc32"]) for r in packed)


def test_run_on_a_hot_table(spark, hot, tmp_path):
    """A third of the rows one text, another third near copies of it, one source of two thirds: the whole run, against the stages done by hand."""
    hot.withColumn("lang", F.lit("en")).withColumn("n_chars", F.length("text").cast("long")).coalesce(3).write.parquet(f"{tmp_path}/documents.parquet")
    since = common.scratch_mark()
    out = C.run(spark, str(tmp_path)).collect()
    assert common.scratch_mark() > since
    kept = {r["doc_id"] for r in out}
    # of copies and near copies the first stays, and all the others, but for what the mix leaves
    assert kept <= {0} | {i for i in range(600) if i % 3 == 2}
    sequences = Counter()
    for r in out:
        sequences[r["sequence_id"]] += r["length"]
    assert max(sequences.values()) <= 2048
    near = dict(C.STAGES)["simhash_dedup"](spark, C.staged(dict(C.STAGES)["exact_dedup"](spark, hot, ""), "t"), "")
    assert {r["doc_id"] for r in near.collect()} == {0} | {i for i in range(600) if i % 3 == 2}


@pytest.mark.parametrize("name", [n for n, _ in C.STAGES])
def test_odd_tables(spark, odd, name):
    stage = dict(C.STAGES)[name]
    for docs in (odd, odd.limit(0)):
        out = stage(spark, docs, "")
        assert out.count() <= 3 * docs.count() + 30
        assert name == "packing" or out.columns == docs.columns
