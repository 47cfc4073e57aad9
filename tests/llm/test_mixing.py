import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cairnspark.llm import mixing as M


def water(sizes):
    """Targets by iteration, as the contract words it."""
    names = sorted((k for k in sizes if k is not None)) + [None] * (None in sizes)
    weight = {k: i % 3 + 1 for i, k in enumerate(names)}
    target, capped, left = {}, set(), float(sum(sizes.values()))
    while True:
        free = [k for k in names if k not in capped]
        total = sum(weight[k] for k in free)
        over = [k for k in free if left * weight[k] / total > 3 * sizes[k]] if free else []
        if not over:
            return target | {k: left * weight[k] / total for k in free}
        for k in over:
            capped.add(k)
            target[k] = 3.0 * sizes[k]
            left -= target[k]


def test_targets(spark):
    for sizes in ({"a": 10, "b": 10, "c": 10, None: 10}, {"a": 1000, "b": 1, "c": 1, "d": 1}, {"é": 5, "z": 500, "a": 5}, {"a": 0, "b": 7}, {"a": 0}, {"a": 4}):
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r["source"]: r["target"] for r in M.source_targets(df).collect()}
        want = water(sizes)
        assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], abs_tol=1e-9) for k in want), sizes


def test_prefix_sums(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("g"), (F.col("id") * 37 % 101).alias("o"), "id", (F.col("id") % 7).alias("v"))
    got = M.prefix_sums(df, ["g"], [F.col("o").asc(), F.col("id").asc()], "v", "before", parts=9).collect()
    assert len(got) == 500
    seen = defaultdict(int)
    for r in sorted(got, key=lambda r: (r["g"], r["o"], r["id"])):
        assert r["before"] == seen[r["g"]]
        seen[r["g"]] += r["v"]


def test_mix(documents, odd, hot):
    for docs in (documents, odd, hot):
        rows = M.mix(docs).collect()
        again = M.mix(docs.repartition(5)).collect()
        key = lambda r: str((r["id"], r["source"], r["size"], r["taken"]))
        assert sorted(map(key, rows)) == sorted(map(key, again))
        assert len(rows) == docs.count()
        taken, largest, target = defaultdict(int), defaultdict(int), {}
        for r in rows:
            assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] % max(1, r["size"]) == 0
            taken[r["source"]] += r["taken"]
            largest[r["source"]] = max(largest[r["source"]], r["size"])
            target[r["source"]] = r["target"]
        assert all(abs(taken[s] - target[s]) <= largest[s] for s in target)
        epochs = defaultdict(set)
        for r in rows:
            if r["size"]:
                epochs[r["source"]].add(r["taken"] // r["size"])
        assert all(max(e) - min(e) <= 1 for e in epochs.values())  # whole epochs first


def test_better_documents_are_taken_more_often(spark):
    good, bad = "plain words " * 5, "1## 2$$ 3%% " * 5
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, good).otherwise(bad).alias("text"), F.when(F.col("id") < 3000, "a").otherwise("b").alias("source"))
    rows = M.mix(docs).where("source = 'a'").groupBy((F.col("id") % 2).alias("k")).agg(F.avg((F.col("copies") > 0).cast("int"))).collect()
    share = {r[0]: r[1] for r in rows}
    assert share[0] > share[1] + 0.15


def test_mixed_rows(spark, odd, documents, hot):
    own = "mx_copies", "mx_tag", "MX_no", "mx_hash_of_plan"  # names that the operator might use itself
    for docs in (odd, documents, hot, odd.toDF(*odd.columns[:2], "lang", "source", *own[:3]), odd.withColumnRenamed("lang", own[3])):
        out = M.mixed_rows(docs)
        taken = Counter()
        for r in M.mix(docs).collect():
            taken[r["id"], r["source"], r["size"]] += r["copies"]
        size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        assert out.columns == docs.columns and Counter((r["doc_id"], r["source"], size(r["text"])) for r in out.select("doc_id", "source", "text").collect()) == +taken
    assert M.mixed_rows(odd.limit(0)).count() == 0 and M.mix(odd.limit(0)).count() == 0


def test_repeated_rows_meet_a_fractional_target(spark):
    """Rows that are equal in everything are taken each for itself: 40 times one row of 10 words, of a target of about 267 words."""
    docs = spark.createDataFrame([(1, "w " * 10, "a")] * 40 + [(k, "v " * 10, "b") for k in range(40)], "doc_id long, text string, source string")
    plan = {r["source"]: (r["target"], r["n"]) for r in M.mix(docs).groupBy("source").agg(F.max("target").alias("target"), F.sum("taken").alias("n")).collect()}
    words = {r["source"]: 10 * r["count"] for r in M.mixed_rows(docs).groupBy("source").count().collect()}
    assert all(abs(n - t) <= 5 and words[s] == n for s, (t, n) in plan.items()) and plan["a"][0] < 300


@pytest.mark.parametrize("seed", [1, 2])
def test_seed(documents, seed):
    assert M.mix(documents, seed=seed).count() == documents.count()
