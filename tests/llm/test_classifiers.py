import math
import unicodedata

import numpy as np
from pyspark.sql import functions as F

from cairnspark.llm import common
from cairnspark.llm import language_id as L
from cairnspark.llm import quality_classifier as Q
from cairnspark.llm import sampling

BIG = "/root/testdata/sf0.01"


def auc(y, s):
    order = np.argsort(np.argsort(s, kind="stable"), kind="stable") + 1
    pos = y == 1
    return (order[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


def test_folds(spark):
    import zlib

    rows = spark.createDataFrame([(i,) for i in [*range(50), None]], "i long").select("i", sampling.fold(F.col("i")).alias("f")).collect()
    assert all(r["f"] == zlib.crc32(b"" if r["i"] is None else str(r["i"]).encode()) % 5 for r in rows)
    many = spark.range(10_000)
    assert 800 < sampling.bounded(many, F.col("id"), 1000, 10_000).count() < 1200 and sampling.bounded(many, F.col("id"), 10**6, 10_000).count() == 10_000


# ── language ────────────────────────────────────────────────────

def test_held_out_languages(spark):
    got = L.op8_language_id(spark, BIG)
    truth = spark.read.parquet(f"{BIG}/documents.parquet").select("doc_id", "lang")
    held = got.where("held_out").join(truth, "doc_id").collect()
    assert len(held) > 100 and np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got.collect()) and got.count() == truth.count()


def test_odd_rows(odd):
    got = L.predict(odd, None)
    assert {r["lang_pred"] for r in got.collect()} == {"und"}
    model = L.train(odd, F.col("text"), F.col("lang"))
    rows = L.predict(odd, model).collect()
    assert len(rows) == odd.count() and {r["lang_pred"] for r in rows} <= {"und", "en", "de", "fr"}
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in rows if r["id"] in (3, 4, 5))
    assert L.train(odd.limit(0), F.col("text"), F.col("lang")) is None and L.predict(odd.limit(0), model).count() == 0
    one = L.train(odd.where("lang = 'en'"), F.col("text"), F.col("lang"))
    assert {r["lang_pred"] for r in L.predict(odd, one).collect()} == {"und", "en"}


def test_no_letter_is_und(spark):
    """Numbers and signs of Unicode that a word pattern takes for letters are none."""
    texts = ["½ ² Ⅷ ① 12", "١٢ _ -", "a", "日本", "ª", "\u0345 ½"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = L.train(spark.createDataFrame([("a b c", "en"), ("x y z", "fr")], "text string, lang string"), F.col("text"), F.col("lang"))
    got = {r["id"]: r["lang_pred"] == "und" for r in L.predict(docs, model).collect()}
    assert got == {i: not any(unicodedata.category(c).startswith("L") for c in t) for i, t in enumerate(texts)}


def test_samples_are_bounded_on_dirty_columns_and_repeated_rows(spark):
    rows = spark.range(6000).select(F.lit("one much copied text").alias("text"), F.when(F.col("id") < 3000, "en").otherwise(F.concat(F.lit("x"), F.col("id"))).alias("lang"))
    model = L.train(rows, F.col("text"), F.col("lang"), max_languages=5)
    assert len(model.languages) == 5 and "en" in model.languages


def test_predictions_against_brute_force(spark, documents):
    """The query against trigrams counted one by one and decoding by hand, with the same model."""
    docs = documents.where("doc_id < 60")
    model = L.train(documents, F.col("text"), F.col("lang"))
    for r in L.predict(docs, model).join(docs.withColumnRenamed("doc_id", "id"), "id").collect():
        if not any(map(str.isalpha, r["text"] or "")):
            assert r["lang_pred"] == "und"
            continue
        raw = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in f" {r['text'].lower()} ".encode())
        v = np.zeros(L.DIM)
        for i in range(len(raw) - 2):
            v[((raw[i] << 16 | raw[i + 1] << 8 | raw[i + 2]) * 2654435761 & 0xFFFFFFFF) >> (32 - L.DIM_BITS)] += 1
        x = np.sqrt(v) / np.linalg.norm(np.sqrt(v))
        margin = np.clip(x @ model.weights + model.bias, -4, 4)
        distance = [sum(model.trust[k, b] * math.exp(-margin[b] * model.code[k, b]) for b in range(len(margin))) for k in range(len(model.languages))]
        near = [math.exp(-4 * d) for d in distance]
        assert r["lang_pred"] == model.languages[int(np.argmin(distance))] and abs(r["score"] - max(near) / sum(near)) < 1e-3


def test_codes():
    for n in (1, 2, 3, 4, 6, 9, 20):
        c = L.code(n)
        assert c.shape[0] == n and set(np.unique(c)) <= {-1, 1}
        distances = [(c[i] != c[j]).sum() for i in range(n) for j in range(i)]
        assert not distances or min(distances) >= max(1, c.shape[1] // 4)


def test_one_wrong_bit_is_corrected():
    c = L.code(4)
    model = L.Model(list("abcd"), c, np.zeros((L.DIM, 7), np.float32), np.zeros(7, np.float32), np.full((4, 7), 1 / 7))
    for k in range(4):
        for bit in range(7):
            said = c[k].copy()
            said[bit] *= -1
            model.bias = 2 * said
            index, _, _ = model.predict(np.zeros((1, L.DIM), np.float32), 0.0)
            assert index[0] == k


def test_ambiguity_and_blocks():
    model = L.Model(list("ab"), L.code(2), np.zeros((L.DIM, 1), np.float32), np.zeros(1, np.float32), np.ones((2, 1)))
    assert model.predict(np.zeros((1, L.DIM), np.float32), 0.05)[2].all()
    text = "Thé quick brown fox " * 50
    assert np.allclose(L.trigrams(text), L.trigrams(text, block=17))


# ── quality ─────────────────────────────────────────────────────

def test_held_out_quality(spark):
    got = Q.op6_quality(spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = got.where("held_out").join(labels, "doc_id").collect()
    y, s = np.array([r["quality"] for r in held]), np.array([r["score"] for r in held])
    assert auc(y, s) > 0.97 and np.mean([r["predicted"] == r["quality"] for r in held]) > 0.96
    assert all(r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in got.collect())


def test_risk_is_kept_from_going_negative():
    rng = np.random.default_rng(0)
    p = rng.normal(1, 0.3, (200, 5))
    u = np.vstack([rng.normal(1, 0.3, (800, 5)), rng.normal(-1, 0.3, (200, 5))])
    model = Q.fit(p, u, 0.8)
    s = model.score(u)
    assert s[:800].mean() > 0.9 and s[800:].mean() < 0.1


def test_prior_of_unlabelled_rows():
    """From positives and unlabelled rows alone; classes that overlap a little."""
    rng = np.random.default_rng(1)
    for share in (0.3, 0.6, 0.85):
        n = 4000
        u = np.vstack([rng.normal(1, 0.5, (int(share * n), 6)), rng.normal(-1, 0.5, (n - int(share * n), 6))])
        assert abs(Q.class_prior(rng.normal(1, 0.5, (1500, 6)), u[rng.permutation(n)]) - share) < 0.06
    assert Q.class_prior(u[:5], u) == 0.5


def test_passes_lower_the_risk_over_all_rows(spark):
    """Sums of the executors against the same sums here, and the risk of the whole table before and after."""
    docs = spark.read.parquet(f"{BIG}/documents.parquet")
    stats = common.staged(Q.statistics_of(docs), "t")
    x = np.stack([Q.statistics(r["text"]).astype(Q.KIND) for r in docs.collect()]).astype(np.float64)
    positive = x[:200]
    rough = Q.fit(positive, x[::7], 0.6, 60)
    z = np.clip((x - rough.mean) / rough.scale, -6, 6)
    f = z @ rough.weights + rough.bias
    gradient, loss = Q._sums(stats, rough)
    assert np.allclose(gradient, np.append(z.T @ (1 / (1 + np.exp(-f))), (1 / (1 + np.exp(-f))).sum()) / len(f)) and np.isclose(loss, np.logaddexp(0, f).mean())

    def risk(m):
        fu, fp = (np.clip((v - m.mean) / m.scale, -6, 6) @ m.weights + m.bias for v in (x, positive))
        return 0.6 * np.logaddexp(0, -fp).mean() + max(0, np.logaddexp(0, fu).mean() - 0.6 * np.logaddexp(0, fp).mean()) + 0.5e-4 * (m.weights**2).sum()

    assert risk(Q._over_all(rough, positive, x[::7], 0.6, stats, 6)) < risk(rough)


def test_scores_against_brute_force(spark):
    docs = spark.read.parquet(f"{BIG}/documents.parquet")
    stats = common.staged(Q.statistics_of(docs), "t")
    model, prior = Q.train(stats.where("learn"), spark.read.parquet(f"{BIG}/labels.parquet").where(sampling.fold(F.col("doc_id")) != 0))
    want = {r["doc_id"]: model.score(Q.statistics(r["text"]).astype(Q.KIND).astype(np.float64)[None])[0] for r in docs.collect()}
    got = Q.op6_quality(spark, BIG).collect()
    assert 0 < prior < 1 and len(got) == len(want) and all(abs(r["score"] - want[r["doc_id"]]) < 1e-6 for r in got)


def test_odd_rows_and_labels(spark, odd):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, None), (2, None, 1), (None, 1, 1), (3, 0, 0)], "doc_id long, quality int, toxic int")
    stats = common.staged(Q.statistics_of(odd), "t")
    model, prior = Q.train(stats, labels)
    assert prior == 0.5 and model is not None
    assert Q.score(stats, model, prior).count() == odd.count()
    none, prior = Q.train(stats, labels.limit(0))
    assert none is None and {r["score"] for r in Q.score(stats, none, prior).collect()} == {0.5}
    assert Q.score(stats.limit(0), model, prior).count() == 0
    text = "Some TEXT, with | marks!\nand lines\n" * 40
    assert np.allclose(Q.statistics(text), Q.statistics(text, block=13)) and not Q.statistics(None).any()
