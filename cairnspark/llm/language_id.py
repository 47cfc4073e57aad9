"""Language identification with error-correcting output codes.

Every language has a codeword.  For up to six languages the code is exhaustive
(all ways to part them in two), for more it has 63 columns, chosen among
seeded draws for the largest least distance between rows.  One binary
classifier per column predicts a bit from hashed byte trigrams of the whole
lower-cased text.  Decoding is loss-weighted: a codeword's distance is the sum
of exponential losses of the margins against its bits, each weighted by how
well that column's classifier does on that language in training.  The nearest
codeword wins; if the second is within ``ambiguity`` the text is flagged.

Training takes at most about ``per_language`` different texts of each language
outside the held-out fold, drawn by a hash of the text, of the ``max_languages``
languages that most rows have (of equal ones the first by code point); only
their trigram vectors reach the driver.  Prediction is one pass over all rows.

Defined cases.  Null text and text without a letter (a character of Unicode's
letter categories) are ``und`` with score 0.
If nothing can be learnt from, all are ``und``; if there is one language, all
with letters are that.  Null identifiers count as held out.  Repeated rows get
equal predictions and are one text in training.  An empty table gives an empty result.  Very long texts are read in
blocks, whole.  Extra columns are never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, quoted, table
from .sampling import draw, fold

DIM_BITS = 11
DIM = 1 << DIM_BITS
PER_LANGUAGE, MAX_LANGUAGES = 800, 60
EPOCHS = 120
AMBIGUITY = 0.05
UND = "und"

# letters and bytes of other scripts stay, all else is a space
_KEEP = np.array([c if c >= 128 or chr(c).isalpha() else 32 for c in range(256)], dtype=np.uint32)


def trigrams(text: str, block: int = 1 << 20) -> np.ndarray:
    """Root frequencies of hashed byte trigrams, of length 1 (all zero for a text of fewer than three bytes)."""
    raw = _KEEP[np.frombuffer(f" {text.lower()} ".encode("utf-8", "surrogatepass"), dtype=np.uint8)]
    counts = np.zeros(DIM)
    for a in range(0, max(1, len(raw) - 2), block):
        b = raw[a : a + block + 2]
        if len(b) > 2:
            h = (b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]) * np.uint32(2654435761)
            counts += np.bincount(h >> np.uint32(32 - DIM_BITS), minlength=DIM)
    v = np.sqrt(counts)
    return (v / (np.linalg.norm(v) or 1)).astype(np.float32)


def code(n: int, seed: int = 11) -> np.ndarray:
    """n codewords as rows of -1 and 1."""
    if n <= 6:
        columns = [[1 if m >> k & 1 else -1 for k in range(n)] for m in range(1, 1 << max(0, n - 1))]
        return np.array(columns, dtype=np.float32).reshape(len(columns), n).T
    rng, best, most = np.random.default_rng(seed), None, -1
    for _ in range(300):
        m = rng.choice(np.array([-1, 1], dtype=np.float32), (n, 63))
        least = ((m.shape[1] - m @ m.T) / 2 + 64 * np.eye(n)).min()
        if least > most and (np.abs(m.sum(axis=0)) < n).all():
            best, most = m, least
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # trigrams x bits
    bias: np.ndarray
    trust: np.ndarray  # languages x bits, rows sum to 1

    def predict(self, x: np.ndarray, ambiguity: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the language, score, ambiguous; for each row of trigrams."""
        if len(self.languages) == 1:
            return np.zeros(len(x), int), np.ones(len(x)), np.zeros(len(x), bool)
        margin = np.clip(x @ self.weights + self.bias, -4, 4)
        distance = np.einsum("kb,nkb->nk", self.trust, np.exp(-margin[:, None, :] * self.code[None]))
        near = np.exp(-4 * (distance - distance.min(axis=1, keepdims=True)))
        p = near / near.sum(axis=1, keepdims=True)
        two = np.sort(distance, axis=1)[:, :2]
        return distance.argmin(axis=1), p.max(axis=1), two[:, 1] - two[:, 0] < ambiguity


def fit(x: np.ndarray, languages: list[str], epochs: int = EPOCHS) -> Model:
    """Logistic classifiers of all bits at once, by Adam over the full sample; languages weigh alike."""
    names = sorted(set(languages))
    y = np.searchsorted(names, languages)
    c = code(len(names))
    t = c[y]
    each = (1 / np.bincount(y, minlength=len(names)))[y][:, None].astype(np.float32) / len(names)
    w, b = np.zeros((DIM, c.shape[1]), np.float32), np.zeros(c.shape[1], np.float32)
    m = [np.zeros_like(w), np.zeros_like(b)]
    v = [np.zeros_like(w), np.zeros_like(b)]
    for step in range(1, epochs + 1):
        g = -t * each / (1 + np.exp(np.clip(t * (x @ w + b), -30, 30)))
        for k, (p, grad) in enumerate(((w, x.T @ g + 1e-6 * w), (b, g.sum(axis=0)))):
            m[k] = 0.9 * m[k] + 0.1 * grad
            v[k] = 0.99 * v[k] + 0.01 * grad**2
            p -= 0.3 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
    right = (np.sign(x @ w + b) == t).astype(np.float64)
    trust = np.array([right[y == k].mean(axis=0) for k in range(len(names))]) + 1e-3
    return Model(names, c, w, b, trust / trust.sum(axis=1, keepdims=True))


def train(rows: DataFrame, text_col: Column, lang_col: Column, per_language: int = PER_LANGUAGE, max_languages: int = MAX_LANGUAGES) -> Model | None:
    """``rows``: what may be learnt from.  Null languages are left out."""
    rows = rows.select(text_col.alias("text"), lang_col.alias("lang")).where("lang is not null and text is not null")
    most = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("text").alias("texts")).orderBy(F.col("n").desc(), "lang").limit(max_languages)
    counts = {r["lang"]: r["texts"] for r in most.collect()}
    if not counts:
        return None
    share = F.create_map(*[F.lit(z) for k, n in sorted(counts.items()) for z in (k, min(1.0, per_language / n))])
    # by text: copies of one are drawn together, and are one
    chosen = rows.where(draw(F.col("text"), 3) < F.element_at(share, F.col("lang"))).dropDuplicates(["lang", "text"]).select("lang", "text")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [trigrams(t.as_py()).astype(np.float16).tobytes() for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.binary())], ["lang", "x"])

    got = map_arrow(chosen, vectors, "lang string, x binary").toArrow()
    if not got.num_rows:
        return None
    order = np.lexsort([got.column("x").to_numpy(), got.column("lang").to_numpy().astype(str)])  # the same model whatever the order of tasks
    x = np.frombuffer(b"".join(got.column("x").to_pylist()), dtype=np.float16).reshape(-1, DIM).astype(np.float32)
    return fit(x[order], [got.column("lang")[int(i)].as_py() for i in order])


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", ambiguity: float = AMBIGUITY) -> DataFrame:
    """id, lang_pred, score, ambiguous: one row per input row."""
    rows = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"))
    shared = rows.sparkSession.sparkContext.broadcast(model)  # languages x bits and trigrams x bits, whatever the corpus

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for whole in batches:
            for a in range(0, whole.num_rows, 256):
                b = whole.slice(a, 256)
                texts = [t.as_py() or "" for t in b.column(1)]
                lang, score, doubt = [UND] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
                at = [k for k, t in enumerate(texts) if any(map(str.isalpha, t))] if model else []
                if at:
                    k, s, d = model.predict(np.stack([trigrams(texts[i]) for i in at]), ambiguity)
                    score[at], doubt[at] = s, d
                    for i, n in zip(at, k, strict=True):
                        lang[i] = model.languages[n]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang), pa.array(score), pa.array(doubt)], ["id", "lang_pred", "score", "ambiguous"])

    return map_arrow(rows, scored, f"id {rows.schema['id'].dataType.simpleString()}, lang_pred string, score double, ambiguous boolean")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(fold(F.col("doc_id")) != 0), F.col("text"), F.col("lang"))
    out = predict(docs, model)
    return out.select(F.col("id").alias("doc_id"), (fold(F.col("id")) == 0).alias("held_out"), "lang_pred", "score", "ambiguous")
