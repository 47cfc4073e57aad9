"""Text quality by positive-unlabelled learning.

A linear model f over byte-class statistics is fitted to trusted positives P
and unlabelled web text U by minimising the non-negative unbiased risk

    prior * E_P[l(f)] + max(0, E_U[l(-f)] - prior * E_P[l(-f)])

with the logistic loss l, so that sigmoid(f) estimates P(good | text).  While
the second part is negative, which only over-fitting can make it, steps go
against it.  No text is ever taken as a negative.

The class prior is estimated from P and U alone (``class_prior``): a classifier
of P against U is fitted on one half of a sample; on the other, among all
thresholds, the share of U above one over the share of P above it can only be
too large, by the negatives above, so that the least such ratio (with bounds of
the shares' errors added in the choice) is the estimate.  Labels of bad texts
are never looked at.

P is drawn by hash from the rows outside the held-out fold, at most about
``max_positive`` texts.  A first model is fitted on the driver to P and a sample
of about ``max_start`` unlabelled texts.  Then the expectation over U is taken
over all rows: ``passes`` times, executors sum risk and gradient over the
statistics of every row that may be learnt from, and the model takes a Newton
step with the sample's curvature, halved if the risk did not fall.  Statistics
are made once and written to the shared folder; learning and scoring read them.

Statistics of a text: frequencies of pairs of adjacent byte classes (lower
case, upper case, digit, space, line end, other letters, and marks in eight
groups), and, on logarithmic or relative scales, length, words, mean word
length, distinct words, distinct lines, words equal to the one before.

Defined cases.  Null and empty texts get the score of all-zero statistics.
Without trusted positives the score is one half; with fewer than 40 the class
prior is.  A document labelled
twice counts as good if a label says so.  Null identifiers count as held out.
Repeated rows get equal scores, and are one text where texts are drawn.  An empty table gives an empty result.  Very long texts are
read whole, pairs in blocks.  Extra columns are never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, quoted, staged, table
from .sampling import bounded, fold

MAX_POSITIVE = 6000
MAX_START = 6000
PASSES = 8
THRESHOLD = 0.3
STEPS = 500

MARKS = (".,;:", "!?", "#$%&*", "|", "<>=/\\", "\"'`", "()[]{}", "@+-_~^")
N_CLASSES = 6 + len(MARKS)
N_STATS = N_CLASSES * N_CLASSES + 8


def _classes() -> np.ndarray:
    of = np.zeros(256, np.uint16)
    of[ord("A") : ord("Z") + 1] = 1
    of[ord("0") : ord("9") + 1] = 2
    of[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = 3
    of[0x0A] = 4
    of[128:] = 5
    for k, marks in enumerate(MARKS):
        of[[ord(c) for c in marks]] = 6 + k
    return of


_CLASS = _classes()


def statistics(text: str | None, block: int = 1 << 20) -> np.ndarray:
    data = (text or "").encode("utf-8", "surrogatepass")
    if not data:
        return np.zeros(N_STATS, np.float32)
    raw, counts = np.frombuffer(data, dtype=np.uint8), np.zeros(N_CLASSES * N_CLASSES)
    for a in range(0, len(raw), block):
        c = _CLASS[raw[a : a + block + 1]]
        if len(c) > 1:
            counts += np.bincount(c[:-1] * N_CLASSES + c[1:], minlength=N_CLASSES * N_CLASSES)
    words, lines = data.split(), [x for x in data.split(b"\n") if x.strip()]
    n = max(1, len(words))
    letters = counts.reshape(N_CLASSES, N_CLASSES).sum(axis=1)[[0, 1, 5]].sum() / max(1, counts.sum())
    more = [np.log1p(len(data)), np.log1p(len(words)), np.log1p(len(data) / n), len(set(words)) / n, len(set(lines)) / max(1, len(lines)), np.log1p(len(data) / max(1, len(lines))), letters, sum(map(eq, words, words[1:])) / n]
    return np.concatenate([np.sqrt(counts / max(1.0, counts.sum())), more]).astype(np.float32)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -30, 30)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = STEPS, l2: float = 1e-4, against: bool = False) -> Model:
    """The model of least risk by Adam over whole samples; with ``against``, of prior E_P[l(f)] + (1 - prior) E_U[l(-f)], which tells P from U."""
    mean, scale = unlabelled.mean(axis=0), unlabelled.std(axis=0) + 1e-3
    p, u = (np.clip((x - mean) / scale, -6, 6) for x in (positive, unlabelled))
    w, b = np.zeros(p.shape[1]), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for step in range(1, steps + 1):
        fp, fu = p @ w + b, u @ w + b
        # d l(f)/df = -sigmoid(-f), d l(-f)/df = sigmoid(f)
        as_good = prior * -sigmoid(-fp) / len(p)
        p_bad, u_bad = -prior * sigmoid(fp) / len(p), sigmoid(fu) / len(u)
        rest = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        if against:
            gp, gu = as_good, (1 - prior) * u_bad
        elif rest >= 0:
            gp, gu = as_good + p_bad, u_bad
        else:
            gp, gu = -p_bad, -u_bad
        g = np.append(p.T @ gp + u.T @ gu + l2 * w, gp.sum() + gu.sum())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g**2
        d = 0.03 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        w, b = w - d[:-1], b - d[-1]
    return Model(mean, scale, w, float(b))


def class_prior(positive: np.ndarray, unlabelled: np.ndarray, delta: float = 0.1, gamma: float = 0.01) -> float:
    """The share of positives among the unlabelled: the mean over two halves, each judged by a classifier of the other."""
    if min(len(positive), len(unlabelled)) < 40:
        return 0.5
    found = []
    for k in (0, 1):
        p, q, u, v = positive[k::2], positive[1 - k :: 2], unlabelled[k::2], unlabelled[1 - k :: 2]
        # at equal weights the risk's two expectations are those of a classifier of P against U
        model = fit(p, u, 0.5, STEPS // 2, 1e-3, against=True)
        sp, su = np.sort(model.score(q))[::-1], np.sort(model.score(v))
        of_p, of_u = np.arange(1, len(sp) + 1) / len(sp), 1 - np.searchsorted(su, sp, side="left") / len(su)
        error = np.sqrt(np.log(4 / delta) / 2 / len(sp)) + np.sqrt(np.log(4 / delta) / 2 / len(su))
        best = np.argmin(of_u / of_p + (1 + gamma) / of_p * error)
        found.append(of_u[best] / of_p[best])
    return float(np.clip(np.mean(found), 0.01, 0.99))


KIND = np.float16


def statistics_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, x (the statistics as 16-bit numbers), learn (whether the row is outside the held-out fold): one row per input row."""
    rows = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"), (fold(quoted(id_col)) != 0).alias("learn"), F.xxhash64(quoted(text_col)).alias("draw"))

    def stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([statistics(t.as_py()).astype(KIND).tobytes() for t in b.column(1)], pa.binary()), b.column(2), b.column(3)], ["id", "x", "learn", "draw"])

    return map_arrow(rows, stats, f"id {rows.schema['id'].dataType.simpleString()}, x binary, learn boolean, draw long")


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=KIND).reshape(-1, N_STATS).astype(np.float64)


def _gather(rows: DataFrame) -> np.ndarray:
    """Statistics of a bounded sample's texts, in an order that no run changes."""
    got = sorted(rows.select("x").toArrow().column("x").to_pylist())
    return np.frombuffer(b"".join(got), dtype=KIND).reshape(-1, N_STATS).astype(np.float64)


def _sums(stats: DataFrame, model: Model) -> tuple[np.ndarray, float]:
    """Over all rows of ``stats``: the mean gradient of l(-f) by weights and bias, the mean of l(-f).  Partial sums meet element by element, so that the driver gets one row for each weight."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(N_STATS + 3)
        for b in batches:
            if b.num_rows:
                z = np.clip((_matrix(b.column(0)) - model.mean) / model.scale, -6, 6)
                f = z @ model.weights + model.bias
                s = 1 / (1 + np.exp(-np.clip(f, -30, 30)))
                total += np.concatenate([s @ z, [s.sum(), np.logaddexp(0, f).sum(), len(f)]])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], ["k", "v"])

    got = map_arrow(stats.select("x"), add, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()
    total = np.zeros(N_STATS + 3)
    for r in got:
        total[r["k"]] = r["v"]
    return total[: N_STATS + 1] / max(1.0, total[-1]), total[-2] / max(1.0, total[-1])


def _over_all(model: Model, positive: np.ndarray, start: np.ndarray, prior: float, stats: DataFrame, passes: int, l2: float = 1e-4) -> Model:
    """``model`` moved to lower risk, its unlabelled part being that of all of ``stats``."""
    z = lambda x: np.hstack([np.clip((x - model.mean) / model.scale, -6, 6), np.ones((len(x), 1))])
    p, u = z(positive), z(start)
    theta, ridge = np.append(model.weights, model.bias), np.append(np.full(N_STATS, l2), 0.0)
    s = 1 / (1 + np.exp(-np.clip(u @ theta, -30, 30)))
    curvature = (u * (s * (1 - s))[:, None]).T @ u / len(u) + np.diag(ridge) + 1e-3 * np.eye(len(theta))
    best, least, direction, step = theta, np.inf, np.zeros_like(theta), 1.0
    for _ in range(passes):
        tried = best - step * direction if np.isfinite(least) else best
        now = Model(model.mean, model.scale, tried[:-1], float(tried[-1]))
        gradient, loss = _sums(stats, now)
        fp = p @ tried
        rest = loss - prior * np.logaddexp(0, fp).mean()
        risk = prior * np.logaddexp(0, -fp).mean() + max(0.0, rest) + 0.5 * (ridge * tried**2).sum()
        if risk >= least - 1e-7:
            step /= 2
            continue
        best, least, step = tried, risk, 1.0
        # l(f) - l(-f) = -f, so that all of P's part is linear; where the rest is negative, steps go against it
        as_good = -prior * p.T @ (1 / (1 + np.exp(np.clip(fp, -30, 30)))) / len(p)
        g = gradient - prior * p.mean(axis=0) if rest >= 0 else as_good - (gradient - prior * p.T @ (1 / (1 + np.exp(-np.clip(fp, -30, 30)))) / len(p))
        direction = np.linalg.solve(curvature, g + ridge * tried)
    return Model(model.mean, model.scale, best[:-1], float(best[-1]))


def train(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", max_positive: int = MAX_POSITIVE, max_start: int = MAX_START, passes: int = PASSES) -> tuple[Model | None, float]:
    """(model, class prior).  ``stats``: of the rows that may be learnt from, a staged table; ``labels``: theirs."""
    marked = labels.select(quoted(id_col).alias("id"), quoted(label_col).alias("label")).where("id is not null and label = 1")
    marked = staged(marked.select("id").distinct(), "quality-labels")
    chosen = staged(bounded(marked, F.col("id"), max_positive, marked.count()), "quality-positive")
    if chosen.count() <= 2 * max_positive:  # the bound of the sample; its ids are then no more than some 100 kB
        chosen = F.broadcast(chosen)
    # rows of one text are one: repeated identifiers and copies add nothing to the sample
    positive = _gather(stats.join(chosen, "id", "left_semi").dropDuplicates(["draw", "x"]))
    start = _gather(bounded(stats, F.col("draw"), max_start, stats.count(), salt=2).dropDuplicates(["draw", "x"]))
    if not len(positive) or not len(start):
        return None, 0.5
    prior = class_prior(positive, start)
    return _over_all(fit(positive, start, prior), positive, start, prior, stats, passes), prior


def score(stats: DataFrame, model: Model | None, prior: float) -> DataFrame:
    """id, score: one row for each of ``stats``."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = np.full(b.num_rows, prior) if model is None or not b.num_rows else model.score(_matrix(b.column(1)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s)], ["id", "score"])

    return map_arrow(stats.select("id", "x"), scored, f"id {stats.schema['id'].dataType.simpleString()}, score double")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    stats = staged(statistics_of(docs), "quality-statistics")
    model, prior = train(stats.where("learn"), labels.where(fold(F.col("doc_id")) != 0))
    out = score(stats, model, prior)
    return out.select(F.col("id").alias("doc_id"), (fold(F.col("id")) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
