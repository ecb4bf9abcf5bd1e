"""Toxic passages as maximum-scoring segments.

Training (rows that are not held out; a documented bound per label): word
counts of toxic and other texts give each word a log-odds score under an
informative Dirichlet prior (prior mass spread like the pooled word
frequencies). Only words whose document counts differ significantly
(likelihood ratio) score; all others cost a small constant, the drift.

Scoring: one linear-time scan finds every maximal scoring segment of a text.
Under the background word distribution the best segment of n words follows an
extreme-value law with parameters lambda (root of sum p e^(lambda s) = 1) and
K (from the maxima of non-toxic texts), so a segment of score S has the
expected number K n e^(-lambda S) by chance. Segments below ``alpha`` are
reported; the document's evidence -log(E) of the best segment and the number of
significant segments are calibrated to a probability on training rows that the
counts have not seen.

Defined cases: a null, empty or wordless text has no segment and the
probability of a text without one; without labels of both kinds every score
is 0; repeated rows are scored alike, but an id counts once in the fit (with
its larger label); very long texts are scanned whole; of equally good segments
the shorter stands, and words that tie in the ratio all score; an empty table
gives no rows. ``score`` replaces a column that is already named like its
output, and keeps all others.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, letter_words, sampled_labels

#: Labelled rows that are read per label value: the bound of the fit.
PER_CLASS = 12_000
PRIOR_MASS = 20_000.0
MIN_LIKELIHOOD_RATIO = 16.0
DRIFT = 0.08
ALPHA = 0.05


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end exclusive, score) in linear
    time: each positive run is appended to a stack of candidates, and merged
    with an earlier one while that lengthens it at a better score."""
    hot = np.flatnonzero(scores > 0)
    if not len(hot):
        return []
    total = np.concatenate([[0.0], np.cumsum(scores, dtype=np.float64)])
    # Each candidate: start, end, cumulative score before it and after it, and
    # the number of the nearest one before it that starts lower. Those between
    # start no lower, so a search may hop over them: the scan stays linear.
    stack: list[tuple[int, int, float, float, int]] = []
    for i in hot.tolist():
        first, last, low, high = i, i + 1, total[i], total[i + 1]
        j = len(stack) - 1
        while True:
            while j >= 0 and stack[j][2] >= low:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= high:
                stack.append((first, last, low, high, j))
                break
            first, low = stack[j][0], stack[j][2]
            del stack[j:]
            j -= 1
    return [(a, b, high - low) for a, b, low, high, _ in stack]


class ToxicityModel:
    """Word scores, extreme-value parameters and calibration; plain data."""

    def __init__(self, scores: dict[bytes, float], lam: float, log_k: float, weights=(0.0, 0.0, 0.0)):
        self.scores, self.lam, self.log_k, self.weights = scores, lam, log_k, tuple(weights)
        self.positive = frozenset(w for w, x in scores.items() if x > 0)

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, int, float]]]:
        """Number of words and the segments, with their evidence -log(E)."""
        words = letter_words(text) if text else []
        if self.positive.isdisjoint(words):  # most texts: no segment can be positive
            return len(words), []
        get, drift = self.scores.get, -DRIFT
        s = np.fromiter((get(w, drift) for w in words), np.float64, len(words))
        base = self.log_k + math.log(len(words))
        return len(words), [(a, b, self.lam * x - base) for a, b, x in segments(s)]

    def evidence(self, segs) -> tuple[float, int]:
        """Of the best segment, between 0 and 60, and how many are significant."""
        best = max((e for _, _, e in segs), default=0.0)
        return min(60.0, max(0.0, best)), sum(e >= -math.log(ALPHA) for _, _, e in segs)

    def probability(self, segs) -> float:
        if not self.scores:
            return 0.0
        best, n = self.evidence(segs)
        z = self.weights[0] + self.weights[1] * math.sqrt(best) + self.weights[2] * math.log1p(n)
        return 1.0 / (1.0 + math.exp(-max(-40.0, min(40.0, z))))


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, toxic, tokens, docs) over rows (text, toxic): counted by batch in
    the tasks, then summed by Spark."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tokens, docs = (Counter(), Counter()), (Counter(), Counter())
            for t, y in zip(b.column(0), b.column(1), strict=True):
                w = letter_words(t.as_py() or "")
                tokens[y.as_py()].update(w)
                docs[y.as_py()].update(set(w))
            for y in (0, 1):
                words = list(tokens[y])
                yield pa.record_batch([
                    pa.array(words, pa.binary()), pa.array([y] * len(words), pa.int32()),
                    pa.array([tokens[y][w] for w in words], pa.int64()),
                    pa.array([docs[y][w] for w in words], pa.int64())], names=["word", "toxic", "tokens", "docs"])

    parts = rows.select("text", "toxic").mapInArrow(count, "word binary, toxic int, tokens bigint, docs bigint")
    y1 = F.col("toxic") == 1
    return parts.groupBy("word").agg(
        F.sum(F.when(y1, F.col("tokens")).otherwise(0)).alias("t1"),
        F.sum(F.when(~y1, F.col("tokens")).otherwise(0)).alias("t0"),
        F.sum(F.when(y1, F.col("docs")).otherwise(0)).alias("d1"),
        F.sum(F.when(~y1, F.col("docs")).otherwise(0)).alias("d0"))


def _lambda(p: np.ndarray, s: np.ndarray) -> float:
    """Positive root of sum p e^(lambda s) = 1; 0 if there is none."""
    if not len(s) or s.max() <= 0 or (p * s).sum() >= 0:
        return 0.0
    lo, hi = 1e-6, 1.0
    f = lambda x: float((p * np.exp(np.minimum(x * s, 700.0))).sum()) - 1.0
    while f(hi) < 0 and hi < 1e3:
        hi *= 2
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (lo, mid) if f(mid) > 0 else (mid, hi)
    return lo


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Ridge-regularised weighted logistic regression by Newton's method."""
    x = np.column_stack([np.ones(len(x)), x])
    b = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        g = x.T @ (w * (p - y)) + 0.1 * b * (np.arange(len(b)) > 0)
        h = (x * (w * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(b))
        b -= np.linalg.solve(h, g)
    return b


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> ToxicityModel:
    """Learn from labelled rows that are not held out, about ``per_class`` of
    each label."""
    lab = sampled_labels(labels.where(~held_out()).select("doc_id", "toxic"), "doc_id", "toxic", per_class)
    rows = docs.select("doc_id", "text").join(F.broadcast(lab), "doc_id").dropDuplicates(["doc_id"])
    part = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(4))
    rows = rows.withColumn("seen", part != 0).select("seen", "text", F.col("toxic").cast("int").alias("toxic"))
    rows = rows.where(F.col("toxic").isin(0, 1)).persist()
    try:
        n = {(r["seen"], r["toxic"]): r["n"] for r in rows.groupBy("seen", "toxic").agg(F.count("*").alias("n")).collect()}
        n1, n0 = n.get((True, 1), 0), n.get((True, 0), 0)
        if not n1 or not n0:
            return ToxicityModel({}, 0.0, 0.0)
        counts = word_counts(rows.where("seen")).persist()
        tot = counts.agg(F.sum("t1").alias("t1"), F.sum("t0").alias("t0")).first()
        t1, t0 = float(tot["t1"] or 0), float(tot["t0"] or 0)
        d1, d0 = F.col("d1"), F.col("d0")
        xlog = lambda a, b: F.when(a > 0, a * F.log(a / b)).otherwise(0.0)
        e1, e0 = (d1 + d0) * (n1 / (n1 + n0)), (d1 + d0) * (n0 / (n1 + n0))
        ratio = 2 * (xlog(d1, e1) + xlog(d0, e0))
        # Every significant word: the ratio asks for several documents of the
        # bounded sample that hold the word, so the sample bounds their number.
        top = counts.withColumn("g", ratio).where(F.col("g") >= MIN_LIKELIHOOD_RATIO).orderBy(F.desc("g"), "word").collect()
        counts.unpersist()
        scores, p, s = {}, [], []
        for r in top:
            a = PRIOR_MASS * (r["t1"] + r["t0"]) / (t1 + t0)
            x1, x0 = r["t1"] + a, r["t0"] + a
            x = math.log(x1 / (t1 + PRIOR_MASS - x1)) - math.log(x0 / (t0 + PRIOR_MASS - x0))
            scores[bytes(r["word"])] = x
            p.append(x0 / (t0 + PRIOR_MASS))
            s.append(x)
        rest = max(0.0, 1.0 - sum(p))
        lam = _lambda(np.array([*p, rest]), np.array([*s, -DRIFT]))
        if lam <= 0:
            return ToxicityModel({}, 0.0, 0.0)
        model = ToxicityModel(scores, lam, 0.0)

        @F.pandas_udf("words bigint, best double")
        def maxima(texts: pd.Series) -> pd.DataFrame:
            out = []
            for t in texts:
                k, segs = model.scan(t)
                out.append((k, max((e for _, _, e in segs), default=float("nan"))))
            return pd.DataFrame(out, columns=["words", "best"])

        # Mean of the Gumbel law: log K + Euler's constant, over quiet texts
        # that have a segment at all.
        k = rows.where("seen and toxic = 0").select(maxima("text").alias("m")).select("m.*")
        mean = k.where(F.col("best").isNotNull() & ~F.isnan("best")).agg(F.avg("best").alias("b"), F.count("*").alias("n")).first()
        share = (mean["n"] or 0) / n0
        model.log_k = (mean["b"] or 0.0) - 0.5772 + math.log(max(share, 1e-3))

        @F.pandas_udf("best double, n double")
        def evidence(texts: pd.Series) -> pd.DataFrame:
            return pd.DataFrame([model.evidence(model.scan(t)[1]) for t in texts], columns=["best", "n"])

        held = rows.where("not seen").select("toxic", evidence("text").alias("m")).select("toxic", "m.*").toPandas()
        if held["toxic"].nunique() < 2:
            held = rows.select("toxic", evidence("text").alias("m")).select("toxic", "m.*").toPandas()
        x = np.column_stack([np.sqrt(held["best"]), np.log1p(held["n"])])
        model.weights = tuple(_logistic(x, held["toxic"].to_numpy(float), np.ones(len(held))))
        return model
    finally:
        rows.unpersist()


def score(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """``docs`` with ``toxicity``: struct of the probability, the best
    evidence and the significant passages (word positions, evidence)."""
    out = "score double, evidence double, passages array<struct<first:int, last:int, evidence:double>>"

    @F.pandas_udf(out)
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            rows = []
            for t in batch:
                _, segs = model.scan(t)
                rows.append((model.probability(segs), model.evidence(segs)[0],
                             [{"first": a, "last": b - 1, "evidence": e} for a, b, e in segs if e >= -math.log(ALPHA)]))
            yield pd.DataFrame(rows, columns=["score", "evidence", "passages"])

    return docs.withColumn("toxicity", run(F.col(text)))


def q_op2(spark, sf):
    """Every whole text of ``documents``, scored by a model of the rows that
    are not held out."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    return score(docs, model).select(
        "doc_id", held_out().alias("held_out"), F.col("toxicity.score").alias("score"),
        F.when(F.col("toxicity.score") >= 0.3, 1).otherwise(0).cast("int").alias("predicted"),
        F.size("toxicity.passages").alias("n_passages"))
