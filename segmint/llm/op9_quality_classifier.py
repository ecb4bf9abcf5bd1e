"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Grades are ordered (here 0 low quality, 1 good but toxic, 2 good); one weight
vector w over hashed text features is shared by all of them, and ordered
thresholds cut the line: P(grade <= k) = sigmoid(theta_k - w x). That gives the
expected grade and the tail probabilities P(grade >= k) for selection.

Features, hashed to ``BUCKETS``: the shapes of the words (case, digits, other
characters, runs collapsed), the words' character trigrams, both averaged over
the whole text, and bucketed measurements of the text (length, repeats of the
word before, repeated lines, distinct share). A word's sum of weights is
computed once per worker, so whole texts are read at the price of a table
look-up a word.

Trained by stochastic gradient descent in numpy on a bounded, hash-chosen
sample of rated rows, weighted back to the grades' shares in all rated rows.
Defined cases: a null text or one without words has grade 0 and tails 0;
without ratings of two grades nothing is rejected (all tails 1). Very long
texts are read whole; repeated rows are scored alike, and an id with several
ratings counts once with its highest; a tail equal to the limit is kept; an
empty table gives no rows. A column that is already named like the output is
replaced, all others are kept.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WordTable, arrow_blocks, gram_buckets, held_out, sampled_labels, word_hash

BUCKETS = 1 << 13
#: Rated rows read per grade: the bound of the fit.
PER_GRADE = 1_500
EPOCHS = 30
BATCH = 32
#: A document is rejected if P(grade >= 1) is below this.
MIN_TAIL = 0.5

_RUN = re.compile(r"(.)\1+")
#: Letters as a or A, digits as 0, other ASCII characters as they are.
_ASCII = {c: "A" if chr(c).isupper() else "a" if chr(c).isalpha() else "0" if chr(c).isdigit() else chr(c)
          for c in range(128)}


def shape(word: str) -> str:
    """Letters as a or A, digits as 0, others as they are, runs collapsed."""
    if not word.isascii():
        word = "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word)
    return _RUN.sub(r"\1", word.translate(_ASCII))


def word_parts(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of each word's shape; buckets of the trigrams of the lower-cased
    words and the number of the word each belongs to."""
    s = word_hash([shape(w).encode("utf-8", "replace") for w in words], BUCKETS, 2)
    flat, owner = gram_buckets([w.lower().encode("utf-8", "replace") for w in words], (3,), BUCKETS)
    return s, flat, owner


def _bucket(kind: str, value: str) -> int:
    return zlib.crc32(f"{kind}:{value}".encode()) & (BUCKETS - 1)


def text_buckets(text: str, words: list[str]) -> list[int]:
    """Buckets of the measurements of a whole text."""
    n = len(words)
    again = sum(map(str.__eq__, words, words[1:])) / n
    lines = [x for x in text.split("\n") if x.strip()]
    repeated = 1 - len(set(lines)) / len(lines)
    distinct = len(set(words)) / n
    size = n.bit_length()
    return [_bucket("n", str(size)), _bucket("again", str(int(again * 10))), _bucket("lines", str(int(repeated * 5))),
            _bucket("distinct", f"{size}:{int(distinct * 10)}")]


def _features(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        rows = []
        for t in batch:
            words = (t or "").split()
            x = np.zeros(BUCKETS, np.float64)
            if words:
                seen = Counter(words)
                k = np.fromiter(seen.values(), float, len(seen))
                shapes, flat, owner = word_parts(list(seen))
                x += np.bincount(shapes, weights=k, minlength=BUCKETS) / len(words)
                x += np.bincount(flat, weights=k[owner], minlength=BUCKETS) / max(1.0, k[owner].sum())
                x[list(set(text_buckets(t, words)))] += 0.25
            at = np.flatnonzero(x)
            rows.append((at.astype(np.int32), x[at].astype(np.float32)))
        yield pd.DataFrame(rows, columns=["buckets", "weights"])


class OrdinalModel:
    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights, thresholds

    def tails(self, z) -> np.ndarray:
        """P(grade >= k), k from 1, of scores z."""
        return 1 / (1 + np.exp(-np.clip(np.asarray(z)[..., None] - self.thresholds, -40, 40)))


def train(x: list, y: np.ndarray, sample_weight: np.ndarray, grades: int, seed: int = 42) -> OrdinalModel:
    """x: (buckets, weights) per row; y: grades from 0. Gradient steps on the
    shared weights and on the thresholds, which are kept in order by their
    logarithmic gaps."""
    rng = np.random.default_rng(seed)
    w = np.zeros(BUCKETS, np.float32)
    first, gaps = -1.0, np.full(grades - 2, 0.0)
    steps, done = EPOCHS * max(1, -(-len(y) // BATCH)), 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for lo in range(0, len(y), BATCH):
            take = order[lo : lo + BATCH]
            dense = np.zeros((len(take), BUCKETS), np.float32)
            for i, k in enumerate(take):
                dense[i, x[k][0]] = x[k][1]
            theta = np.concatenate([[first], first + np.cumsum(np.exp(gaps))])
            cdf = 1 / (1 + np.exp(-np.clip(theta[None, :] - (dense @ w)[:, None], -30, 30)))
            cdf = np.column_stack([np.zeros(len(take)), cdf, np.ones(len(take))])
            g = y[take]
            rows = np.arange(len(take))
            hi, lo_ = cdf[rows, g + 1], cdf[rows, g]
            prob = np.maximum(hi - lo_, 1e-9)
            sw = sample_weight[take] / len(take)
            # d log P / d z = hi + lo - 1 towards larger z
            dz = -(hi * (1 - hi) - lo_ * (1 - lo_)) / prob
            rate = 1.0 - done / steps
            w += (8.0 * rate * (dense.T @ (sw * dz))).astype(np.float32)
            dtheta = np.zeros((len(take), grades + 1))
            dtheta[rows, g + 1] += hi * (1 - hi) / prob
            dtheta[rows, g] -= lo_ * (1 - lo_) / prob
            d = (sw[:, None] * dtheta[:, 1:grades]).sum(0)
            first += 0.2 * rate * d.sum()
            if grades > 2:
                gaps += 0.2 * rate * np.cumsum(d[::-1])[::-1][1:] * np.exp(gaps)
            done += 1
    return OrdinalModel(w, np.concatenate([[first], first + np.cumsum(np.exp(gaps))]))


def grades_of(labels: DataFrame) -> DataFrame:
    """doc_id and grade: 0 low quality, 1 good but toxic, 2 good."""
    good = F.col("quality") >= 1
    return labels.where(F.col("quality").isNotNull()).select("doc_id", F.when(~good, 0).when(
        F.coalesce(F.col("toxic"), F.lit(0)) >= 1, 1).otherwise(2).alias("grade"))


def fit(docs: DataFrame, ratings: DataFrame, per_grade: int = PER_GRADE) -> OrdinalModel | None:
    """ratings: doc_id, grade (0, 1, ..). Rows that are held out stay unseen.
    None without at least two grades."""
    rated = ratings.where(~held_out())
    keys = sampled_labels(rated, "doc_id", "grade", per_grade)
    total = {r[0]: r[1] for r in rated.groupBy("grade").count().collect()}
    got = docs.select("doc_id", "text").join(F.broadcast(keys), "doc_id").dropDuplicates(["doc_id"]).select(
        "doc_id", "grade", F.pandas_udf(_features, "buckets array<int>, weights array<float>")("text").alias("f")).select("doc_id", "grade", "f.*").toPandas()
    got = got[got["buckets"].map(len) > 0].sort_values("doc_id").reset_index(drop=True)
    seen = sorted(got["grade"].unique())
    if len(seen) < 2:
        return None
    y = got["grade"].to_numpy(int)
    n = got["grade"].value_counts()
    sw = np.array([total[g] / n[g] for g in y])
    x = [(np.asarray(a, np.int64), np.asarray(b, np.float32)) for a, b in zip(got["buckets"], got["weights"], strict=True)]
    return train(x, y, sw / sw.mean(), max(seen) + 1)


def tails_column(text: Column, model: OrdinalModel | None, grades: int = 3) -> Column:
    """``array<double>``: P(grade >= 1), P(grade >= 2), .. of a whole text."""

    @F.arrow_udf("array<double>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        def rows(words):
            s, flat, owner = word_parts(words)
            n = len(words)
            return np.column_stack([model.weights[s], np.bincount(owner, weights=model.weights[flat], minlength=n),
                                    np.bincount(owner, minlength=n)])

        table = WordTable(rows, 3)
        k = len(model.thresholds) if model else grades - 1
        for block in arrow_blocks(batches):
            words = [(t or "").split() for t in block]
            out = []
            if model is None:
                out = [[1.0 if w else 0.0] * k for w in words]
            else:
                table.room()
                s = table.sums(words)
                for t, w, (a, b, c) in zip(block, words, s, strict=True):
                    if not w:
                        out.append([0.0] * k)
                        continue
                    own = float(model.weights[list(set(text_buckets(t, w)))].sum())
                    out.append(model.tails(a / len(w) + b / max(1.0, c) + 0.25 * own).tolist())
            yield pa.array(out, pa.list_(pa.float64()))

    return run(text)


def graded(docs: DataFrame, model: OrdinalModel | None, text: str = "text", out: str = "tails") -> DataFrame:
    """``docs`` with the tail probabilities in ``out``; their sum is the
    expected grade."""
    return docs.withColumn(out, tails_column(F.col(text), model))


def q_op9(spark, sf):
    """Every row of ``documents``: expected grade, tails and the selection."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    model = fit(docs, grades_of(spark.read.parquet(f"{sf}/labels.parquet")))
    g = graded(docs, model)
    return g.select("doc_id", held_out().alias("held_out"),
                    F.aggregate("tails", F.lit(0.0), lambda a, x: a + x).alias("expected_grade"),
                    F.col("tails")[0].alias("p_good"), (F.col("tails")[0] >= MIN_TAIL).alias("kept"))


def quality_stage(spark, docs, sf_dir):
    """Pipeline stage: documents with P(grade >= 1) under the limit go; the
    columns stay as they are."""
    model = fit(docs, grades_of(spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return docs.where(tails_column(F.col("text"), model)[0] >= MIN_TAIL)
