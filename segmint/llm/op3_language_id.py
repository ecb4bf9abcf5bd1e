"""Language identification with averaged hashed subword embeddings.

A word gives its byte n-grams (with word-boundary marks) and itself, hashed to
``BUCKETS``; a text is the average of the embeddings of all its grams; a linear
softmax turns that into language probabilities. Embeddings and softmax are
trained together by mini-batch stochastic gradient descent in numpy on a
bounded, hash-chosen sample of labelled rows; tasks send only hashed counts, at
most ``BUCKETS`` a row. A temperature calibrates the probabilities, and a
rejection threshold is set, on sample rows the training has not seen.

Because averaging and the last layer are linear, prediction needs one small
vector of logits per distinct word, computed once per worker.

Defined cases: a null text or one without any letter is ``und`` with score 0;
so is every text if no row is labelled; an unknown language below the
rejection threshold is ``und`` for ``detect`` unless ``reject`` is off. Very
long texts are averaged whole; of languages with equal probability the first in
order of value is taken; repeated rows are predicted alike; an empty table gives
no rows. A column that is already named like the output is replaced, all others
are kept.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordTable, blocks, gram_buckets, held_out, letter_words, sampled_labels, word_hash

BUCKETS = 1 << 13
DIM = 16
#: Labelled rows read per language (at most 64 languages): the fit's bound.
PER_LANGUAGE = 600
EPOCHS = 12
BATCH = 32
#: Share of correct answers wanted among those that are not rejected.
WANTED = 0.995


def grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words' 2- to 4-grams and of the words themselves, and the
    number of the word each belongs to."""
    flat, owner = gram_buckets(words, (2, 3, 4), BUCKETS)
    return np.concatenate([flat, word_hash(words, BUCKETS, 1)]), np.concatenate([owner, np.arange(len(words))])


def _features(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        rows = []
        for t in batch:
            seen = Counter(letter_words(t or ""))
            c = np.zeros(0)
            if seen:
                flat, owner = grams(list(seen))
                c = np.bincount(flat, weights=np.fromiter(seen.values(), float, len(seen))[owner], minlength=BUCKETS)
            at = np.flatnonzero(c)
            rows.append((at.astype(np.int32), c[at].astype(np.float32)))
        yield pd.DataFrame(rows, columns=["buckets", "counts"])


class LanguageModel:
    def __init__(self, langs, logits, bias, temperature, reject):
        #: logits: BUCKETS x languages, the embeddings times the softmax weights.
        self.langs, self.logits, self.bias = list(langs), logits, bias
        self.temperature, self.reject = temperature, reject

    def probabilities(self, mean: np.ndarray) -> np.ndarray:
        z = (mean + self.bias) / self.temperature
        e = np.exp(z - z.max(axis=-1, keepdims=True))
        return e / e.sum(axis=-1, keepdims=True)


def train(x: list, y: np.ndarray, n_lang: int, seed: int = 42) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Embeddings (BUCKETS x DIM), softmax weights and bias. x: (buckets,
    counts) per row."""
    rng = np.random.default_rng(seed)
    emb = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    w, b = np.zeros((DIM, n_lang), np.float32), np.zeros(n_lang, np.float32)
    share = np.bincount(y, minlength=n_lang).astype(np.float64)
    weight = (len(y) / (n_lang * np.maximum(share, 1)))[y].astype(np.float32)
    steps, done = EPOCHS * max(1, -(-len(y) // BATCH)), 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for lo in range(0, len(y), BATCH):
            take = order[lo : lo + BATCH]
            dense = np.zeros((len(take), BUCKETS), np.float32)
            for i, k in enumerate(take):
                dense[i, x[k][0]] = x[k][1] / max(1.0, x[k][1].sum())
            rate = 1.0 - done / steps
            h = dense @ emb
            z = h @ w + b
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(take)), y[take]] -= 1.0
            g = p * weight[take][:, None] / len(take)
            back = g @ w.T
            # The average spreads a row over all its grams, so the embeddings'
            # gradients are smaller by about the number of grams in use.
            emb -= 200.0 * rate * (dense.T @ back)
            w -= 4.0 * rate * (h.T @ g)
            b -= 0.2 * rate * g.sum(0)
            done += 1
    return emb, w, b


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, text: str = "text", lang: str = "lang") -> LanguageModel:
    """Learn from rows that are not held out and have a language."""
    known = docs.where(~held_out() & F.col(lang).isNotNull())
    keys = sampled_labels(known.select("doc_id", lang), "doc_id", lang, per_language)
    sample = known.select("doc_id", F.col(text).alias("text")).join(F.broadcast(keys), "doc_id").dropDuplicates(["doc_id"])
    got = sample.select(F.col(lang).alias("lang"), F.pmod(F.xxhash64("doc_id", F.lit(13)), F.lit(5)).alias("part"),
                        F.pandas_udf(_features, "buckets array<int>, counts array<float>")("text").alias("f")).select("lang", "part", "f.*").orderBy("lang", "part").toPandas()
    got = got[got["counts"].map(len) > 0].reset_index(drop=True)
    got = got.iloc[np.argsort([zlib.crc32(np.asarray(a, np.int32).tobytes()) for a in got["buckets"]], kind="stable")]
    langs = sorted(got["lang"].unique())
    if not langs:
        return LanguageModel([], None, None, 1.0, 0.0)
    y = got["lang"].map({v: i for i, v in enumerate(langs)}).to_numpy()
    x = [(np.asarray(a, np.int64), np.asarray(c, np.float32)) for a, c in zip(got["buckets"], got["counts"], strict=True)]
    test = (got["part"] == 0).to_numpy()
    if not test.any() or len(set(y[~test])) < len(langs):
        test[:] = False
    train_x = [x[i] for i in np.flatnonzero(~test)]
    emb, w, b = train(train_x, y[~test], len(langs))
    model = LanguageModel(langs, emb @ w, b, 1.0, 0.0)
    at = np.flatnonzero(test) if test.any() else np.arange(len(y))
    mean = np.stack([(x[i][1] / x[i][1].sum()) @ model.logits[x[i][0]] for i in at])
    best = np.inf
    for t in np.geomspace(0.05, 5, 60):
        model_t = LanguageModel(langs, None, b, t, 0.0)
        loss = -np.log(np.maximum(model_t.probabilities(mean)[np.arange(len(at)), y[at]], 1e-6)).mean()
        if loss < best - 1e-9:
            best, model.temperature = loss, float(t)
    p = model.probabilities(mean)
    top, right = p.max(1), p.argmax(1) == y[at]
    order = np.argsort(-top)
    precise = np.cumsum(right[order]) / np.arange(1, len(at) + 1) >= WANTED
    last = np.flatnonzero(precise)
    model.reject = float(top[order][last[-1]]) if len(last) else 1.0
    return model


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def detect(docs: DataFrame, model: LanguageModel, text: str = "text", out: str = "language",
           reject: bool = True) -> DataFrame:
    """``docs`` with struct ``out``: lang (``und`` below the calibrated
    threshold if ``reject``), score, and rejected."""
    n = len(model.langs)

    @F.pandas_udf("lang string, score double, rejected boolean")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        def rows(words):
            flat, owner = grams(words)
            out = np.empty((len(words), n + 1))
            for k in range(n):
                out[:, k] = np.bincount(owner, weights=model.logits[flat, k], minlength=len(words))
            out[:, n] = np.bincount(owner, minlength=len(words))
            return out

        table = WordTable(rows, n + 1)
        for batch in texts:
            got = []
            for block in blocks(batch):
                words = [letter_words(t) if n and t and has_letter(t) else None for t in block]
                table.room()
                s = table.sums([w or [] for w in words])
                p = model.probabilities(s[:, :n] / np.maximum(1.0, s[:, n:])) if n else None
                for i, w in enumerate(words):
                    if w is None:
                        got.append(("und", 0.0, True))
                        continue
                    k = int(p[i].argmax())
                    no = bool(p[i, k] < model.reject)
                    got.append(("und" if no and reject else model.langs[k], float(p[i, k]), no))
            yield pd.DataFrame(got, columns=["lang", "score", "rejected"])

    return docs.withColumn(out, run(F.col(text)))


def q_op3(spark, sf):
    """Every whole text of ``documents``; a learned language for each text
    with a letter, and whether the calibrated threshold would reject it."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    model = fit(docs)
    return detect(docs.select("doc_id", "text"), model, reject=False).select(
        "doc_id", held_out().alias("held_out"), F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"), F.col("language.rejected").alias("rejected"))
