"""Helpers shared by the operators: held-out rows, bounded samples, word
splitting and per-worker word tables."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes translation: A-Z to a-z; other ASCII that is not a letter to a space.
#: Bytes of non-ASCII letters stay, so UTF-8 words stay whole.
LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def held_out(doc_id: str = "doc_id") -> Column:
    """True for rows that models never learn from: crc32 of the id's text has
    the remainder 2 modulo 4. False for a null id."""
    crc = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    return F.coalesce(F.pmod(crc, F.lit(4)) == 2, F.lit(False))


def letter_words(text: str) -> list[bytes]:
    """Lower-cased words of letters (any non-ASCII character counts as one)."""
    return text.lower().encode("utf-8", "replace").translate(LETTERS).split()


#: Expected rows of a label value that are too few to rely on.
LEAST_PER_CLASS = 20


def sampled_labels(labels: DataFrame, key: str, label: str, per_class: int, max_classes: int = 64) -> DataFrame:
    """One row per ``key`` and about ``per_class`` keys for each label value:
    all of a class that has no more, else the keys whose hash falls under the
    class's rate. Every label value is kept: with more than ``max_classes`` of
    them each has fewer rows, and more than leave ``LEAST_PER_CLASS`` for each
    raise an error. The size is bounded by about ``per_class * max_classes``
    whatever the input's size, so the result may be broadcast. Null keys and labels are left out; a key with
    several labels takes the largest."""
    one = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(key).agg(F.max(label).alias(label))
    most = max(max_classes, per_class * max_classes // LEAST_PER_CLASS)
    counts = one.groupBy(label).count().orderBy(F.desc("count"), label).limit(most + 1).collect()
    if len(counts) > most:
        raise ValueError(f"more than {most} values of {label}")
    keep = F.lit(False)
    span = 1 << 30
    if len(counts) > max_classes:  # a table of rates: too many for one expression
        per_class = per_class * max_classes // len(counts)
        rates = [(r[0], int(min(1.0, per_class / r["count"]) * span)) for r in counts]
        rates = labels.sparkSession.createDataFrame(rates, T.StructType([one.schema[label], T.StructField("__cut", T.LongType())]))
        chosen = one.join(F.broadcast(rates), label).where(F.pmod(F.xxhash64(F.col(key), F.lit(7)), F.lit(span)) < F.col("__cut"))
        return chosen.select(key, label)
    for r in counts:
        cut = int(min(1.0, per_class / r["count"]) * span)
        keep = keep | ((F.col(label) == F.lit(r[0])) & (F.pmod(F.xxhash64(F.col(key), F.lit(7)), F.lit(span)) < cut))
    return one.where(keep)


class WordTable(dict):
    """Word -> row number of a matrix that ``rows`` fills, a list of new words
    at a time, so each distinct word is worked out once per worker.

    ``room()``, called between blocks of texts, empties the table when it has
    grown past ``limit`` words: its memory is bounded, and emptying never
    changes a result."""

    def __init__(self, rows, width: int, limit: int = 300_000):
        super().__init__()
        self.rows, self.width, self.limit = rows, width, limit
        self.empty()

    def empty(self):
        self.clear()
        self.matrix, self.new = np.zeros((4096, self.width), np.float32), []

    def room(self):
        if len(self) > self.limit:
            self.empty()

    def __missing__(self, word):
        i = self[word] = len(self)
        self.new.append(word)
        return i

    def index(self, words) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def sums(self, texts: list) -> np.ndarray:
        """Sum of the rows of each text's words (texts: lists of words)."""
        at = np.concatenate([self.index(w) for w in texts] or [np.zeros(0, np.int64)])
        if self.new:
            while len(self) > len(self.matrix):
                self.matrix = np.concatenate([self.matrix, np.zeros_like(self.matrix)])
            self.matrix[len(self) - len(self.new) : len(self)] = self.rows(self.new)
            self.new = []
        ends = np.cumsum([len(w) for w in texts])
        out = np.zeros((len(texts), self.width))
        for c in range(self.width):
            total = np.concatenate([[0.0], np.cumsum(self.matrix[at, c], dtype=np.float64)])
            out[:, c] = np.diff(np.concatenate([[0.0], total[ends]])) if len(ends) else 0.0
        return out


def gram_buckets(words: list[bytes], sizes: tuple[int, ...], buckets: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of the byte n-grams (n up to 4) of many words at once, and
    the number of the word each belongs to. Words are marked ``<w>``."""
    marked = [b"<" + w + b">" for w in words]
    size = np.fromiter(map(len, marked), np.int64, len(marked))
    data = np.frombuffer(b"".join(marked) + b"\0" * 4, np.uint8).astype(np.uint64)
    total = int(size.sum())
    word = np.repeat(np.arange(len(marked)), size)
    left = np.repeat(np.cumsum(size), size) - np.arange(total)  # bytes up to the word's end
    flat, owner = [], []
    value = np.zeros(total, np.uint64)
    for n in range(1, max(sizes) + 1):
        value = value * np.uint64(256) + data[n - 1 : n - 1 + total]
        if n in sizes:
            ok = left >= n
            h = (value[ok] + np.uint64((n + 8 * seed) << 40)) * np.uint64(0x9E3779B97F4A7C15)
            flat.append((h >> np.uint64(40)).astype(np.int64) & (buckets - 1))
            owner.append(word[ok])
    return np.concatenate(flat), np.concatenate(owner)


def word_hash(words: list[bytes], buckets: int, seed: int) -> np.ndarray:
    return np.fromiter((zlib.crc32(w, seed) for w in words), np.int64, len(words)) & (buckets - 1)


def blocks(batch, n: int = 256):
    """Lists of at most ``n`` values of a pandas series."""
    for lo in range(0, len(batch), n):
        yield batch.iloc[lo : lo + n].tolist()


def arrow_blocks(batches: Iterator[pa.Array], n: int = 256) -> Iterator[list]:
    """Lists of at most ``n`` values of Arrow arrays: a batch of whole texts is
    never held a second time as Python strings."""
    for batch in batches:
        for lo in range(0, len(batch), n):
            yield batch.slice(lo, n).to_pylist()
