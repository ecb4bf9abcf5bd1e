"""Benchmark decontamination by latent semantic retrieval.

1. Document frequencies of hashed terms over the passages of all documents.
2. The TF-IDF rows of all different passages of all texts are added up, with
   signs, in ``SKETCH`` sums chosen by their hash. The sums stay in tasks, cut by
   block of terms; their leading directions come to the driver, and one more
   pass over all passages measures their products along these directions: a
   factor of RANK + OVERSAMPLE rows that stands for the whole corpus, whatever
   its size.
   For each block of benchmark items, a randomised SVD of a TF-IDF matrix, made
   by Spark: its rows are the block's items (weighted up, so that the latent
   space spans what they say) and that factor. Tasks return their part of
   X'(X Q), tasks sum the parts by block of terms, and the driver only
   orthogonalises a matrix of fixed size (9 MB, in float32).
3. Every passage (``WINDOW`` words, every ``STRIDE``) of every whole text is
   projected and compared by cosine with all items of the block. Projection is
   linear, so a text's vectors are summed once per stride and added up.
   Items of fewer than ``SHORT_WORDS`` words would be swamped by the words
   around them. They are sent as sets of terms instead: every stretch that
   holds enough of an item's terms is a candidate, so none is missed.
4. A candidate is verified on the words themselves: the longest common
   subsequence with the item, within a stretch of the text about twice the
   item's length, must hold ``MIN_LCS`` of the item's words; and
   ``MIN_ANSWER`` of the item's answer (its last sentence) must be found in
   order there, unless ``MIN_LCS`` of the item's words stand there in one run:
   a verbatim copy needs no answer. Items of few words must occur whole.

The items are the query set: they are sent to the tasks in blocks of about
``ITEMS`` at a time, whatever their number, and texts stay where they are. Texts
are hashed once: their terms (two bytes a word) are written beside them.

Defined cases: a null, empty or wordless text has no hit; items without a word
are left out; repeated items hit under each of their ids; an empty benchmark
hits nothing; an empty table gives no rows. Very long texts are searched whole,
4,096 words at a time. Repeated rows each get the hits of their text. Of
stretches with equal shares the first by the search counts; hits are ordered by
item id, null last.
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, release_since, written
from .common import LETTERS, arrow_blocks, letter_words
from .wordscan import blank_mask, text_blocks, word_hashes, word_places

TERMS = 1 << 14
RANK = 128
OVERSAMPLE = 8
POWER_STEPS = 2
#: Sums that all passages enter (by hash, with signs) to find the directions of
#: the corpus, and partitions in which they are made.
SKETCH = 512
SKETCH_PARTS = 64
#: All passages together weigh as much as this many: ones that are not repeated.
CORPUS_WEIGHT = 2_000
ITEM_WEIGHT = 3.0
ITEMS = 256
#: Blocks whose models a task holds at once (8 MB each, and up to 4 MB of sets).
BLOCKS_PER_PASS = 8
WINDOW, STRIDE = 32, 16
MIN_COSINE = 0.6
MIN_LCS = 0.6
MIN_ANSWER = 0.5
FEW_WORDS = 8
#: Items of fewer words are searched by their terms, without the latent space.
SHORT_WORDS = 16
TERM_PARTS = 32
#: Bytes of texts hashed at once, so that the temporary arrays stay small.
HASHED = 1 << 17


_SPACE = blank_mask(b" ")


def terms_of(texts: list[bytes]) -> Iterator[np.ndarray]:
    """Hashed terms (two bytes each) of the words of each text, in order; words
    are split by spaces. Many texts are hashed at once."""
    for _, _, data, offsets in text_blocks(pa.array(texts, pa.large_binary()), HASHED):
        start, end, first = word_places(data, offsets, _SPACE)
        x = (word_hashes(data, start, end) & np.uint64(TERMS - 1)).astype(np.uint16)
        for lo, hi in itertools.pairwise(first.tolist()):
            yield x[lo:hi]


def term_ids(words: list[bytes]) -> np.ndarray:
    return next(terms_of([b" ".join(words)]))


def letters(text: str | None) -> bytes:
    """A text's ``letter_words`` with spaces between."""
    return (text or "").lower().encode("utf-8", "replace").translate(LETTERS)


def text_terms(text: str | None) -> np.ndarray:
    """Hashed terms of a text's ``letter_words``."""
    return next(terms_of([letters(text)]))


def terms_column(text: Column) -> Column:
    """Hashed terms of whole texts as binary, two bytes a word."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for some in arrow_blocks(batches):
            yield pa.array([x.tobytes() for x in terms_of([letters(t) for t in some])], pa.binary())

    return F.arrow_udf(run, "binary")(text)


def read_terms(column: pa.Array) -> Iterator[np.ndarray]:
    """The arrays that ``terms_column`` made, without empty ones."""
    for t in column:
        if data := t.as_py():
            yield np.frombuffer(data, np.uint16)


def passage_table(texts: list[np.ndarray]) -> np.ndarray:
    """A row of terms for each passage (disjoint, of WINDOW words) of the
    texts; what is missing at a text's end is TERMS."""
    rows = [-(-len(x) // WINDOW) for x in texts]
    out = np.full(sum(rows) * WINDOW, TERMS, np.uint16)
    at = 0
    for x, n in zip(texts, rows, strict=True):
        out[at : at + len(x)] = x
        at += n * WINDOW
    return out.reshape(-1, WINDOW)


def document_frequencies(docs: DataFrame, text: str = "text", terms: str | None = None) -> tuple[np.ndarray, int]:
    """Passages that hold each term, and their number, over all documents
    (``terms``: the column of their ``terms_column``, if there is one). TERMS
    numbers come back to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(TERMS + 1, np.int64), 0
        for b in batches:
            texts = read_terms(b.column(0))
            while some := list(itertools.islice(texts, 256)):
                table = passage_table(some)
                table.sort(axis=1)
                new = np.ones(table.shape, bool)
                new[:, 1:] = table[:, 1:] != table[:, :-1]
                df += np.bincount(table[new], minlength=TERMS + 1)
                n += len(table)
        at = np.flatnonzero(df[:TERMS])
        yield pa.record_batch([pa.array(np.append(at, -1)), pa.array(np.append(df[at], n))], names=["term", "n"])

    x = docs.select(F.col(terms) if terms else terms_column(F.col(text)))
    rows = x.mapInArrow(count, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(TERMS, np.int64)
    total = 0
    for r in rows:
        if r["term"] < 0:
            total = r["n"]
        else:
            df[r["term"]] = r["n"]
    return df, total


def matrix_row(x: np.ndarray, idf: np.ndarray, weight: float) -> tuple[np.ndarray, np.ndarray]:
    v = np.bincount(x, minlength=TERMS) * idf
    at = np.flatnonzero(v)
    v = v[at]
    return at.astype(np.int32), (weight * v / max(1e-9, float(np.linalg.norm(v)))).astype(np.float32)


def different_passages(docs: DataFrame, text: str = "text", terms: str | None = None) -> DataFrame:
    """(slot, passage): every different passage of all texts once, as binary of
    WINDOW terms. A slot is one of SKETCH sums (slot // 2), and a sign."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 2 * WINDOW
        for b in batches:
            texts = read_terms(b.column(0))
            while some := list(itertools.islice(texts, 4096)):
                table = passage_table(some)
                ends = pa.py_buffer(np.arange(len(table) + 1, dtype=np.int64) * size)
                cells = pa.Array.from_buffers(pa.large_binary(), len(table), [None, ends, pa.py_buffer(table)])
                yield pa.record_batch([cells.unique().cast(pa.binary())], names=["passage"])

    x = docs.select(F.col(terms) if terms else terms_column(F.col(text))).mapInArrow(cut, "passage binary")
    h = F.xxhash64("passage")
    x = x.select((F.pmod(h, F.lit(SKETCH)) * 2 + F.when(h < 0, 1).otherwise(0)).cast("int").alias("slot"), "passage")
    return x.repartition(SKETCH_PARTS, "slot").dropDuplicates(["slot", "passage"])


def passage_values(column: pa.Array, idf: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, terms, length of the TF-IDF row) of some passages at a time;
    ``idf`` has a zero for TERMS."""
    for lo in range(0, len(column), 1024):
        part = column[lo : lo + 1024]
        table = np.frombuffer(b"".join(part.to_pylist()), np.uint16).reshape(len(part), WINDOW)
        in_order = np.sort(table, axis=1)
        new = np.ones(table.shape, bool)
        new[:, 1:] = in_order[:, 1:] != in_order[:, :-1]
        first = np.flatnonzero(new)
        count = np.diff(first, append=new.size)
        total = np.bincount(first // WINDOW, np.square(count * idf[in_order.ravel()[first]]), len(part))
        yield lo, table, np.maximum(1e-9, np.sqrt(total))


def matrix_rows(docs: DataFrame, items: list, idf: np.ndarray, weight: float, text: str = "text", terms: str | None = None) -> DataFrame:
    """Rows (at, value) of the TF-IDF matrix: items, and the different passages
    times ``weight``."""

    def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [np.frombuffer(x.as_py(), np.uint16) for x in b.column(0)]
            got = [matrix_row(x[x < TERMS], idf, weight) for x in got]
            yield pa.record_batch([pa.array([a for a, _ in got], pa.list_(pa.int32())),
                                   pa.array([v for _, v in got], pa.list_(pa.float32()))], names=["at", "value"])

    schema = "at array<int>, value array<float>"
    own = [matrix_row(term_ids(w), idf, ITEM_WEIGHT) for _, w, _ in items]
    first = docs.sparkSession.createDataFrame([(a.tolist(), v.tolist()) for a, v in own], schema)
    return first.union(different_passages(docs, text, terms).select("passage").mapInArrow(passages, schema))


def corpus_factor(passages: DataFrame, idf: np.ndarray) -> tuple[np.ndarray, int]:
    """(rows x TERMS matrix B, passages): B'B stands for X'X of the TF-IDF rows
    X of all ``different_passages``, exactly so along the rows of B."""
    idf = np.append(idf, 0.0)
    width = TERMS + 1

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}
        for b in batches:
            slots = b.column(0).to_numpy(zero_copy_only=False)
            for lo, table, size in passage_values(b.column(1), idf):
                own = slots[lo : lo + len(table)]
                found, at = np.unique(own // 2, return_inverse=True)
                value = idf[table] * ((1 - 2 * (own % 2)) / size)[:, None]
                cell = at[:, None] * width + table
                order = np.argsort(at, kind="stable")
                ends = np.searchsorted(at[order], np.arange(len(found) + 1))
                for k, slot in enumerate(found.tolist()):
                    rows = order[ends[k] : ends[k + 1]]
                    total = sums.setdefault(slot, np.zeros(width))
                    np.add.at(total, (cell[rows] - k * width).ravel(), value[rows].ravel())
        for slot, total in sums.items():
            cuts = np.split(total[:TERMS].astype(np.float32), TERM_PARTS)
            yield pa.record_batch([pa.array(range(TERM_PARTS), pa.int32()), pa.array([slot] * TERM_PARTS, pa.int32()),
                                   pa.array([x.tobytes() for x in cuts], pa.binary())], names=["part", "slot", "data"])

    def block(parts: pd.DataFrame) -> pd.DataFrame:
        out = np.zeros((SKETCH, TERMS // TERM_PARTS), np.float32)
        for slot, data in zip(parts["slot"], parts["data"], strict=True):
            out[slot] += np.frombuffer(data, np.float32)
        return pd.DataFrame({"part": [parts["part"].iloc[0]], "data": [out.tobytes()]})

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, n = np.zeros((SKETCH, SKETCH)), 0
        for b in batches:
            for data in b.column(0):
                x = np.frombuffer(data.as_py(), np.float32).reshape(SKETCH, -1).astype(np.float64)
                out += x @ x.T
                n += 1
        yield pa.record_batch([pa.array([n]), pa.array([out.tobytes()], pa.binary())], names=["n", "data"])

    def total(parts: pd.DataFrame) -> pd.DataFrame:
        out = sum(np.frombuffer(x, np.float64) for x in parts["data"])
        return pd.DataFrame({"n": [parts["n"].sum()], "data": [out.tobytes()]})

    schema, summed = "part int, data binary", "n bigint, data binary"
    cuts = passages.select("slot", "passage").mapInArrow(add, "part int, slot int, data binary")
    sketch = materialize(cuts.groupBy("part").applyInPandas(block, schema), "latent-sketch")
    row = sketch.select("data").mapInArrow(gram, summed).groupBy().applyInPandas(total, summed).first()
    if not row or not row["n"]:
        return np.zeros((0, TERMS), np.float32), 0
    value, vector = np.linalg.eigh(np.frombuffer(row["data"]).reshape(SKETCH, SKETCH))
    top = np.argsort(-value)[: RANK + OVERSAMPLE]
    top = top[value[top] > 1e-6 * value[top[0]]]
    leading = vector[:, top].astype(np.float32)

    def along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [np.frombuffer(x.as_py(), np.float32).reshape(SKETCH, -1).T @ leading for x in b.column(1)]
            yield pa.record_batch([b.column(0), pa.array([x.tobytes() for x in got], pa.binary())], names=["part", "data"])

    q = _orthonormal(_collected(sketch.mapInArrow(along, schema), len(top)))
    weighted = np.zeros((width, len(top)), np.float32)
    np.multiply(q, idf[:TERMS, None], out=weighted[:TERMS], casting="same_kind")
    sent = passages.sparkSession.sparkContext.broadcast(weighted)
    del weighted

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weighted = sent.value
        out, n = np.zeros((weighted.shape[1],) * 2), 0
        for b in batches:
            for _, table, size in passage_values(b.column(0), idf):
                y = np.concatenate([np.einsum("abc->ac", weighted.take(table[k : k + 128], axis=0)) for k in range(0, len(table), 128)])
                y /= size[:, None].astype(np.float32)
                out += y.T @ y
                n += len(table)
        yield pa.record_batch([pa.array([n]), pa.array([out.tobytes()], pa.binary())], names=["n", "data"])

    row = passages.select("passage").mapInArrow(products, summed).groupBy().applyInPandas(total, summed).first()
    sent.destroy()
    value, vector = np.linalg.eigh(np.frombuffer(row["data"]).reshape(len(top), -1))
    return (vector * np.sqrt(np.maximum(value, 0))).T.astype(np.float32) @ q.T, row["n"]


def _summed(parts: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(x, np.float32) for x in parts["data"])
    return pd.DataFrame({"part": [parts["part"].iloc[0]], "data": [total.tobytes()]})


def _collected(parts: DataFrame, width: int) -> np.ndarray:
    """The matrix (float32, ``width`` columns) whose blocks of rows are the
    ``data`` of ``parts``, in the order of ``part``."""
    got = sorted(parts.collect(), key=lambda r: r["part"], reverse=True)
    out = np.empty((sum(len(r["data"]) for r in got) // (4 * width), width), np.float32)
    at = 0
    while got:  # blocks go as they are copied
        x = np.frombuffer(got.pop()["data"], np.float32).reshape(-1, width)
        out[at : at + len(x)] = x
        at += len(x)
    return out


def _orthonormal(y: np.ndarray) -> np.ndarray:
    """Orthonormal columns (float32) that span those of ``y``: QR of blocks of
    rows, then of their triangles, so the whole is never held in float64."""
    n = max(1, len(y) // max(2048, y.shape[1]))
    cuts = [len(y) * k // n for k in range(n + 1)]
    out, triangles = np.empty((len(y), min(y.shape)), np.float32), []
    for lo, hi in itertools.pairwise(cuts):
        out[lo:hi], r = np.linalg.qr(y[lo:hi].astype(np.float64))
        triangles.append(r)
    small = np.split(np.linalg.qr(np.concatenate(triangles))[0].astype(np.float32), n)
    for (lo, hi), x in zip(itertools.pairwise(cuts), small, strict=True):
        out[lo:hi] = out[lo:hi] @ x
    return out


def _product(rows: DataFrame, q: np.ndarray, gram: bool) -> np.ndarray:
    """X'(X q) for a matrix X of few rows spread over tasks, or (X q)'(X q); q
    (float32) is what each task is sent. Executors drop it afterwards."""
    width = q.shape[1]
    sent = rows.sparkSession.sparkContext.broadcast(q)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = sent.value
        out = np.zeros((width, width) if gram else (TERMS, width), np.float32)
        for b in batches:
            for lo in range(0, b.num_rows, 64):
                some = b.slice(lo, 64)
                x = np.zeros((some.num_rows, TERMS), np.float32)
                for i, (at, value) in enumerate(zip(some.column(0), some.column(1), strict=True)):
                    x[i, at.values.to_numpy()] = value.values.to_numpy()
                y = x @ q
                out += (y if gram else x).T @ y
        n = 1 if gram else TERM_PARTS
        yield pa.record_batch([pa.array(range(n), pa.int32()), pa.array([x.tobytes() for x in np.split(out, n)], pa.binary())],
                              names=["part", "data"])

    schema = "part int, data binary"
    out = _collected(rows.mapInArrow(part, schema).groupBy("part").applyInPandas(_summed, schema), width)
    sent.destroy()
    return out


def factor_rows(spark: SparkSession, factor: np.ndarray) -> DataFrame:
    """Rows (at, value) of a dense matrix (float32) of few rows, made by tasks
    and written; executors drop the matrix afterwards."""
    sent = spark.sparkContext.broadcast(factor)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = sent.value[b.column(0).to_numpy()]
            yield pa.record_batch([pa.array([np.arange(TERMS, dtype=np.int32)] * len(own), pa.list_(pa.int32())),
                                   pa.array(list(own), pa.list_(pa.float32()))], names=["at", "value"])

    out = materialize(spark.range(len(factor), numPartitions=4).mapInArrow(rows, "at array<int>, value array<float>"), "latent-factor")
    sent.destroy()
    return out


def randomised_svd(rows: DataFrame, rank: int = RANK, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """(TERMS x rank right singular vectors in float32, singular values)."""
    q = np.random.default_rng(seed).normal(size=(TERMS, rank + OVERSAMPLE)).astype(np.float32)
    for _ in range(1 + POWER_STEPS):
        q = _orthonormal(_product(rows, q, False))
    value, vector = np.linalg.eigh(_product(rows, q, True).astype(np.float64))
    order = np.argsort(-value)[:rank]
    return q @ vector[:, order].astype(np.float32), np.sqrt(np.maximum(value[order], 0))


_SENTENCE = re.compile(r"[.!?]+\s+|\n+")


def prepare_item(item_id, text: str | None):
    """(id, words, answer words): the answer is the last sentence with words."""
    words = letter_words(text or "")
    parts = [p for p in map(letter_words, _SENTENCE.split(text or "")) if p]
    return item_id, words, parts[-1] if parts else []


def masks_of(words: list) -> dict:
    out: dict = {}
    for i, w in enumerate(words):
        out[w] = out.get(w, 0) | 1 << i
    return out


def lcs_length(masks: dict, size: int, words: list) -> int:
    """Longest common subsequence, one long integer step per common word."""
    full = (1 << size) - 1
    row = full
    for w in words:
        m = masks.get(w)
        if m:
            u = row & m
            row = (row + u | row - u) & full
    return size - row.bit_count()


def longest_run(item: list, words: list) -> int:
    """Most words in a row that both lists hold."""
    places: dict = {}
    for i, w in enumerate(item):
        places.setdefault(w, []).append(i)
    best, runs = 0, {}
    for w in words:
        runs = {i: runs.get(i - 1, 0) + 1 for i in places.get(w, ())}
        best = max(best, *runs.values()) if runs else best
    return best


def search_grid(n: int) -> tuple[int, int, int]:
    """For an item of n words: length of a stretch, words between the starts
    of two, and words of the item that a stretch must hold."""
    if n < FEW_WORDS:
        return n, 1, n
    return 2 * n, max(1, n // 2), math.ceil(MIN_LCS * n - 1e-9)


def verify(words: list, item, first: int, last: int) -> tuple[float, float, int] | None:
    """Best (share of the item, share of its answer, start) over stretches of
    twice the item's length in words[first:last], if both pass, or the first
    of a verbatim copy."""
    _, iw, masks, answer, answer_masks = item
    n = len(iw)
    span, step, _ = search_grid(n)
    need = 1.0 if n < FEW_WORDS else MIN_LCS
    best = None
    for lo in range(first, max(first + 1, last - span + step), step):
        part = words[lo : lo + span]
        share = lcs_length(masks, n, part) / n
        if share >= need and (best is None or share > best[0]):
            found = lcs_length(answer_masks, len(answer), part) / len(answer)
            if found >= MIN_ANSWER or longest_run(iw, part) >= max(FEW_WORDS, MIN_LCS * n):
                best = (share, found, lo)
    return best


def term_sets(items: list) -> tuple[np.ndarray, np.ndarray] | None:
    """(TERMS x items: whether a term is one of the item's; the least number
    of its distinct terms that a text with a hit holds) of short items."""
    if not items:
        return None
    has = np.zeros((TERMS, len(items)), bool)
    least = np.zeros(len(items), np.int64)
    for i, (_, words, *_) in enumerate(items):
        has[term_ids(words), i] = True
        least[i] = has[:, i].sum() - (len(words) - search_grid(len(words))[2])
    return has, least


def short_hits(text: str, x: np.ndarray, has: np.ndarray, least: np.ndarray, items: list) -> Iterator:
    """(item id, best of ``verify`` over the whole text) of the short items
    that the text holds: only stretches with enough of an item's terms are
    looked at, which leaves out none that passes."""
    words: list = []
    for i in np.flatnonzero(has[np.unique(x)].sum(0) >= least).tolist():
        span, step, need = search_grid(len(items[i][1]))
        held = np.concatenate([[0], np.cumsum(has[x, i])])
        starts = np.arange(0, max(1, len(x) - span + step), step)
        starts = starts[held[np.minimum(starts + span, len(x))] - held[np.minimum(starts, len(x))] >= need]
        best = None
        for lo in starts.tolist():
            words = words or letter_words(text)
            got = verify(words, items[i], lo, lo + 1)
            if got and (best is None or got[0] > best[0]):
                best = got
        if best:
            yield items[i][0], best


def stride_sums(rows: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Sum of the rows of every STRIDE terms, and of those left at the end."""
    out = []
    for lo in range(0, len(x), 4096):
        part = rows.take(x[lo : lo + 4096], axis=0)
        whole = len(part) // STRIDE * STRIDE
        out.append(np.einsum("abc->ac", part[:whole].reshape(-1, STRIDE, part.shape[1])))
        if whole < len(part):
            out.append(part[whole:].sum(0, keepdims=True))
    return np.concatenate(out)


HITS = "array<struct<item_id:bigint, lcs:double, answer:double, word:int>>"
_HITS = pa.list_(pa.struct({"item_id": pa.int64(), "lcs": pa.float64(), "answer": pa.float64(), "word": pa.int32()}))


def hits_column(text: Column, terms: Column, models: list) -> Column:
    """array of the items found in a whole text of which ``terms`` are the
    hashed terms. models: (projection TERMS x rank and unit item vectors, or
    None twice; items; ``term_sets`` of short items, or None; short items) per
    block."""

    def find(text: str, x: np.ndarray, model) -> list:
        proj, vectors, items, sets, short = model
        out = []
        if sets:
            out += [{"item_id": i, "lcs": b[0], "answer": b[1], "word": b[2]} for i, b in short_hits(text, x, *sets, short)]
        if proj is None:
            return out
        n = len(x)
        sums = stride_sums(proj, x)
        k = WINDOW // STRIDE
        last_start = max(1, len(sums) - k + 1)
        spots: dict = {}
        for lo in range(0, last_start, 1024):
            hi = min(last_start, lo + 1024)
            w = sums[lo:hi].copy()
            for j in range(1, k):
                more = sums[lo + j : hi + j]  # none for a text of less than a window
                w[: len(more)] += more
            norm = np.maximum(1e-9, np.linalg.norm(w, axis=1, keepdims=True))
            win, item = np.nonzero(w @ vectors.T >= MIN_COSINE * norm)
            for a, i in zip(win.tolist(), item.tolist(), strict=True):
                spots.setdefault(i, []).append((a + lo) * STRIDE)
        words = letter_words(text) if spots else []
        for i, starts in spots.items():
            m = len(items[i][1])
            best, first, last = None, None, None
            for s in [*starts, None]:
                # Stretches around neighbouring windows are searched as one.
                if s is not None and first is not None and s - m <= last:
                    last = min(n, s + WINDOW + m)
                    continue
                if first is not None:
                    got = verify(words, items[i], first, last)
                    if got and (best is None or got > best):
                        best = got
                if s is not None:
                    first, last = max(0, s - m), min(n, s + WINDOW + m)
            if best:
                out.append({"item_id": items[i][0], "lcs": best[0], "answer": best[1], "word": best[2]})
        return out

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for t, data in zip(*map(values, batch), strict=True):
                hits = []
                if data:
                    x = np.frombuffer(data, np.uint16)
                    for model in models:
                        hits += find(t, x, model)
                out.append(sorted(hits, key=lambda h: (h["item_id"] is None, h["item_id"] or 0)))
            yield pa.array(out, _HITS)

    def values(column: pa.Array) -> Iterator:
        return itertools.chain.from_iterable(arrow_blocks(iter([column])))

    return F.arrow_udf(run, HITS)(text, terms)


def fit_blocks(docs: DataFrame, benchmark: DataFrame, terms: str) -> Iterator:
    """A model per block of about ITEMS benchmark items; blocks are read and
    fitted one at a time, as they are asked for. The corpus enters each as its
    ``corpus_factor``, made once."""
    spark = docs.sparkSession
    bench = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").where("text is not null").distinct()
    n = bench.count()
    if not n:
        return
    parts = -(-n // ITEMS)
    df, passages = document_frequencies(docs, terms=terms)
    idf = np.log((passages + 1) / (df + 1)) + 1e-3
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    corpus = None
    for k in range(parts):
        items = [prepare_item(r["item_id"], r["text"]) for r in bench.where(block == k).orderBy("item_id", "text").collect()]
        ready = lambda some: [(i, w, masks_of(w), a, masks_of(a)) for i, w, a in some]
        short = ready(x for x in items if 0 < len(x[1]) < SHORT_WORDS)
        items = [x for x in items if len(x[1]) >= SHORT_WORDS]
        if not items:
            if short:
                yield None, None, [], term_sets(short), short
            continue
        if corpus is None:  # the passages are the same for every block
            mark = written(spark)
            factor, different = corpus_factor(materialize(different_passages(docs, terms=terms), "latent-passages"), idf)
            release_since(spark, mark)
            factor *= math.sqrt(min(1.0, CORPUS_WEIGHT / max(1, different)))
            corpus = factor_rows(spark, factor)
            del factor
        mark = written(spark)
        rows = materialize(matrix_rows(docs.limit(0), items, idf, 0.0, terms=terms).union(corpus).coalesce(4), "latent-rows")
        v, _ = randomised_svd(rows)
        proj = v * idf[:, None].astype(np.float32)
        del v
        vectors = np.stack([proj[term_ids(w)].sum(0) for _, w, _ in items])
        vectors /= np.maximum(1e-9, np.linalg.norm(vectors, axis=1, keepdims=True))
        release_since(spark, mark)
        yield proj, vectors, ready(items), term_sets(short), short


def _free(name: str, taken: list[str]) -> str:
    while name in taken:
        name += "_"
    return name


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", out: str = "hits") -> DataFrame:
    """``docs`` with ``out`` (replaced where it exists): the benchmark items whose
    words the text repeats, with the shares found and the word they start at.
    Texts are hashed once and written beside their terms; what a group of
    blocks finds is written by row number, without texts."""
    spark = docs.sparkSession
    mark = written(spark)
    docs = docs.drop(out)
    columns = [*docs.columns, out]
    terms, row = _free("__terms", columns), _free("__row", columns)
    docs = docs.withColumn(terms, terms_column(F.col(text)))
    docs = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "latent-terms")
    none = F.array().cast(HITS)
    groups = fit_blocks(docs, benchmark, terms)
    # The driver holds the models of one group: they are applied before the
    # next group is fitted.
    found = None
    while models := list(itertools.islice(groups, BLOCKS_PER_PASS)):
        hits = hits_column(F.col(text), F.col(terms), models)
        if found is None and len(models) < BLOCKS_PER_PASS:  # one group: no join
            release_since(spark, mark, keep=("latent-terms",))
            return docs.withColumn(out, hits).select(*columns)
        part = materialize(docs.select(row, hits.alias(out)).where(F.size(out) > 0), "latent-hits")
        found = part if found is None else found.union(part)
    release_since(spark, mark, keep=("latent-terms", "latent-hits"))
    if found is None:
        return docs.withColumn(out, none).select(*columns)
    # At most one hit for each item.
    order = F.transform(F.flatten(F.collect_list(out)), lambda h: F.struct(h["item_id"].isNull().alias("last"), h.alias("hit")))
    found = found.groupBy(F.col(row).alias("__found")).agg(F.transform(F.array_sort(order), lambda h: h["hit"]).alias(out))
    joined = docs.join(found, F.col(row) == F.col("__found"), "left")
    return joined.withColumn(out, F.coalesce(F.col(out), none)).select(*columns)


def q_op1(spark, sf):
    """Every row of ``documents`` against every item of ``benchmark``."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    d = contamination(docs, spark.read.parquet(f"{sf}/benchmark.parquet"))
    return d.select("doc_id", (F.size("hits") > 0).alias("contaminated"), F.col("hits.item_id").alias("item_ids"),
                    F.coalesce(F.array_max("hits.lcs"), F.lit(0.0)).alias("best_lcs"))


def decontamination_stage(spark, docs, sf_dir):
    """Pipeline stage: documents that repeat a benchmark item go; the columns
    stay."""
    d = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), out="__hits")
    return d.where(F.size("__hits") == 0).drop("__hits")
