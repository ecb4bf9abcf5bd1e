"""Phrase collocation mining by direct-address tiling.

Words are counted by Spark. The frequent ones (at least ``MIN_COUNT``; no other
word is part of a candidate) are ranked by frequency, and the ranks serve as
addresses: a task turns its texts into ranks, and the pairs of neighbouring
ranks into cells of a matrix that is split into tiles of 2^TILE_BITS rows and
columns. Tiles that hold many of a buffer's pairs are counted with a dense
``numpy.bincount``, the others as sorted coordinates. Spark sums the cells of
all tasks. The pairs that are frequent are ranked again, and the next pass
counts the tiles of (ranked pair, word), and so on up to ``MAX_WORDS`` words.
A phrase can only be frequent if both its parts without the last and without
the first word are, so other places are not counted.

Bounds: a level's ranked table holds at most ``HEAD`` phrases, whatever the
input's size. Frequent phrases beyond it are counted as lists of word hashes
in the same pass: a bit filter of fixed size, made by Spark, tells which places
may hold one. The filter only saves rows; sums and the limit decide, so results
do not depend on HEAD or on the filter.

Word hashes have 64 bits. Two words of a language with equal hashes are found
when words are counted and lead to another seed, so a list of hashes stands
for one phrase, and table look-ups compare all words.

Scores are exact: products are decimals of up to 38 digits. Of a phrase's cuts
the lowest floored score counts (ties: the shortest first part). Candidates
inside a longer one that is as frequent are dropped.

Defined cases: a null text counts as empty; a null lang is ``und``; rows that
repeat count each; very long texts are read whole; equal scores and counts
are ordered by phrase; an empty table, or one without a frequent phrase, gives
no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, release_since, written
from .wordscan import blank_mask, mixed, run_hashes, text_blocks, word_hashes, word_places

MIN_COUNT = 100
MAX_WORDS = 5
TOP = 2000
#: Parts of a language that are ranked by themselves first.
PARTS = 64
#: Ranked phrases of a level (8 bytes a word and phrase, sent to every worker).
HEAD = 1 << 18
ID_BITS = 20
TILE_BITS = 9
#: Pairs that are counted at a time, and how many make a tile dense.
BUFFER = 1 << 22
DENSE = 1 << (2 * TILE_BITS - 2)
FILTER_BITS = 1 << 25
FILTER_HASHES = 4
#: Bytes of text read at a time.
BLOCK = 8 << 20

BREAKS = b".,;:!?\n\v\f\r"


@dataclass
class Reader:
    """Reads blocks of texts as word hashes. Tests lower ``bits``."""
    seed: int = 0
    bits: int = 64
    lower: np.ndarray = field(default_factory=lambda: np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8))
    blank: np.ndarray = field(default_factory=lambda: blank_mask(BREAKS + b" \t"))
    breaks: np.ndarray = field(default_factory=lambda: blank_mask(BREAKS))

    def read(self, batch: pa.RecordBatch):
        """For each block: bytes, starts and ends of words, hashes, the hash
        of each word's language, its piece, and the languages."""
        for lo, hi, data, offsets in text_blocks(batch["text"], BLOCK):
            data = self.lower[data]
            start, end, first = word_places(data, offsets, self.blank)
            owner = np.repeat(np.arange(hi - lo), np.diff(first))
            codes = batch["lang"][lo:hi].dictionary_encode()
            names = codes.dictionary.to_pylist()
            salts = np.array([lang_hash(x) for x in names], np.int64).view(np.uint64)
            lang = salts[codes.indices.to_numpy(zero_copy_only=False)[owner]] if names else np.zeros(0, np.uint64)
            piece = np.concatenate([[0], np.cumsum(self.breaks[data])])[start] + owner
            yield data, start, end, self.hashes(data, start, end), lang, piece, names

    def hashes(self, data, start, end):
        h = word_hashes(data, start, end, self.seed)
        return h if self.bits == 64 else h & np.uint64((1 << self.bits) - 1)


def lang_hash(name: str) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "little", signed=True)


def phrase_hashes(lang: np.ndarray, words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the language and ``size`` words from each place on."""
    runs = run_hashes(words, size)
    return mixed(runs + lang[: len(runs)] * np.uint64(0x9FB21C651E98DF25))


def filter_bits(hashes: np.ndarray) -> list[np.ndarray]:
    """Numbers of the filter's bits of each hash."""
    return [(mixed(hashes + np.uint64(k)) & np.uint64(FILTER_BITS - 1)).astype(np.int64) for k in range(1, FILTER_HASHES + 1)]


@dataclass
class Level:
    """The frequent phrases of one size: the ranked ones by rank as columns
    (language, words), and the filter of the others (None: there are none)."""
    size: int
    columns: np.ndarray
    filter: np.ndarray | None

    def __post_init__(self):
        h = phrase_hashes(self.columns[0], self.columns[1], 1) if self.size == 1 else self._hashes()
        order = np.argsort(h, kind="stable")
        h = h[order]
        again = np.zeros(len(h), bool)
        again[1:] = h[1:] == h[:-1]  # equal hashes: the first is ranked, the others go to the filter
        if again.any():
            self.filter = np.zeros(FILTER_BITS >> 6, np.uint64) if self.filter is None else self.filter
            for b in filter_bits(h[again]):
                np.bitwise_or.at(self.filter, b >> 6, np.uint64(1) << (b & 63).astype(np.uint64))
        self.hash, self.rank = h[~again], order[~again]

    def _hashes(self) -> np.ndarray:
        n = self.columns.shape[1]
        return phrase_hashes(np.repeat(self.columns[0], self.size), self.columns[1:].T.reshape(-1), self.size)[:: self.size][:n]

    def states(self, lang: np.ndarray, words: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Of the phrases at the places ``at``: rank, -2 if the filter lets
        them through, else -1."""
        h = phrase_hashes(lang, words, self.size)[at]
        out = np.full(len(at), -1, np.int64)
        if len(self.hash):
            k = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
            same = self.hash[k] == h
            rank = self.rank[k]
            for c in range(self.size + 1):
                same &= (lang[at] if c == 0 else words[at + c - 1]) == self.columns[c][rank]
            out[same] = rank[same]
        if self.filter is not None:
            left = np.flatnonzero(out == -1)
            through = np.ones(len(left), bool)
            for b in filter_bits(h[left]):
                through &= (self.filter[b >> 6] >> (b & 63).astype(np.uint64)) & np.uint64(1) == 1
            out[left[through]] = -2
        return out


def count_tiles(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct cells x * 2^ID_BITS + y and their counts."""
    tile = ((x >> TILE_BITS) << ID_BITS) | (y >> TILE_BITS)
    order = np.argsort(tile, kind="stable")
    x, y, tile = x[order], y[order], tile[order]
    edge = np.flatnonzero(np.append(True, tile[1:] != tile[:-1])) if len(tile) else np.zeros(0, np.int64)
    size = np.diff(np.append(edge, len(tile)))
    keys, counts, sparse = [], [], np.ones(len(tile), bool)
    low = (1 << TILE_BITS) - 1
    for a, n in zip(edge[size >= DENSE].tolist(), size[size >= DENSE].tolist(), strict=True):
        sparse[a : a + n] = False
        c = np.bincount(((x[a : a + n] & low) << TILE_BITS) | (y[a : a + n] & low), minlength=1 << 2 * TILE_BITS)
        cell = np.flatnonzero(c)
        keys.append((((x[a] & ~low) + (cell >> TILE_BITS)) << ID_BITS) | ((y[a] & ~low) + (cell & low)))
        counts.append(c[cell])
    coo = np.sort((x[sparse] << ID_BITS) | y[sparse])
    edge = np.flatnonzero(np.append(True, coo[1:] != coo[:-1])) if len(coo) else np.zeros(0, np.int64)
    keys.append(coo[edge])
    counts.append(np.diff(np.append(edge, len(coo))))
    return np.concatenate(keys), np.concatenate(counts)


def _word_counts(reader: Reader):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, start, end, words, lang, _, names in reader.read(batch):
                other = word_hashes(data, start, end, reader.seed + 101)
                key = mixed(words + mixed(other) + lang * np.uint64(3))
                _, at, count = np.unique(key, return_index=True, return_counts=True)
                by_salt = {lang_hash(x): x for x in names}
                raw = data.tobytes()
                out = [raw[a:b] for a, b in zip(start[at].tolist(), end[at].tolist(), strict=True)]
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([by_salt[s] for s in lang[at].view(np.int64).tolist()], pa.string()),
                    "word": pa.array(out, pa.binary()).cast(pa.string()),
                    "h": pa.array(words[at].view(np.int64)), "c": pa.array(count)})

    return run


def _salted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        names = b["lang"].to_pylist()
        yield pa.RecordBatch.from_pydict({"sl": pa.array(names, pa.string()), "salt": pa.array(map(lang_hash, names), pa.int64())})


def _pair_counts(reader: Reader, levels: list[Level]):
    """Counts of phrases of one word more than the last level's: (key, null,
    c) for cells of two ranks, (null, words, c) for others."""
    size = len(levels) + 1

    def flush(x: list, y: list) -> pa.RecordBatch:
        key, count = count_tiles(np.concatenate(x), np.concatenate(y))
        return pa.RecordBatch.from_pydict({
            "key": pa.array(key), "words": pa.nulls(len(key), pa.list_(pa.int64())), "c": pa.array(count)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, y, held = [], [], 0
        for batch in batches:
            for _, _, _, words, lang, piece, _ in reader.read(batch):
                n = len(words)
                single = levels[0].states(lang, words, np.arange(n))
                state = single
                for level in levels[1:] + [None]:
                    k = level.size if level else size
                    here = max(0, n - k + 1)
                    at = np.flatnonzero((state[:here] != -1) & (state[1 : here + 1] != -1) & (piece[:here] == piece[k - 1 : k - 1 + here]))
                    if level:
                        state = np.full(n, -1, np.int64)
                        state[at] = level.states(lang, words, at)
                left, right = state[at], single[at + size - 1]
                ranked = (left >= 0) & (right >= 0)
                x.append(left[ranked])
                y.append(right[ranked])
                held += int(ranked.sum())
                at = at[~ranked]
                if len(at):
                    flat = np.concatenate([lang[at, None], words[at[:, None] + np.arange(size)]], axis=1).reshape(-1)
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * (size + 1), pa.int32()), pa.array(flat.view(np.int64)))
                    yield pa.RecordBatch.from_pydict({"key": pa.nulls(len(at), pa.int64()), "words": lists, "c": pa.array(np.ones(len(at), np.int64))})
                if held >= BUFFER:
                    yield flush(x, y)
                    x, y, held = [], [], 0
        if held:
            yield flush(x, y)

    return run


def _spelled(levels: list[Level]):
    """Cells of ranks as lists of word hashes."""
    size = len(levels) + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key = b["key"].to_numpy()
            x, y = key >> ID_BITS, key & ((1 << ID_BITS) - 1)
            flat = np.concatenate([levels[-1].columns[:, x], levels[0].columns[1:, y]]).T.reshape(-1)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(key) + 1) * size, pa.int32()), pa.array(flat.view(np.int64)))
            yield pa.RecordBatch.from_pydict({"words": lists, "f": b["f"]})

    return run


def _filter_words(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat = b["words"].flatten().to_numpy().view(np.uint64).reshape(b.num_rows, size + 1)
            h = phrase_hashes(np.repeat(flat[:, 0], size), flat[:, 1:].reshape(-1), size)[::size]
            bit = np.concatenate(filter_bits(h))
            yield pa.RecordBatch.from_pydict({"w": pa.array(bit >> 6), "b": pa.array((np.uint64(1) << (bit & 63).astype(np.uint64)).view(np.int64))})

    return run


def ranked(phrases: DataFrame, size: int, head: int = HEAD) -> Level:
    """The level of ``phrases`` (words, f). Counts are grouped by powers of
    2^(1/16), at most 1,024 groups; whole groups from the top are ranked while
    they fit, the others make the filter: at most FILTER_BITS / 64 rows."""
    p = phrases.withColumn("g", F.floor(F.log2("f") * 16))
    groups, cut, held = sorted(p.groupBy("g").count().collect(), key=lambda r: -r["g"]), None, 0
    for r in groups:
        held += r["count"]
        if held > head:
            cut = r["g"]
            break
    top, bits = p if cut is None else p.where(F.col("g") > cut), None
    if cut is not None:
        rest = p.where(F.col("g") <= cut).select("words").mapInArrow(_filter_words(size), "w bigint, b bigint")
        got = rest.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
        bits = np.zeros(FILTER_BITS >> 6, np.uint64)
        bits[got["w"].to_numpy()] = got["b"].to_numpy().view(np.uint64)
    got = top.select("words", "f").toArrow()
    flat = got["words"].combine_chunks().flatten().to_numpy().view(np.uint64).reshape(got.num_rows, size + 1)
    order = np.lexsort((*flat.T[::-1], -got["f"].to_numpy()))
    return Level(size, np.ascontiguousarray(flat[order].T), bits)


def _counted_words(docs: DataFrame, bits: int) -> tuple[Reader, DataFrame]:
    """All words (lang, word, h, f) under the first seed whose hashes are
    distinct within each language."""
    for seed in range(16):
        reader = Reader(seed, bits)
        words = docs.mapInArrow(_word_counts(reader), "lang string, word string, h bigint, c bigint")
        words = materialize(words.groupBy("lang", "word", "h").agg(F.sum("c").alias("f")), "phrase-words")
        if words.groupBy("lang", "h").count().where("count > 1").isEmpty():
            return reader, words
    raise ValueError("words with equal hashes under every seed")


def frequent_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT,
                     max_words: int = MAX_WORDS, head: int = HEAD, bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """Phrases (lang, words, phrase, size, f) of 1 to ``max_words`` words found
    at least ``min_count`` times, and the number of words of each language
    (lang, n). words holds the hashes of the language and the words."""
    if head > 1 << ID_BITS:
        raise ValueError(f"head is at most {1 << ID_BITS}")
    docs = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).cast("binary").alias("text"))
    reader, words = _counted_words(docs, bits)
    totals = materialize(words.groupBy("lang").agg(F.sum("f").alias("n")), "phrase-totals")
    salts = materialize(totals.select("lang").mapInArrow(_salted, "sl string, salt bigint"), "phrase-langs")
    common = words.where(F.col("f") >= min_count)
    single = common.join(salts, F.col("lang") == F.col("sl")).select(
        "lang", F.array("salt", "h").alias("words"), F.col("word").alias("phrase"), F.lit(1).alias("size"), "f")
    single = materialize(single, "phrase-single")
    levels, named = [ranked(single, 1, head)], [single]
    for size in range(2, max_words + 1):
        raw = docs.mapInArrow(_pair_counts(reader, levels), "key bigint, words array<bigint>, c bigint")
        cells = raw.groupBy("key", "words").agg(F.sum("c").alias("f")).where(F.col("f") >= min_count)
        cells = materialize(cells, "phrase-cells")
        spelled = cells.where("key is not null").select("key", "f").mapInArrow(_spelled(levels), "words array<bigint>, f bigint")
        found = materialize(spelled.union(cells.where("key is null").select("words", "f")), "phrase-found")
        if found.isEmpty():
            break
        before = named[-1].select(F.col("words").alias("bw"), "lang", F.col("phrase").alias("bp"))
        last = single.select(F.col("words").alias("lw"), F.col("phrase").alias("lp"))
        ends = F.array(F.element_at("words", 1), F.element_at("words", -1))
        text_of = found.join(before, F.slice("words", 1, size) == F.col("bw")).join(last, ends == F.col("lw"))
        named.append(materialize(text_of.select("lang", "words", F.concat_ws(" ", "bp", "lp").alias("phrase"), F.lit(size).alias("size"), "f"),
                                 "phrase-named"))
        if size < max_words:
            levels.append(ranked(named[-1], size, head))
    out = named[0]
    for n in named[1:]:
        out = out.union(n)
    return out, totals


def scored(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """Candidates (lang, words, phrase, size, a, l, r, n, score)."""
    p = materialize(phrases, "phrase-all")
    parts = p.select(F.col("words").alias("pw"), F.col("f").alias("pf"))
    c = p.where("size > 1").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    c = c.withColumn("rest", F.concat(F.slice("words", 1, 1), F.slice("words", F.col("k") + 2, F.col("size") - F.col("k"))))
    c = c.join(parts, F.slice("words", F.lit(1), F.col("k") + 1) == F.col("pw")).withColumnRenamed("pf", "l").drop("pw")
    c = c.join(parts, F.col("rest") == F.col("pw")).withColumnRenamed("pf", "r").drop("pw", "rest")
    c = c.join(totals, "lang")
    d = {x: F.col(x).cast("decimal(18,0)") for x in ("l", "r", "n")}
    thousand = (F.col("f") * 1000).cast("decimal(18,0)")
    c = c.withColumns({"up": thousand * d["n"], "down": d["l"] * d["r"]}).withColumn("score", F.expr("up div down"))
    best = c.groupBy("words").agg(F.min(F.struct("score", "k", "l", "r", "lang", "phrase", "size", "f", "n")).alias("b"))
    return best.select("words", "b.lang", "b.phrase", "b.size", F.col("b.f").alias("a"), "b.l", "b.r", "b.n", "b.score")


def outer_only(candidates: DataFrame) -> DataFrame:
    """Without the candidates that lie inside a longer one with
    100 * f(longer) >= 100 * a."""
    c = candidates.select("words", "size", "a")
    part = c.where("size > 2").withColumn("m", F.explode(F.sequence(F.lit(2), F.col("size") - 1))).withColumn(
        "s", F.explode(F.sequence(F.lit(2), F.col("size") - F.col("m") + 2)))
    part = part.select(F.concat(F.slice("words", 1, 1), F.slice("words", F.col("s"), F.col("m"))).alias("iw"), "a")
    inner = materialize(part.groupBy("iw").agg(F.max("a").alias("ia")), "phrase-inner")
    over = (F.col("words") == F.col("iw")) & (F.col("ia") * 100 >= F.col("a") * 100)
    return candidates.join(inner, over, "left_anti")


def mine_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT,
                 max_words: int = MAX_WORDS, top: int = TOP, head: int = HEAD, bits: int = 64) -> DataFrame:
    """Each language's first ``top`` phrases by score, count and phrase: lang,
    rank, phrase, a, l, r, n, score."""
    mark = written(docs.sparkSession)
    phrases, totals = frequent_phrases(docs, text, lang, min_count, max_words, head, bits)
    c = materialize(scored(phrases, totals), "phrase-scored")
    order = (F.desc("score"), F.desc("a"), "phrase")
    # A language's first ones are among the first of its parts, so the last
    # ranking gets PARTS * top rows of a language at most.
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).orderBy(*order)
    best = outer_only(c).withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top)
    w = Window.partitionBy("lang").orderBy(*order)
    best = best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
    out = materialize(best.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"), "phrase-top")
    release_since(docs.sparkSession, mark, keep=("phrase-top",))
    return out


def q_op13(spark, sf):
    """Phrases of all rows of ``documents``."""
    return mine_phrases(spark.read.parquet(f"{sf}/documents.parquet").select("lang", "text"))


SQL_OP13 = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS x FROM d),
w AS (SELECT lang, regexp_extract_all(x, '[^\x20\x09]+') AS ws FROM p),
g AS (SELECT lang, ws, len(ws) AS m, unnest(range(1, len(ws) + 1)) AS i FROM w WHERE len(ws) > 0),
q AS (SELECT lang, ws, m, i, unnest(range(1, least(5, m - i + 1) + 1)) AS z FROM g),
f AS (SELECT lang, ws[i:i + z - 1] AS ph, z, CAST(count(*) AS BIGINT) AS f FROM q GROUP BY ALL HAVING count(*) >= 100),
n AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
k AS (SELECT lang, ph, z, f AS a, unnest(range(1, z)) AS k FROM f WHERE z > 1),
s AS (
  SELECT k.lang, k.ph, k.z, a, k, l.f AS l, r.f AS r, n, CAST((1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM k JOIN n ON k.lang = n.lang JOIN f AS l ON l.lang = k.lang AND l.ph = k.ph[1:k]
  JOIN f AS r ON r.lang = k.lang AND r.ph = k.ph[k + 1:k.z]),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, ph ORDER BY score, k) = 1),
u AS (SELECT lang, ph, a, z, unnest(range(2, z)) AS m FROM b WHERE z > 2),
v AS (SELECT lang, ph, a, m, unnest(range(1, z - m + 2)) AS i FROM u),
o AS (SELECT lang, ph[i:i + m - 1] AS ph, max(a) AS top FROM v GROUP BY ALL),
c AS (SELECT b.* FROM b LEFT JOIN o ON b.lang = o.lang AND b.ph = o.ph WHERE top IS NULL OR 100 * top < 100 * a),
t AS (SELECT *, array_to_string(ph, ' ') AS phrase FROM c),
x AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM t)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, n, score FROM x WHERE rank <= 2000
"""
