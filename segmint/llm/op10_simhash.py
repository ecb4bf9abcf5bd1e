"""SimHash near-duplicates by Golay-code fuzzy hashing.

Fingerprint: 64 bits of the majority over the XXH64 (seed 42) of the text's
4-word shingles. Two fingerprints link when at most 4 bits differ.

Search: the bits fall into segments A and B of 23 and C of 18. The binary
Golay code (23,12) is perfect: every 23-bit word lies within 3 bits of one
codeword. A segment is decoded to the indices (12 bits) of all codewords within
4 bits: one, or six when its own codeword is 3 bits off. Two segments that
differ in at most 2 bits always share one of these indices. By the pigeonhole
principle over how the 4 errors (a, b, c) fall on the segments, any linked pair
shares one of these keys (G: codeword index, A0 and A1, B0 and B1, C0 and C1:
exact halves):

- a, b <= 2 and c <= 1: (GA, GB, C0) or (GA, GB, C1)
- c >= 2, so a + b <= 2: (A, GB), (GA, B), or with a = b = 1 some (Ai, Bj)
- a >= 3, so b + c <= 1: (B, C0), (B, C1) or (GB, C)
- b >= 3, so a + c <= 1: (A, C0), (A, C1) or (GA, C)

Only distinct fingerprints get keys. Rows of a key are compared in the task
that holds it; a key with more than ``BLOCK`` fingerprints is dealt out as
pairs of blocks, so no task holds an unbounded group. A task returns a spanning
star of each connected part of a group, never all its pairs. Components are
then found by Spark joins.

Defined cases: a null text, or one without words, has fingerprint zero and is
linked like any other; fewer than 4 words make one shingle; repeated rows and
ids share a component; a component all of whose ids are null has a null id. A
bit set in exactly half of the shingles is 0; very long texts are read whole; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, release_since, written
from .common import arrow_blocks
from .components import connected_components

WORDS = 4
SEED = 42
MAX_BITS = 4
#: Fingerprints of one key that a task compares with as many others at once.
BLOCK = 2048
#: Fixed value: generator polynomial of the binary Golay code (23,12).
GENERATOR = 0b110001110101


def fingerprint(text: str | None) -> int:
    """Unsigned 64-bit fingerprint of a whole text."""
    import xxhash

    words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: A-Z only, ASCII blanks only
    n = len(words)
    if not n:
        return 0
    if n < WORDS:
        shingles = iter((b" ".join(words),))
        n = 1
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(WORDS))))
        n = n - WORDS + 1
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(s, SEED) for s in shingles), np.uint64, n)
    for lo in range(0, n, 1 << 16):
        part = h[lo : lo + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprint_column(text: Column) -> Column:
    """Fingerprints as signed 64-bit numbers of the same bits."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for block in arrow_blocks(batches):
            yield pa.array(np.array([fingerprint(t) for t in block], np.uint64).view(np.int64))

    return F.arrow_udf(run, "bigint")(text)


def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """Parity bits of the 4096 messages, and for each of the 2048 syndromes the
    error patterns of weight 4 or less (6 columns; -1 where there is none)."""
    parity = np.zeros(4096, np.int64)
    for m in range(4096):
        r = m << 11
        for bit in range(22, 10, -1):
            if r >> bit & 1:
                r ^= GENERATOR << (bit - 11)
        parity[m] = r
    patterns = np.full((2048, 6), -1, np.int64)
    filled = np.zeros(2048, np.int64)
    for weight in range(5):
        for bits in combinations(range(23), weight):
            e = sum(1 << b for b in bits)
            s = (e & 0x7FF) ^ parity[e >> 11]
            # Weight 4 only beside a leader of weight 3: others have none.
            patterns[s, filled[s]] = e
            filled[s] += 1
    return parity, patterns


def codewords(x: np.ndarray, tables) -> np.ndarray:
    """n x 6 indices of the codewords within 4 bits of 23-bit words; -1: none."""
    parity, patterns = tables
    p = patterns[(x & 0x7FF) ^ parity[x >> 11]]
    return np.where(p >= 0, (x[:, None] ^ p) >> 11, -1)


def keys_of(fp: np.ndarray, tables) -> tuple[np.ndarray, np.ndarray]:
    """(key, row number) of uint64 fingerprints: up to 104 keys each. A key's
    lowest 4 bits tell its kind."""
    f = fp.astype(np.uint64)
    seg = lambda lo, n: ((f >> np.uint64(lo)) & np.uint64((1 << n) - 1)).astype(np.int64)
    a, b, c = seg(0, 23), seg(23, 23), seg(46, 18)
    c_half = (seg(46, 9), seg(55, 9))
    ga, gb = codewords(a, tables), codewords(b, tables)
    rows = np.arange(len(f))
    keys, owner = [], []

    def add(kind: int, value: np.ndarray, ok: np.ndarray | None = None):
        keys.append((value if ok is None else value[ok]) * 16 + kind)
        owner.append(rows if ok is None else rows[ok])

    for i in range(6):
        for j in range(6):
            ok = (ga[:, i] >= 0) & (gb[:, j] >= 0)
            pair = ga[:, i] << 12 | gb[:, j]
            for h in (0, 1):
                add(h, pair << 9 | c_half[h], ok)
        add(2, a << 12 | gb[:, i], gb[:, i] >= 0)
        add(3, b << 12 | ga[:, i], ga[:, i] >= 0)
        add(4, c << 12 | gb[:, i], gb[:, i] >= 0)
        add(5, c << 12 | ga[:, i], ga[:, i] >= 0)
    a_half, b_half = (a & 0xFFF, a >> 12), (b & 0xFFF, b >> 12)
    for i in (0, 1):
        for j in (0, 1):
            add(6 + 2 * i + j, a_half[i] << 12 | b_half[j])
        add(10 + i, b << 9 | c_half[i])
        add(12 + i, a << 9 | c_half[i])
    return np.concatenate(keys), np.concatenate(owner)


def _settle(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest number connected to each of 0 .. n-1 by the pairs."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _dense(fp: np.ndarray) -> np.ndarray:
    """As _settle, for one group: each number is compared once with those not
    yet reached, in blocks, so memory stays at 64 rows of the group."""
    label = np.full(len(fp), -1)
    left = np.arange(len(fp))
    while len(left):
        seed, left = left[0], left[1:]
        label[seed] = seed
        front = np.array([seed])
        while len(front) and len(left):
            block, front = front[:64], front[64:]
            near = (np.bitwise_count(fp[block][:, None] ^ fp[left][None, :]) <= MAX_BITS).any(0)
            label[left[near]] = seed
            front = np.concatenate([front, left[near]])
            left = left[~near]
    return label


def group_links(group: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spanning stars (member, centre) of the linked fingerprints in each run
    of equal ``group`` numbers."""
    n = len(fp)
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    sizes = np.diff(np.concatenate([starts, [n]]))
    label = np.arange(n)
    size_of = np.repeat(sizes, sizes)
    small = np.flatnonzero((size_of > 1) & (size_of <= 64))
    lefts, rights = [], []
    g, f = group[small], fp[small]
    for d in range(1, int(size_of[small].max(initial=0))):
        same = g[d:] == g[:-d]
        if not same.any():
            break
        at = np.flatnonzero(same)
        at = at[np.bitwise_count(f[at] ^ f[at + d]) <= MAX_BITS]
        lefts.append(small[at])
        rights.append(small[at + d])
    if lefts:
        left, right = np.concatenate(lefts), np.concatenate(rights)
        if len(left):
            label = _settle(n, left, right)
    for s, k in zip(starts[sizes > 64], sizes[sizes > 64], strict=True):
        label[s : s + k] = s + _dense(fp[s : s + k])
    member = np.flatnonzero(label != np.arange(n))
    return fp[member], fp[label[member]]


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tables = golay_tables()
    for b in batches:
        fp = b.column(0).to_numpy(zero_copy_only=False)
        for lo in range(0, len(fp), 4096):
            part = fp[lo : lo + 4096]
            k, row = keys_of(part.view(np.uint64), tables)
            yield pa.record_batch([pa.array(k), pa.array(part[row])], names=["k", "fp"])


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (g, fp) come sorted by group; a group that spans batches is carried
    over. Groups are bounded by BLOCK, so the carried rows are too."""
    held_g, held_f = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def links(g, f):
        m, c = group_links(g, f.view(np.uint64))
        return pa.record_batch([pa.array(m.view(np.int64)), pa.array(c.view(np.int64))], names=["x", "y"])

    for b in batches:
        if not b.num_rows:
            continue
        g = np.concatenate([held_g, b.column(0).to_numpy(zero_copy_only=False)])
        f = np.concatenate([held_f, b.column(1).to_numpy(zero_copy_only=False)])
        cut = int(np.searchsorted(g, g[-1], side="left"))
        if cut:
            yield links(g[:cut], f[:cut])
        held_g, held_f = g[cut:], f[cut:]
    if len(held_g):
        yield links(held_g, held_f)


def similar_links(distinct: DataFrame) -> DataFrame:
    """Edges (x, y) that connect exactly the fingerprints (column fp, distinct)
    that are connected by links of at most ``MAX_BITS`` bits."""
    keyed = distinct.select("fp").mapInArrow(_keyed, "k bigint, fp bigint")
    # Keys with more than BLOCK fingerprints: few, and counted with map-side sums.
    hot = materialize(keyed.groupBy("k").count().where(F.col("count") > BLOCK).select(
        "k", F.ceil(F.col("count") / BLOCK).cast("int").alias("parts")), "simhash-hot")
    if hot.isEmpty():
        grouped = keyed.select(F.col("k").alias("g"), "fp")
    else:
        # Row of block i goes to the pairs (i, j) and (j, i) of blocks, under a
        # number of their own; negative, so that it meets no other key.
        own = F.pmod(F.xxhash64("fp"), F.col("parts"))
        other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
        split = keyed.join(hot, "k").select("k", "fp", own.alias("i"), other.alias("j"))
        split = split.select(F.xxhash64("k", F.least("i", "j"), F.greatest("i", "j")).alias("h"), "fp")
        split = split.select(F.col("h").bitwiseOR(F.lit(-(1 << 63)).cast("long")).alias("g"), "fp")
        grouped = keyed.join(hot, "k", "left_anti").select(F.col("k").alias("g"), "fp").union(split)
    return grouped.repartition("g").sortWithinPartitions("g", "fp").mapInArrow(_compared, "x bigint, y bigint")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(rows, classes): rows doc_id, fp of every document; classes fp, root
    (smallest fingerprint connected), component_id (smallest id connected)."""
    spark = docs.sparkSession
    mark = written(spark)
    rows = materialize(docs.select(F.col(doc_id).alias("doc_id"), fingerprint_column(F.col(text)).alias("fp")), "simhash-rows")
    distinct = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    found = materialize(connected_components(similar_links(distinct)), "simhash-components")
    rooted = materialize(distinct.join(found, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")), "simhash-rooted")
    ids = materialize(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "simhash-ids")
    classes = materialize(rooted.join(ids, "root").select("fp", "root", "component_id"), "simhash-classes")
    release_since(spark, mark, keep=("simhash-rows", "simhash-classes"))
    return rows, classes


def q_op10(spark, sf):
    """Every row of ``documents`` with its fingerprint and component."""
    rows, classes = near_duplicates(spark.read.parquet(f"{sf}/documents.parquet"))
    return rows.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def simhash_stage(spark, docs, sf_dir):
    """Pipeline stage: of each component the document with the smallest id
    stays (one row of it, where an id is repeated); the columns stay."""
    rows, classes = near_duplicates(docs)
    placed = rows.join(classes, "fp")
    keep = materialize(placed.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("_id")).distinct(),
                       "simhash-keep")
    again = materialize(rows.groupBy("doc_id").count().where("count > 1 or doc_id is null").select(
        F.col("doc_id").alias("_id")), "simhash-again")
    out = docs.join(keep, docs["doc_id"] == keep["_id"], "left_semi")
    if again.isEmpty():
        return out
    # Rows of repeated or null ids: by their own fingerprint, one a component.
    same = docs["doc_id"].eqNullSafe(again["_id"])
    more = docs.join(again, same, "left_semi").withColumn("__simhash_fp", fingerprint_column(F.col("text")))
    c = classes.select(F.col("fp").alias("__simhash_of"), F.col("root").alias("__simhash_root"), F.col("component_id").alias("__simhash_id"))
    more = more.join(c, F.col("__simhash_fp") == F.col("__simhash_of")).where(F.col("doc_id").eqNullSafe(F.col("__simhash_id")))
    more = more.dropDuplicates(["__simhash_root"]).select(*docs.columns)
    return out.join(again, docs["doc_id"].eqNullSafe(again["_id"]), "left_anti").union(more)
