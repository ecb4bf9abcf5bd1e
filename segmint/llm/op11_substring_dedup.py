"""Substring dedup by De Bruijn compaction.

A window of ``WINDOW`` consecutive words is an edge from its first WINDOW - 1
words to its last WINDOW - 1. A word is removed if some window over it also
starts in a document with a smaller id; windows are judged on the input.

0. Copies. Rows of equal texts (by SHA-256) collapse to the one with the least
   id before anything else; the others lose every window, and with it every
   word of a text of WINDOW words or more. Large groups of copies end here.
1. Anchors. Each window is served by the least hash among its runs of
   ``ANCHOR`` words, so equal windows have equal anchors, and neighbouring
   windows mostly share one. Anchors (one for about four windows) are counted
   with the least and largest document, map-side combined; windows whose
   anchor stays within one document cannot repeat and go no further.
2. Edges. The windows left, as pairs of node hashes, keep their first place
   (least document, text, position): the source. Edges of one document go.
3. Compaction. Edges that follow each other in their source through a node
   with one edge in and one out are joined into paths.
4. Spans. Windows of other documents, joined with their edges, fall into runs
   along one path: a span with the coordinates of its source.
5. Verification. The words of each span and of its source are read from the
   texts and compared by digest. What differs (a collision of 64-bit hashes)
   is judged window by window on digests of its words.

Every joined table is written to the shared folder, so that AQE may split the
key of a passage that very many documents share; no task holds more of a group
than one document's windows.

Defined cases: a null or empty text has no words; a null id comes after all
others, as the largest bigint would; rows that repeat an id remove nothing
from each other; very long texts are cut whole; an empty table gives no rows.
Other columns stay; the name of the new column must be free.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, release_since, written
from .wordscan import BLANKS, blank_mask, run_hashes, text_blocks, word_hashes, word_places

WINDOW = 13
ANCHOR = 7
LAST = (1 << 63) - 1


def _words(data, offsets, blank, bits: int) -> tuple[np.ndarray, np.ndarray]:
    start, end, first = word_places(data, offsets, blank)
    hashes = word_hashes(data, start, end)
    return (hashes if bits == 64 else hashes & np.uint64((1 << bits) - 1)), first


def anchor_runs(words: np.ndarray, first: np.ndarray, window: int = WINDOW, anchor: int = ANCHOR):
    """Runs of neighbouring windows with one anchor: number of their text, of
    their first word, how many windows, and the anchor."""
    n = len(words) - window + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    whole = owner[:n] == owner[window - 1 :]
    runs = run_hashes(words, anchor)
    least, at = runs[:n].copy(), np.arange(n)
    for k in range(1, window - anchor + 1):
        lower = runs[k : k + n] < least
        least[lower] = runs[k : k + n][lower]
        at[lower] = np.flatnonzero(lower) + k
    begins = whole.copy()
    begins[1:] &= ~(whole[:-1] & (at[1:] == at[:-1]))
    start = np.flatnonzero(begins)
    count = np.bincount((np.cumsum(begins) - 1)[whole], minlength=len(start))
    return owner[start], start, count, least[start]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _anchors(window: int, anchor: int, bits: int, places: bool):
    """Anchors of texts: (a, doc), or (a, doc, th, run) with ``places``, where
    run is 16 times the first window's position and the number of windows."""
    blank = blank_mask(BLANKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, offsets in text_blocks(b["text"]):
                words, first = _words(data, offsets, blank, bits)
                owner, start, count, a = anchor_runs(words, first, window, anchor)
                at = pa.array(owner)
                cols = {"a": _signed(a), "doc": b["doc"][lo:hi].take(at)}
                if places:
                    cols |= {"th": b["th"][lo:hi].take(at), "run": pa.array((start - first[owner]) * 16 + count)}
                yield pa.RecordBatch.from_pydict(cols)

    return run


def _stretches(window: int, bits: int):
    """Maximal runs of wanted windows: (doc, th, pos, nodes)."""
    blank = blank_mask(BLANKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, offsets in text_blocks(b["text"]):
                words, first = _words(data, offsets, blank, bits)
                nodes = run_hashes(words, window - 1)
                lists = b["runs"][lo:hi]
                owner = np.repeat(np.arange(hi - lo), np.diff(lists.offsets.to_numpy()))
                runs = lists.flatten().to_numpy()
                cover = np.zeros(len(words) + 2, np.int64)
                np.add.at(cover, first[owner] + runs // 16, 1)
                np.add.at(cover, first[owner] + runs // 16 + runs % 16, -1)
                edge = np.diff(np.concatenate([[0], (np.cumsum(cover) > 0).astype(np.int8)]))
                start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                size = end - start + 1
                ends = np.cumsum(size)
                flat = np.repeat(start - (ends - size), size) + np.arange(int(size.sum()))
                text = np.searchsorted(first, start, "right") - 1
                # An empty text shares its first word's number with the next one.
                at = pa.array(text)
                yield pa.RecordBatch.from_pydict({
                    "doc": b["doc"][lo:hi].take(at), "th": b["th"][lo:hi].take(at), "pos": pa.array(start - first[text]),
                    "nodes": pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), _signed(nodes[flat]))})

    return run


def _digests(window: int, single: bool):
    """Digest of the words of each wanted span: (doc, th, pos, n, words). With
    ``single`` one row for each of its windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(b.num_rows):
                words = b["text"][row].as_py().split()
                out = []
                for s in b["spans"][row].as_py():
                    p, n = s["pos"], s["n"]
                    for q, m in ((p + k, 1) for k in range(n)) if single else ((p, n),):
                        out.append((q, m, hashlib.blake2b(b" ".join(words[q : q + m + window - 1]), digest_size=16).digest()))
                at = pa.array(np.zeros(len(out), np.int64))
                pos, n, digest = zip(*out, strict=True)
                yield pa.RecordBatch.from_pydict({
                    "doc": b["doc"][row : row + 1].take(at), "th": b["th"][row : row + 1].take(at),
                    "pos": pa.array(pos, pa.int64()), "n": pa.array(n, pa.int64()), "words": pa.array(digest, pa.binary())})

    return run


def compact_paths(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v, sd, st, sp: nodes and source) with the position ``ps``
    at which the edge's path begins in its source."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("o"), F.lit(0).alias("i")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    through = ends.groupBy("x").agg(F.sum("o").alias("o"), F.sum("i").alias("i")).where("o = 1 and i = 1").select("x")
    through = materialize(through, "sub-nodes")
    w = Window.partitionBy("sd", "st").orderBy("sp")
    follows = F.col("x").isNotNull() & (F.lag("sp").over(w) == F.col("sp") - 1) & (F.lag("v").over(w) == F.col("u"))
    begins = F.when(F.coalesce(follows, F.lit(False)), F.lit(None)).otherwise(F.col("sp"))
    linked = edges.join(through, F.col("u") == F.col("x"), "left").withColumn("begins", begins)
    return linked.withColumn("ps", F.last("begins", ignorenulls=True).over(w)).select("u", "v", "sd", "st", "sp", "ps")


def _spans_of(texts: DataFrame, asked: DataFrame, window: int, single: bool, name: str) -> DataFrame:
    """Digests of the spans ``asked`` (doc, th, pos, n)."""
    lists = asked.distinct().groupBy("doc", "th").agg(F.collect_list(F.struct("pos", "n")).alias("spans"))
    lists = materialize(lists.withColumnsRenamed({"doc": "ld", "th": "lt"}), name + "-asked")
    d = texts.join(lists, (F.col("doc") == F.col("ld")) & (F.col("th") == F.col("lt"))).select("doc", "th", "text", "spans")
    return d.mapInArrow(_digests(window, single), "doc bigint, th bigint, pos bigint, n bigint, words binary").distinct()


def repeated_spans(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW,
                   anchor: int = ANCHOR, bits: int = 64) -> DataFrame:
    """Spans (doc, th, pos, n): n windows from word ``pos`` on that also start
    in a document with a smaller id, n null for all of a text that does. doc
    is the id (null: the largest bigint), th the hash of the text. ``bits`` of
    the word hashes, fewer for tests."""
    key = F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST))
    digest = F.unhex(F.sha2(F.col(text).cast("binary"), 256))
    rows = docs.where(F.col(text).isNotNull()).select(
        key.alias("doc"), F.xxhash64(text).alias("th"), digest.alias("digest"), F.col(text).cast("binary").alias("text"))
    texts = rows.groupBy("digest").agg(F.min("doc").alias("doc"), F.any_value("th").alias("th"), F.any_value("text").alias("text"))
    texts = materialize(texts, "sub-texts")
    first = texts.select(F.col("digest").alias("fd"), F.col("doc").alias("lo"))
    copies = rows.select("doc", "th", "digest").join(first, (F.col("digest") == F.col("fd")) & (F.col("lo") < F.col("doc")))
    copies = materialize(copies.select("doc", "th").distinct(), "sub-copies")
    copies = copies.select("doc", "th", F.lit(0).cast("long").alias("pos"), F.lit(None).cast("long").alias("n"))

    found = texts.select("doc", "text").mapInArrow(_anchors(window, anchor, bits, False), "a bigint, doc bigint")
    shared = found.groupBy("a").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).where("lo < hi")
    shared = materialize(shared.select(F.col("a").alias("sa")), "sub-anchors")

    placed = texts.select("doc", "th", "text").mapInArrow(_anchors(window, anchor, bits, True), "a bigint, doc bigint, th bigint, run bigint")
    placed = placed.join(shared, F.col("a") == F.col("sa"), "left_semi")
    lists = materialize(placed.groupBy("doc", "th").agg(F.collect_list("run").alias("runs")), "sub-runs")
    wanted = texts.join(lists, ["doc", "th"]).select("doc", "th", "text", "runs")
    stretches = materialize(wanted.mapInArrow(_stretches(window, bits), "doc bigint, th bigint, pos bigint, nodes array<bigint>"),
                            "sub-stretches")

    n = F.size("nodes") - 1
    pairs = F.arrays_zip(F.slice("nodes", F.lit(1), n).alias("u"), F.slice("nodes", F.lit(2), n).alias("v"))
    windows = stretches.select("doc", "th", "pos", F.posexplode(pairs).alias("k", "e")).select(
        F.col("e.u").alias("u"), F.col("e.v").alias("v"), "doc", "th", (F.col("pos") + F.col("k")).alias("pos"))
    edges = windows.groupBy("u", "v").agg(F.min(F.struct("doc", "th", "pos")).alias("s"), F.max("doc").alias("hi"))
    edges = materialize(edges.where("s.doc < hi").select(
        "u", "v", F.col("s.doc").alias("sd"), F.col("s.th").alias("st"), F.col("s.pos").alias("sp")), "sub-edges")
    paths = materialize(compact_paths(edges).withColumnsRenamed({"u": "pu", "v": "pv"}), "sub-paths")

    on = (F.col("u") == F.col("pu")) & (F.col("v") == F.col("pv")) & (F.col("sd") < F.col("doc"))
    hits = windows.join(paths, on).select("doc", "th", "pos", "sd", "st", "sp", "ps")
    w = Window.partitionBy("doc", "th").orderBy("pos")
    goes_on = F.lit(True)
    for c, step in (("pos", 1), ("sd", 0), ("st", 0), ("ps", 0), ("sp", 1)):
        goes_on = goes_on & (F.lag(c).over(w) == F.col(c) - step)
    hits = hits.withColumn("new", F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1))
    spans = hits.withColumn("g", F.sum("new").over(w)).groupBy("doc", "th", "g").agg(
        F.min("pos").alias("pos"), F.count("*").alias("n"), F.min("sd").alias("sd"), F.min("st").alias("st"), F.min("sp").alias("sp"))
    spans = materialize(spans.drop("g"), "sub-spans")

    asked = spans.select("doc", "th", "pos", "n").union(spans.select("sd", "st", "sp", "n"))
    digests = materialize(_spans_of(texts, asked, window, False, "sub"), "sub-digests")
    own = digests.select(*[F.col(c).alias("o_" + c) for c in digests.columns])
    other = digests.select(*[F.col(c).alias("s_" + c) for c in digests.columns])
    same = spans.join(own, (F.col("doc") == F.col("o_doc")) & (F.col("th") == F.col("o_th")) & (F.col("pos") == F.col("o_pos"))
                      & (F.col("n") == F.col("o_n")))
    same = same.join(other, (F.col("sd") == F.col("s_doc")) & (F.col("st") == F.col("s_th")) & (F.col("sp") == F.col("s_pos"))
                     & (F.col("n") == F.col("s_n")))
    judged = materialize(same.select("doc", "th", "pos", "n", (F.col("o_words") == F.col("s_words")).alias("same")), "sub-judged")
    good, bad = judged.where("same").drop("same"), judged.where("not same").drop("same")
    if not bad.isEmpty():
        good = good.union(_by_words(texts, windows, bad, window))
    return good.union(copies)


def _by_words(texts: DataFrame, windows: DataFrame, bad: DataFrame, window: int) -> DataFrame:
    """Those windows of the spans ``bad`` that repeat by their words: compared
    with all windows of equal hashes."""
    place = bad.select("doc", "th", F.explode(F.sequence(F.col("pos"), F.col("pos") + F.col("n") - 1)).alias("pos"))
    place = materialize(place.withColumnsRenamed({"doc": "bd", "th": "bt", "pos": "bp"}), "sub-bad")
    hashes = windows.join(place, (F.col("doc") == F.col("bd")) & (F.col("th") == F.col("bt")) & (F.col("pos") == F.col("bp")))
    hashes = materialize(hashes.select(F.col("u").alias("bu"), F.col("v").alias("bv")).distinct(), "sub-bad-edges")
    alike = windows.join(hashes, (F.col("u") == F.col("bu")) & (F.col("v") == F.col("bv")), "left_semi")
    asked = alike.select("doc", "th", "pos", F.lit(1).cast("long").alias("n"))
    exact = materialize(_spans_of(texts, asked, window, True, "sub-bad"), "sub-bad-words")
    first = exact.groupBy(F.col("words").alias("fw")).agg(F.min("doc").alias("lo"))
    first = materialize(first, "sub-bad-first")
    repeats = exact.join(first, F.col("words") == F.col("fw")).where("lo < doc").select("doc", "th", "pos", "n")
    return repeats.join(place, (F.col("doc") == F.col("bd")) & (F.col("th") == F.col("bt")) & (F.col("pos") == F.col("bp")),
                        "left_semi")


def kept_column(text: Column, spans: Column, window: int = WINDOW) -> Column:
    """Struct (n_words, n_removed, kept) of a text without the words that the
    spans' windows cover; kept words are joined by one space."""

    def one(data: bytes | None, cuts: list | None) -> tuple[int, int, bytes]:
        words = (data or b"").split()
        if not cuts:
            return len(words), 0, b" ".join(words)
        if cuts[0]["n"] is None:
            return (len(words), len(words), b"") if len(words) >= window else (len(words), 0, b" ".join(words))
        keep = np.ones(len(words), bool)
        for s in cuts:
            keep[s["pos"] : s["pos"] + s["n"] + window - 1] = False
        left = [words[k] for k in np.flatnonzero(keep).tolist()]
        return len(words), len(words) - len(left), b" ".join(left)

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, lists in batches:
            for lo in range(0, max(1, len(texts)), 256):
                got = [one(t, c) for t, c in zip(texts[lo : lo + 256].to_pylist(), lists[lo : lo + 256].to_pylist(), strict=True)]
                cols = list(zip(*got, strict=True)) if got else [()] * 3
                yield pa.StructArray.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                                                  pa.array(cols[2], pa.binary()).cast(pa.string())],
                                                 names=["n_words", "n_removed", "kept"])

    return F.arrow_udf(run, "n_words bigint, n_removed bigint, kept string")(text.cast("binary"), spans)


def dedup_substrings(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", out: str = "substrings",
                     window: int = WINDOW, anchor: int = ANCHOR, bits: int = 64) -> DataFrame:
    """Adds struct ``out``: number of words, of removed words, and the kept
    words joined by a space."""
    if out in docs.columns:
        raise ValueError(f"column {out} exists")
    mark = written(docs.sparkSession)
    found = repeated_spans(docs, text, doc_id, window, anchor, bits)
    lists = found.groupBy(F.col("doc").alias("__sub_doc"), F.col("th").alias("__sub_th")).agg(
        F.collect_list(F.struct("pos", "n")).alias("__sub_spans"))
    lists = materialize(lists, "sub-removed")
    release_since(docs.sparkSession, mark, keep=("sub-removed",))
    d = docs.withColumns({"__sub_key": F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)), "__sub_hash": F.xxhash64(text)})
    d = d.join(lists, (F.col("__sub_key") == F.col("__sub_doc")) & (F.col("__sub_hash") == F.col("__sub_th")), "left")
    return d.withColumn(out, kept_column(F.col(text), F.col("__sub_spans"), window)).select(*docs.columns, out)


def q_op11(spark, sf):
    """Every row of ``documents``: how many words it has and loses, and the
    digest of those it keeps."""
    d = dedup_substrings(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"))
    return d.select("doc_id", F.col("substrings.n_words").alias("n_words"), F.col("substrings.n_removed").alias("n_removed"),
                    F.sha2(F.col("substrings.kept").cast("binary"), 256).alias("kept_sha256"))


SQL_OP11 = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(doc_id, 9223372036854775807) AS k,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT rid, k, ws, unnest(range(1, len(ws) - 11)) AS i FROM d WHERE len(ws) >= 13),
w AS (SELECT rid, k, i, array_to_string(ws[i:i + 12], ' ') AS g FROM p),
f AS (SELECT g, min(k) AS lo FROM w GROUP BY g HAVING min(k) < max(k)),
h AS (SELECT DISTINCT rid, unnest(range(i, i + 13)) AS q FROM w JOIN f USING (g) WHERE lo < k),
c AS (SELECT rid, list(q) AS qs FROM h GROUP BY rid),
o AS (SELECT rid, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS q FROM d),
t AS (SELECT o.rid, string_agg(word, ' ' ORDER BY o.q) AS kept
      FROM o LEFT JOIN h ON o.rid = h.rid AND o.q = h.q WHERE h.rid IS NULL GROUP BY o.rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(qs), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN c ON d.rid = c.rid LEFT JOIN t ON d.rid = t.rid
"""
