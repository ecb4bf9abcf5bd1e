"""Personal data by bootstrapped contextual extraction.

Base patterns find emails, IP addresses, card and phone numbers (card numbers
must pass Luhn, and so on). These are the first seeds. A seed induces lexical
patterns of its kind: its context, with case and digits flattened, that is the
two words before it and the word after it, and backed off the one word before
or the one after. Every identifier-like string outside the base spans (a token
around an @, or a run of digits and separators, plausible for the kind) is an
instance of the patterns that its own contexts match. Spark counts
pattern-instance pairs and scores the bipartite graph iteratively: a pattern's
confidence is the support-weighted share of trusted instances among all it
extracts (seeds count 1, others their own confidence, shrunk by ``PRIOR``
doubtful ones), an instance's confidence the best of its patterns'. Instances
that reach ``MIN_CONFIDENCE`` are seeds of the next round, so the contexts in
which they stand elsewhere become patterns too. A pattern needs ``MIN_SEEDS``
different seeds; a backed-off one ``BACKED_SEEDS``, in two full contexts at
least, else it says no more than the full one. Patterns of MIN_CONFIDENCE after
the last round add the tokens they extract as spans of their kind, the fullest
context first; base spans always stay, and added spans never overlap them. A
word of a context counts by the ``NEAREST`` characters next to the identifier.

Positions are code points, ends exclusive. Defined cases: a null text counts
as empty; repeated rows are searched alike and count once as evidence for each
text; without patterns only base spans are returned; an empty table gives no
rows; very long texts are searched whole in linear time, and identifiers of any
length count whole; of kinds with equal support in a context the more confident
one is taken, then the first by name.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, release_since, written

KINDS = ("email", "ip", "card", "phone")
MIN_SEEDS = 5
#: Different seeds of a backed-off pattern.
BACKED_SEEDS = 20
#: Characters of a context word that count: those next to the identifier.
NEAREST = 40
MIN_CONFIDENCE = 0.8
PRIOR = 1.0
ROUNDS = 3
#: Patterns that may be sent to the tasks; more are joined to the candidates.
BROADCAST_PATTERNS = 50_000

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match that starts inside a run of digits would start at the run's head, so
# the look-behind changes no match and keeps the search linear.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# What may be an identifier that the base patterns miss: a token around an @,
# or digits with the separators of numbers.
_MAYBE = re.compile(r"[0-9](?:[0-9().:/\x20-]*[0-9])?|@")
_EDGES = ".,;:!?()[]{}<>\"'*#$%&|"


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d)
        if i % 2:
            v = 2 * v - 9 if v > 4 else 2 * v
        total += v
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches, from each @: the local part is the
    run of its characters before it, back to the end of the last match."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((start, m.end()))
            last = m.end()
            at = text.find("@", last)
        else:
            # No later match can use what lies before this @.
            last = at + 1
            at = text.find("@", last)
    return out


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns, by start, then kind as listed."""
    if not text:
        return []
    found = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(map(str.isdigit, m[0])) <= 15:
                found.append(("phone", *m.span()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


_WORD, _DIGITS = re.compile(r"\S+"), re.compile(r"[0-9]+")


def flat(word: str) -> str:
    """A context word: lower case, digits as 0, edge punctuation off but for a
    colon or an equals sign."""
    w = word.strip(".,;!?()[]{}<>\"'*#$%&|").lower()
    return _DIGITS.sub("0", w)


def plausible(kind: str, s: str) -> bool:
    """Whether a string may be an unseen identifier of the kind."""
    if kind == "email":
        return "@" in s[1:-1]
    digits = sum(map(str.isdigit, s))
    if "@" in s:
        return False
    return s.count(".") >= 3 if kind == "ip" else 12 <= digits <= 19 if kind == "card" else 7 <= digits <= 15


class Contexts:
    """Contexts of places in one text."""

    def __init__(self, text: str):
        self.text = text
        self.starts, self.ends = [], []
        for m in _WORD.finditer(text):
            self.starts.append(m.start())
            self.ends.append(m.end())

    def of(self, start: int, end: int) -> tuple[str, str | None, str | None]:
        """The two words before and the word after, flattened; the last word
        before; the word after. The latter are null if there is none."""
        text, k = self.text, bisect_left(self.starts, start)
        before = []
        for i in range(max(0, k - 2), k):
            stop = min(self.ends[i], start)
            before.append(flat(text[max(self.starts[i], stop - NEAREST) : stop]))
        after, k = "", bisect_right(self.ends, end)
        if k < len(self.ends):
            first = max(self.starts[k], end)
            after = flat(text[first : min(self.ends[k], first + NEAREST)])
        full = " ".join(before) + " _ " + after
        return full, before[-1] + " _" if before and before[-1] else None, "_ " + after if after else None


def candidates(text: str, base: list[tuple[str, int, int]]) -> Iterator[tuple[int, int]]:
    """Identifier-like strings outside the base spans."""
    k, last = 0, 0
    for m in _MAYBE.finditer(text):
        a, b = m.span()
        if a < last:  # inside the last one: its ends are not sought again
            continue
        if m[0] == "@":
            while a > last and not text[a - 1].isspace():
                a -= 1
            while b < len(text) and not text[b].isspace():
                b += 1
            while a < b and text[a] in _EDGES:
                a += 1
            while b > a and text[b - 1] in _EDGES:
                b -= 1
        elif b - a < 7:
            continue
        last = b
        while k < len(base) and base[k][2] <= a:
            k += 1
        if b - a >= 5 and not any(s < b and a < e for _, s, e in base[k : k + 4]):
            yield a, b


def _evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(full context, word before, word after, kind or '', surface) of seeds
    and candidates in the texts."""
    for batch in batches:
        rows: set = set()
        for t in batch.column(0):
            text = t.as_py()
            if not text:
                continue
            base = base_spans(text)
            found = [*base, *(("", a, b) for a, b in candidates(text, base))]
            if found:
                at = Contexts(text)
                for kind, a, b in found:
                    rows.add((*at.of(a, b), kind, text[a:b]))
        cols = zip(*rows, strict=True) if rows else ((),) * 5
        yield pa.record_batch([pa.array(c, pa.string()) for c in cols], names=["full", "one", "after", "kind", "surface"])


def pattern_table(docs: DataFrame, text: str = "text") -> DataFrame:
    """Written table (context, kind, p) of all patterns that pass both limits,
    one kind a context: the better supported."""
    mark = written(docs.sparkSession)
    try:
        return _learn(docs, text)
    finally:
        release_since(docs.sparkSession, mark, keep=("pii-chosen",))


def learn_patterns(docs: DataFrame, text: str = "text") -> list[tuple[str, str, float]]:
    """The rows of ``pattern_table``, on the driver."""
    return [(r["context"], r["kind"], r["p"]) for r in pattern_table(docs, text).collect()]


def _learn(docs: DataFrame, text: str) -> DataFrame:
    pairs = materialize(docs.select(F.col(text).alias("text")).mapInArrow(
        _evidence, "full string, one string, after string, kind string, surface string"), "pii-pairs")
    own = pairs.select(F.explode(F.array_compact(F.array("full", "one", "after"))).alias("context"), "full", "surface",
                       F.col("kind").alias("own"))
    seeds = own.where("own != ''").select("context", "full", F.col("own").alias("kind"), "surface")
    digits = F.length(F.regexp_replace("surface", "[^0-9]", ""))
    fits = (F.when(F.col("own") != "", True).when(F.col("kind") == "email", F.col("surface").contains("@"))
            .when(F.col("surface").contains("@"), False)
            .when(F.col("kind") == "ip", F.size(F.split("surface", "[.]")) >= 4)
            .when(F.col("kind") == "card", digits.between(12, 19)).otherwise(digits.between(7, 15)))
    inst = None
    for left in range(ROUNDS, -1, -1):
        # Patterns: contexts with enough different seeds of one kind. Their
        # edges go to every instance of the context.
        known = seeds
        if inst is not None:
            trusted = inst.where(F.col("c") >= MIN_CONFIDENCE).select("surface", "kind")
            known = seeds.union(own.where("own = ''").join(trusted, "surface").select("context", "full", "kind", "surface"))
        enough = F.when(F.col("low") == F.col("context"), F.col("seeds") >= MIN_SEEDS).otherwise(
            (F.col("low") != F.col("high")) & (F.col("seeds") >= BACKED_SEEDS))
        pattern = known.groupBy("context", "kind", "surface").agg(F.min("full").alias("low"), F.max("full").alias("high"))
        pattern = pattern.groupBy("context", "kind").agg(
            F.count("*").alias("seeds"), F.min("low").alias("low"), F.max("high").alias("high")).where(enough)
        pattern = materialize(pattern.select("context", "kind", "seeds"), "pii-patterns")
        if pattern.isEmpty():
            return docs.sparkSession.createDataFrame([], "context string, kind string, p double")
        edges = own.select("context", "surface", "own").distinct().join(pattern, "context").where(fits)
        edges = materialize(edges.select("context", "kind", "surface", "own"), "pii-edges")
        scored = edges.withColumn("c", F.lit(None).cast("double")) if inst is None else edges.join(inst, ["surface", "kind"], "left")
        trust = F.when(F.col("own") == F.col("kind"), 1.0).when(F.col("own") == "", F.coalesce("c", F.lit(0.0))).otherwise(0.0)
        score = scored.groupBy("context", "kind").agg((F.sum(trust) / (F.count("*") + PRIOR)).alias("p"))
        score = materialize(score, "pii-score")
        if left:
            inst = edges.where("own = ''").join(score, ["context", "kind"]).groupBy("surface", "kind").agg(F.max("p").alias("c"))
            inst = materialize(inst, "pii-instances")
    best = score.where(F.col("p") >= MIN_CONFIDENCE).join(pattern, ["context", "kind"])
    order = F.struct((-F.col("seeds")).alias("seeds"), (-F.col("p")).alias("doubt"), "kind", "p")
    first = best.groupBy("context").agg(F.min(order).alias("o"))
    return materialize(first.select("context", "o.kind", "o.p"), "pii-chosen")


def _candidate_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text's key, contexts, start, end, kinds it may be) of the candidates."""
    for batch in batches:
        rows = []
        for key, t in zip(batch.column(0), batch.column(1), strict=True):
            text, at = t.as_py(), None
            for a, b in candidates(text, base_spans(text)) if text else ():
                kinds = [k for k in KINDS if plausible(k, text[a:b])]
                if kinds:
                    at = at or Contexts(text)
                    rows.append((key.as_py(), list(at.of(a, b)), a, b, kinds))
        cols = zip(*rows, strict=True) if rows else ((),) * 5
        types = (pa.string(), pa.list_(pa.string()), pa.int32(), pa.int32(), pa.list_(pa.string()))
        yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                              names=["key", "contexts", "start", "end", "kinds"])


def _added_spans(docs: DataFrame, patterns: DataFrame, text: str) -> DataFrame:
    """(key, added): the spans that patterns add to each different text, by a
    join of the candidates' contexts. Copies of a text count as one."""
    rows = docs.select(F.sha2(text, 256).alias("key"), F.col(text).alias("text")).mapInArrow(
        _candidate_rows, "key string, contexts array<string>, start int, end int, kinds array<string>")
    rows = materialize(rows, "pii-candidates")
    p = patterns.select(F.col("context").alias("__context"), "kind")
    each = rows.select("key", "start", "end", "kinds", F.posexplode("contexts").alias("level", "context"))
    hits = each.join(p, (F.col("context") == F.col("__context")) & F.array_contains("kinds", F.col("kind")))
    hits = hits.groupBy("key", "start", "end").agg(F.min(F.struct("level", "kind")).alias("hit"))
    span = F.struct("hit.kind", "start", "end", F.lit(False).alias("base"))
    return materialize(hits.groupBy("key").agg(F.collect_list(span).alias("added")), "pii-added")


def find_spans(docs: DataFrame, patterns: DataFrame | list[tuple[str, str, float]], text: str = "text") -> DataFrame:
    """``docs`` with ``found``: array of (kind, start, end, base). Patterns are
    a list, or a table of any size (context, kind, p)."""
    if isinstance(patterns, DataFrame):
        if patterns.count() > BROADCAST_PATTERNS:
            return _joined_spans(docs, patterns, text)
        patterns = [(r["context"], r["kind"], r["p"]) for r in patterns.collect()]
    kinds = {c: k for c, k, _ in patterns}

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            out = []
            for t in batch:
                base = base_spans(t)
                spans = [(k, a, b, True) for k, a, b in base]
                if t and kinds:
                    at = None
                    for a, b in candidates(t, base):
                        at = at or Contexts(t)
                        k = next((k for c in at.of(a, b) if (k := kinds.get(c)) and plausible(k, t[a:b])), None)
                        if k:
                            spans.append((k, a, b, False))
                spans.sort(key=lambda s: (s[1], KINDS.index(s[0])))
                out.append([{"kind": k, "start": a, "end": b, "base": x} for k, a, b, x in spans])
            yield pd.Series(out)

    return docs.withColumn("found", F.pandas_udf(run, "array<struct<kind:string, start:int, end:int, base:boolean>>")(F.col(text)))


def _joined_spans(docs: DataFrame, patterns: DataFrame, text: str) -> DataFrame:
    """As ``find_spans``, for patterns that are too many to be sent."""
    added = _added_spans(docs, patterns, text).withColumnsRenamed({"key": "__pii_key", "added": "__pii_added"})
    d = find_spans(docs, [], text).withColumn("__pii_hash", F.sha2(text, 256))
    d = d.join(added, F.col("__pii_hash") == F.col("__pii_key"), "left")
    rank = lambda s: F.array_position(F.array(*map(F.lit, KINDS)), s["kind"])
    ranked = F.transform(F.concat("found", F.coalesce("__pii_added", F.expr("filter(found, s -> false)"))),
                         lambda s: F.struct(s["start"].alias("start"), rank(s).alias("rank"), s.alias("span")))
    return d.withColumn("found", F.transform(F.array_sort(ranked), lambda s: s["span"])).drop(
        "__pii_hash", "__pii_key", "__pii_added")


def q_op5(spark, sf):
    """Every whole text of ``documents``: counts and digest of the base spans,
    and all spans."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    d = find_spans(docs, pattern_table(docs))
    base = F.filter("found", lambda s: s["base"])
    said = lambda arr: F.array_join(F.transform(arr, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda k: F.size(F.filter(base, lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return d.select("doc_id", *[count(k) for k in KINDS], F.sha2(said(base).cast("binary"), 256).alias("base_sha256"),
                    said(F.col("found")).alias("spans"))
