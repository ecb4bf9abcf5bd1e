"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document: the ledger is a written table of
what was measured and one bit per failed rule. A policy is a versioned set of rules; its verdict
is ``failed & mask = 0``, so a new policy, or the effect of dropping a rule,
needs no second look at any text, and a rule appended later is evaluated on the
stored measurements (``evaluate``). Ablations come from counting the distinct
masks (at most 2^rules of them, map-side combined) and bitwise arithmetic on
those counts.

Words are ``[^\\x20\\x09-\\x0D]+``. Defined cases: a null or empty text has no
words, all measurements 0, and fails ``too_short``; very long texts are
measured whole; repeated rows are measured alike, each on its own; an empty
table gives an empty ledger and no ablations. The ledger holds ``keys`` and its
own columns, no others, so names cannot clash except with a key (refused).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper_words"]

#: Rule name -> the condition (SQL over the measurements) under which it
#: fails. The bit of a rule is its place here; rules are only ever appended.
RULES = {
    "too_short": "n_words < 10",
    "repeated_passages": "100 * n_repeat_words > 20 * n_words",
    "symbol_heavy": "3 * n_symbols > n_words",
    "duplicate_lines": "n_lines >= 4 and 100 * n_dup_lines > 40 * n_lines",
    "shouting": "100 * n_upper_words > 60 * n_words",
    "odd_word_length": "word_chars < 2 * n_words or word_chars > 20 * n_words",
}

#: Policy version -> names of the rules it applies.
POLICIES = {
    "base": ("too_short", "repeated_passages"),
    "v1": ("too_short", "repeated_passages", "symbol_heavy", "duplicate_lines"),
    "v2": tuple(RULES),
}
PRODUCTION = "v2"


def rule_bit(name: str) -> int:
    return 1 << list(RULES).index(name)


def policy_mask(version: str) -> int:
    return sum(rule_bit(r) for r in POLICIES[version])


def repeated_window_words(words: list, size: int = 5) -> int:
    """Words that lie in some ``size``-word window found twice or more."""
    n = len(words)
    if n <= size:
        return 0
    ids: dict = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    windows = n - size + 1
    key, base = codes[:windows].copy(), len(ids)
    limit = base
    for k in range(1, size):
        if limit * base >= 1 << 62:  # renumber exactly before the packed key would overflow
            key = np.unique(key, return_inverse=True)[1].astype(np.int64)
            limit = windows
        key = key * base + codes[k : k + windows]
        limit *= base
    order = np.sort(key)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    hit = np.isin(key, twice)
    cover = np.zeros(n + 1, np.int64)
    starts = np.flatnonzero(hit)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + size, -1)
    return int((np.cumsum(cover[:n]) > 0).sum())


def measure_text(text: str | None) -> tuple:
    if not text:
        return (0,) * len(MEASURES)
    words = text.encode("utf-8", "replace").split()
    blanks = sum(map(text.count, " \t\n\v\f\r"))
    lines = [x for x in text.split("\n") if x.strip(" \t\v\f\r")]
    return (
        len(words),
        len(text) - blanks,
        sum(map(text.count, "#*$%&|<>")),
        len(lines) - len(set(lines)),
        repeated_window_words(words),
        len(lines),
        sum(map(bytes.isupper, words)),
    )


def _measure(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        yield pd.DataFrame([measure_text(t) for t in batch], columns=MEASURES, dtype="int64")


def evaluate(led: DataFrame) -> DataFrame:
    """``led`` with ``failed`` (bit k set: rule k failed) of the present rules,
    from the measurements alone."""
    bits = [F.when(F.expr(cond), F.lit(rule_bit(r)).cast("long")).otherwise(F.lit(0).cast("long"))
            for r, cond in RULES.items()]
    failed = bits[0]
    for b in bits[1:]:
        failed = failed.bitwiseOR(b)
    return led.withColumn("failed", failed)


def ledger(docs: DataFrame, keys: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keys``, the measurements and ``failed``; ``write_ledger`` stores it."""
    if clash := {k.lower() for k in keys} & {*MEASURES, "failed"}:
        raise ValueError(f"keys with names of the ledger: {sorted(clash)}")
    measure = F.pandas_udf(_measure, ", ".join(f"{c} bigint" for c in MEASURES))
    return evaluate(docs.select(*keys, measure(F.col(text)).alias("_m")).select(*keys, "_m.*"))


def write_ledger(docs: DataFrame, path: str | None = None, keys: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The ledger as a table: at ``path``, where later runs read it, or in the
    shared folder. Policies, ablations and new rules read it, never a text."""
    led = ledger(docs, keys, text)
    if path is None:
        return materialize(led, "rule-ledger")
    led.write.parquet(path)
    return docs.sparkSession.read.schema(led.schema).parquet(path)


def apply_policy(led: DataFrame, version: str = PRODUCTION, out: str = "kept") -> DataFrame:
    """Adds ``out``: true where no rule of the policy failed."""
    return led.withColumn(out, F.col("failed").bitwiseAND(F.lit(policy_mask(version)).cast("long")) == 0)


def ablations(led: DataFrame) -> DataFrame:
    """For each policy and each of its rules: documents kept by the policy,
    kept if the rule were dropped, and rejected by that rule alone. One
    aggregation to at most 2^rules distinct masks serves every policy."""
    masks = led.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    at = masks.withColumn("r", F.explode(F.array(*[
        F.struct(F.lit(v).alias("policy"), F.lit(r).alias("rule"), F.lit(policy_mask(v)).cast("long").alias("mask"),
                 F.lit(rule_bit(r)).cast("long").alias("bit")) for v, rs in POLICIES.items() for r in rs])))
    f = F.col("failed")
    hit = f.bitwiseAND(F.col("r.mask"))
    kept = F.when(hit == 0, F.col("n")).otherwise(0)
    alone = F.when(hit == F.col("r.bit"), F.col("n")).otherwise(0)
    return at.groupBy(F.col("r.policy").alias("policy"), F.col("r.rule").alias("rule")).agg(
        F.sum(kept).alias("n_kept"), F.sum(kept + alone).alias("n_kept_without"), F.sum(alone).alias("n_only_this"))


def q_op4(spark, sf):
    """All rows of ``documents`` under the production policy: the stored
    ledger is what the policies read."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    led = apply_policy(write_ledger(docs))
    base = F.col("failed").bitwiseAND(F.lit(policy_mask("base")).cast("long")) != 0
    return led.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      base.alias("base_failed"), "kept", F.col("failed").alias("failed_bits"))


SQL_OP4 = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT rid, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d),
pos AS (SELECT rid, ws, len(ws) AS n, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5),
win AS (SELECT rid, i, ws[i:i+4] AS g FROM pos),
rep AS (SELECT rid, g FROM win GROUP BY rid, g HAVING count(*) > 1),
hit AS (SELECT DISTINCT win.rid, unnest(range(win.i, win.i + 5)) AS p FROM win JOIN rep USING (rid, g)),
cnt AS (SELECT rid, count(*) AS c FROM hit GROUP BY rid),
m AS (
  SELECT w.rid, doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(list_sum(list_transform(ws, lambda x: length(x))) AS BIGINT) AS wc,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c, 0) AS BIGINT) AS n_repeat_words, CAST(len(ls) AS BIGINT) AS n_lines,
         CAST(len(list_filter(ws, lambda x: regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '[a-z]'))) AS BIGINT) AS nu
  FROM w LEFT JOIN cnt ON w.rid = cnt.rid),
b AS (
  SELECT doc_id, n_words, coalesce(wc, 0) AS word_chars, n_symbols, n_dup_lines, n_repeat_words,
         (CASE WHEN n_words < 10 THEN 1 ELSE 0 END)
         + (CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END)
         + (CASE WHEN 3 * n_symbols > n_words THEN 4 ELSE 0 END)
         + (CASE WHEN n_lines >= 4 AND 100 * n_dup_lines > 40 * n_lines THEN 8 ELSE 0 END)
         + (CASE WHEN 100 * nu > 60 * n_words THEN 16 ELSE 0 END)
         + (CASE WHEN coalesce(wc, 0) < 2 * n_words OR coalesce(wc, 0) > 20 * n_words THEN 32 ELSE 0 END) AS f
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (f & 3) <> 0 AS base_failed, f = 0 AS kept, CAST(f AS BIGINT) AS failed_bits
FROM b
"""
