"""Fill-in-middle transformation by in-place block rotation.

A text is scanned for its units (blanks with the word behind them), two cuts
drawn from a hash of its id part it into prefix, middle and suffix, and the
sentinels are put before the parts in a bytearray: ``<P>`` prefix ``<M>``
middle ``<S>`` suffix. Each form is that buffer with two neighbouring blocks
exchanged, which three reversals do in place: ``psm`` exchanges middle and
suffix, ``spm`` moves the suffix to the front. The inverse finds the sentinels,
rotates back and takes them out.

Texts that hold a sentinel stay plain, so the sentinels of an output are the
inserted ones (no cut can make a new one: a sentinel begins with ``<`` and ends
with ``>``, and neither occurs inside).

Defined cases: a null text counts as empty and is plain; a text of blanks is
one unit; a null id draws as the empty string; rows with one id draw alike;
ties of the two cuts give an empty middle; very long texts are one buffer each;
an empty table gives no rows. Other columns stay; the name of the new column
must be free.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .wordscan import BLANKS, blank_mask

# Fixed values of the format: the sentinels, all of one length.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED = 42
FIM_PERCENT = 50
SPM_PERCENT = 80

FIELDS = "n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def unit_ends(data: np.ndarray, blank: np.ndarray) -> np.ndarray:
    """Ends of the units of one text: of every word, and of blanks after the
    last word."""
    if not len(data):
        return np.zeros(0, np.int64)
    gap = blank[data]
    last = np.append(gap[1:], True)
    ends = np.flatnonzero(~gap & last) + 1
    return np.append(ends, len(data)) if gap[-1] else ends


def rotate(buf: bytearray, lo: int, mid: int, hi: int) -> None:
    """Exchanges the neighbouring blocks buf[lo:mid] and buf[mid:hi] in place
    by three reversals."""
    for a, b in ((lo, mid), (mid, hi), (lo, hi)):
        buf[a:b] = buf[a:b][::-1]


def transform_text(data: bytes, a: int, b: int, form: str) -> bytearray:
    """The form's output of a text with cuts at bytes a <= b."""
    buf = bytearray(data)
    if form == "plain":
        return buf
    buf[b:b] = SUFFIX  # from the back, so that the cuts stay true
    buf[a:a] = MIDDLE
    buf[0:0] = PREFIX
    middle, suffix = a + len(PREFIX), b + len(PREFIX) + len(MIDDLE)
    rotate(buf, middle if form == "psm" else 0, suffix, len(buf))
    return buf


def restore_text(output: bytes, form: str) -> bytearray:
    """The text that ``transform_text`` made ``output`` of."""
    buf = bytearray(output)
    if form == "plain":
        return buf
    if form == "psm":
        suffix, middle = buf.find(SUFFIX), buf.find(MIDDLE)
        rotate(buf, suffix, middle, len(buf))
        a, b = suffix, suffix + len(buf) - middle
    else:
        prefix = buf.find(PREFIX)
        a = buf.find(MIDDLE) - prefix
        b = len(buf) - prefix
        rotate(buf, 0, prefix, len(buf))
    for at, mark in ((b, SUFFIX), (a, MIDDLE), (0, PREFIX)):
        if buf[at : at + len(mark)] != mark:
            raise ValueError("not an output of this form")
        del buf[at : at + len(mark)]
    return buf


def draws(doc_id: Column, seed: int = SEED) -> Column:
    """Array of four unsigned 32-bit numbers drawn from the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return F.array(*[F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)])


def fim_column(text: Column, drawn: Column, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> Column:
    """Struct ``FIELDS`` of every whole text."""
    blank = blank_mask(BLANKS)
    chars = np.ones(256, bool)
    chars[0x80:0xC0] = False  # bytes inside a character

    def one(data: bytes, h: list[int]) -> tuple:
        raw = np.frombuffer(data, np.uint8)
        ends = np.append(0, unit_ends(raw, blank))
        n = len(ends) - 1
        plain = not data or h[2] % 100 >= fim_percent or any(m in data for m in (PREFIX, SUFFIX, MIDDLE))
        form = "plain" if plain else "spm" if h[3] % 100 < spm_percent else "psm"
        a, b = (int(ends[k]) for k in sorted((h[0] % (n + 1), h[1] % (n + 1))))
        out = transform_text(data, a, b, form).decode("utf-8", "replace")
        if plain:
            return n, form, None, None, out
        return n, form, int(chars[raw[:a]].sum()), int(chars[raw[a:b]].sum()), out

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, numbers in batches:
            for lo in range(0, max(1, len(texts)), 256):
                got = [one(t or b"", h) for t, h in zip(texts[lo : lo + 256].to_pylist(), numbers[lo : lo + 256].to_pylist(), strict=True)]
                cols = list(zip(*got, strict=True)) if got else [()] * 5
                types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
                yield pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                                                 names=["n", "form", "prefix_chars", "middle_chars", "output"])

    return F.arrow_udf(run, FIELDS)(text.cast("binary"), drawn)


def restore_column(output: Column, form: Column) -> Column:
    """The text of an output and its form; null for a null in either."""

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for outputs, forms in batches:
            for lo in range(0, max(1, len(outputs)), 256):
                pairs = zip(outputs[lo : lo + 256].to_pylist(), forms[lo : lo + 256].to_pylist(), strict=True)
                yield pa.array([None if o is None or f is None else restore_text(o, f).decode("utf-8", "replace") for o, f in pairs],
                               pa.string())

    return F.arrow_udf(run, "string")(output.cast("binary"), form)


def fill_in_middle(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", out: str = "fim", seed: int = SEED,
                   fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """Adds struct ``out``: number of units, form, sizes of prefix and middle,
    and the output text."""
    if out in docs.columns:
        raise ValueError(f"column {out} exists")
    return docs.withColumn(out, fim_column(F.col(text), draws(F.col(doc_id), seed), fim_percent, spm_percent))


def q_op12(spark, sf):
    """Every row of ``documents``, with the digest of its output and of the
    text restored from it."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    d = fill_in_middle(docs).select("doc_id", "fim.*")
    d = d.withColumn("restored", restore_column(F.col("output"), F.col("form")))
    return d.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                    F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                    F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"))


SQL_OP12 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS s FROM documents),
u AS (
  SELECT doc_id, t, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS us,
         CAST('0x' || s[1:8] AS UBIGINT) AS h1, CAST('0x' || s[9:16] AS UBIGINT) AS h2,
         CAST('0x' || s[17:24] AS UBIGINT) AS h3, CAST('0x' || s[25:32] AS UBIGINT) AS h4 FROM d),
c AS (
  SELECT *, CAST(len(us) AS BIGINT) AS n, least(h1 % (len(us) + 1), h2 % (len(us) + 1)) AS a,
         greatest(h1 % (len(us) + 1), h2 % (len(us) + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (
  SELECT doc_id, t, n, form, coalesce(array_to_string(us[1:CAST(a AS BIGINT)], ''), '') AS pre,
         coalesce(array_to_string(us[CAST(a AS BIGINT) + 1:CAST(b AS BIGINT)], ''), '') AS mid,
         coalesce(array_to_string(us[CAST(b AS BIGINT) + 1:n], ''), '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""
