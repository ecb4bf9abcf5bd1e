"""SentencePiece encoding and decoding through a distinct-chunk table.

The model's normalization only turns spaces into the whitespace marker U+2581
and puts one marker in front, and none of its pieces has a marker after
another character. So no merge crosses from a character to a marker, and the
marked text falls apart into independent chunks: a run of markers with the
word behind it. Each worker segments every distinct chunk once with the
library, keeps its ids in a flat table, and joins ids back by position with
one numpy gather a batch. The table is emptied when it exceeds a fixed number
of chunks, so memory is bounded and results do not depend on it.

Models that do not have these properties are refused (``Chunks`` raises).
Defined cases: a null text counts as empty and has no ids; a text of spaces,
texts with U+2581, and texts of one very long word are encoded as the library
does; null id lists decode to ''. Repeated rows are encoded alike, each on its
own; very long texts are encoded whole; an empty table gives no rows; an output
column's name that is taken is replaced, all others are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARK = "▁"
PRODUCTION_MODEL = "piece_bpe_32k.model"


def read_model(path: str) -> bytes:
    """The tokenizer file (fixed size, about half a MB), shipped to workers."""
    with open(path, "rb") as f:
        return f.read()


def processor(model: bytes):
    from sentencepiece import SentencePieceProcessor
    return SentencePieceProcessor(model_proto=model)


class Chunks(dict):
    """Chunk -> number in a flat store of ids."""

    def __init__(self, model: bytes, limit: int = 150_000):
        super().__init__()
        from sentencepiece import sentencepiece_model_pb2 as pb
        spec = pb.ModelProto()
        spec.ParseFromString(model)
        norm = spec.normalizer_spec
        crossing = any(MARK in p.piece.lstrip(MARK) for p in spec.pieces if p.type in (1, 4))
        if (norm.precompiled_charsmap or not norm.add_dummy_prefix or norm.remove_extra_whitespaces
                or not norm.escape_whitespaces or crossing or spec.trainer_spec.treat_whitespace_as_suffix):
            raise ValueError("pieces of this model can cross whitespace markers")
        self.sp, self.limit = processor(model), limit
        self.mark_id = self.sp.piece_to_id(MARK)
        self.empty()

    def empty(self):
        self.clear()
        self.new: list[str] = []
        self.flat, self.used = np.zeros(1 << 16, np.int32), 0
        self.start, self.size = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def __missing__(self, chunk):
        i = self[chunk] = len(self)
        self.new.append(chunk)
        return i

    def segment(self):
        """Segments the chunks that came new, in one call of the library."""
        if not self.new:
            return
        # The library puts one marker in front; a plain chunk (no spaces, the
        # usual case) lacks it already, a longer run of markers loses one.
        got = self.sp.encode([c[1:] if c[:1] == " " else c for c in self.new], num_threads=1)
        got = [[self.mark_id] if c in ("", " ") else ids for c, ids in zip(self.new, got, strict=True)]
        i = len(self) - len(self.new)
        size = np.fromiter(map(len, got), np.int64, len(got))
        ids = np.fromiter(chain.from_iterable(got), np.int32, int(size.sum()))
        while len(self) > len(self.start):
            self.start, self.size = np.resize(self.start, 2 * len(self.start)), np.resize(self.size, 2 * len(self.size))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.flat[self.used : self.used + len(ids)] = ids
        self.size[i : len(self)] = size
        self.start[i : len(self)] = self.used + np.cumsum(size) - size
        self.used += len(ids)
        self.new = []


def chunks_of(text: str) -> list[str]:
    """Chunks of the marked text, spaces for markers. A chunk without a space
    in front stands for one marker and the word."""
    if not text:
        return []
    words = text.replace(MARK, " ").split(" ")
    if "" not in words:
        return words
    out, run = [], 0  # a run of k+1 markers: k empty words in front of a word
    for w in words[:-1]:
        if w:
            out.append(" " * (run + 1) + w if run else w)
            run = 0
        else:
            run += 1
    last = words[-1]
    out.append(" " * (run + 1) + last if run else last)
    return out


def _encoded(table: Chunks, texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and ids of a block of texts, joined back by position."""
    if len(table) > table.limit:
        table.empty()
    index, counts = [np.zeros(0, np.int64)], []
    for t in texts:
        c = chunks_of(t or "")
        index.append(np.fromiter(map(table.__getitem__, c), np.int64, len(c)))
        counts.append(len(c))
    table.segment()
    at = np.concatenate(index)
    size = table.size[at]
    ends = np.cumsum(size)
    flat = table.flat[np.repeat(table.start[at] - (ends - size), size) + np.arange(int(size.sum()))]
    per = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])]
    return per, flat


def _blocks(batches: Iterator[pa.Array], n: int = 128) -> Iterator[pa.Array]:
    for batch in batches:
        for lo in range(0, len(batch), n):
            yield batch.slice(lo, n)


def encode_column(text: Column, model: bytes) -> Column:
    """``array<int>`` of the whole text's ids, as the library's encode()."""

    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = Chunks(model)
        for block in _blocks(batches):
            per, flat = _encoded(table, block.to_pylist())
            yield pa.ListArray.from_arrays(pa.array(per, pa.int32()), pa.array(flat, pa.int32()))

    return F.arrow_udf(encode, "array<int>")(text)


def decode_column(ids: Column, model: bytes) -> Column:
    """Text of a list of ids, as the library's decode()."""

    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        sp = processor(model)
        for block in _blocks(batches):
            yield pa.array([sp.decode(x) if x else "" for x in block.to_pylist()], pa.string())

    return F.arrow_udf(decode, "string")(ids)


def round_trip_column(text: Column, model: bytes) -> Column:
    """Struct of ids and the text they decode to, in one pass."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = Chunks(model)
        for block in _blocks(batches):
            per, flat = _encoded(table, block.to_pylist())
            back = [table.sp.decode(flat[a:b].tolist()) if b > a else "" for a, b in zip(per[:-1], per[1:], strict=True)]
            ids = pa.ListArray.from_arrays(pa.array(per, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.StructArray.from_arrays([ids, pa.array(back, pa.string())], names=["ids", "decoded"])

    return F.arrow_udf(run, "ids array<int>, decoded string")(text)


def encode_decode(docs: DataFrame, model_path: str, text: str = "text", out: str = "pieces") -> DataFrame:
    """Adds struct ``out`` (replaced where it exists) of the ids and the text they
    decode to; other columns stay."""
    return docs.withColumn(out, round_trip_column(F.col(text), read_model(model_path)))


def digests(ids: str, decoded: str) -> list[Column]:
    """The digest columns of the contract."""
    return [
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col(ids).cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col(decoded).cast("binary"), 256).alias("decoded_sha256"),
    ]


def production_model() -> str:
    import public_tokenizers
    return public_tokenizers.path(PRODUCTION_MODEL)


def tokenized(docs: DataFrame) -> DataFrame:
    """doc_id and the digest columns of every whole text."""
    d = encode_decode(docs.select("doc_id", "text"), production_model())
    return d.select("doc_id", *digests("pieces.ids", "pieces.decoded"))


def q_op8(spark, sf):
    """Every row of ``documents``, with the public 32k model."""
    return tokenized(spark.read.parquet(f"{sf}/documents.parquet"))


def tokenize_stage(spark, docs, sf_dir):
    """Last pipeline stage: doc_id and the digests of every text's ids and of
    what they decode to."""
    return tokenized(docs)
