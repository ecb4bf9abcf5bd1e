import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_util import SF, rows
from pyspark.sql import functions as F

from segmint.llm import op8_sentencepiece as M

MODEL = M.read_model(M.production_model())
SP = M.processor(MODEL)
TABLE = M.Chunks(MODEL)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["a", " ", "▁", "\n", "the", "é", "   ", "日本", "\t", "x ", "<s>", "</s>", "<0x41>", "\x00", "​", "😀"]), max_size=14).map("".join))
def test_chunks_give_the_library_s_ids(text):
    per, flat = M._encoded(TABLE, [text, None, text])
    ids = SP.encode(text)
    assert flat.tolist() == ids + ids and per.tolist() == [0, len(ids), len(ids), 2 * len(ids)]


def test_emptied_tables_change_nothing():
    small = M.Chunks(MODEL, limit=3)
    texts = [f"some words {i} and more {i * 7}" for i in range(50)]
    got = [M._encoded(small, [t])[1].tolist() for t in texts]
    assert got == SP.encode(texts) and len(small) < 20


def digest(ids):
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


@pytest.mark.parametrize("which", ["edges", "sample"])
def test_whole_texts(spark, edges, which):
    sf = edges if which == "edges" else SF
    got = sorted((r["doc_id"] or 0, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows(M.q_op8(spark, sf)))
    want = []
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = SP.encode(r.text or "")
        want.append((r.doc_id or 0, len(ids), digest(ids), hashlib.sha256(SP.decode(ids).encode()).hexdigest()))
    assert got == sorted(want)


def test_empty(spark, empty):
    assert rows(M.q_op8(spark, empty)) == []


def test_columns_apart(spark, edges):
    d = spark.read.parquet(f"{edges}/documents.parquet")
    back = d.select("text", M.encode_column(F.col("text"), MODEL).alias("ids")).select(
        "text", "ids", M.decode_column(F.col("ids"), MODEL).alias("back"))
    for r in back.collect():
        assert r.ids == SP.encode(r.text or "") and r.back == (r.text or "")
    none = spark.createDataFrame([(None,)], "ids array<int>").select(M.decode_column(F.col("ids"), MODEL)).first()[0]
    assert none == ""


def test_crossing_models_are_refused():
    from sentencepiece import sentencepiece_model_pb2 as pb
    spec = pb.ModelProto()
    spec.ParseFromString(MODEL)
    spec.pieces[5000].piece = "a▁b"
    with pytest.raises(ValueError):
        M.Chunks(spec.SerializeToString())
    assert np.all(TABLE.size >= 0)
