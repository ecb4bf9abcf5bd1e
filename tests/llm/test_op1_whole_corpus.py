import os
import random
import tracemalloc
import zlib

import numpy as np
from llm_util import prose

from segmint.llm import op1_decontamination as M


def test_every_passage_enters_the_factor(spark):
    texts = [prose(k, 70 + k) for k in range(40)] + [prose(3, 73), "", None]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    df, n = M.document_frequencies(docs)
    idf = np.log((n + 1) / (df + 1)) + 1e-3
    factor, different = M.corpus_factor(M.different_passages(docs), idf)
    x = np.zeros((different, M.TERMS))
    plain = M.matrix_rows(docs, [], idf, 1.0).collect()
    assert len(plain) == different == sum(-(-(70 + k) // M.WINDOW) for k in range(40))
    for i, r in enumerate(plain):
        x[i, r["at"]] = r["value"]
    gram = x @ x.T  # as many passages as fit the sums: nearly the whole of X'X
    share = (factor**2).sum() / np.trace(gram)
    assert 0.75 < share <= 1 + 1e-4
    # Along its rows the factor's products are those of all passages.
    length = np.linalg.norm(factor, axis=1)
    axes = factor[length > 1e-3] / length[length > 1e-3, None]
    assert np.allclose(axes @ axes.T, np.eye(len(axes)), atol=1e-4)
    assert np.allclose(np.linalg.norm(x @ axes.T, axis=0), length[length > 1e-3], rtol=1e-3)


def test_passages_that_a_hash_would_leave_out_shape_the_model(spark, monkeypatch):
    rng = random.Random(5)
    words = [w.encode() for w in prose(8, 400).split()]
    texts = []
    while len(texts) < 4_000:  # none of them among the 2,000 of lowest hash
        text = b" ".join(rng.choices(words[:200] if len(texts) % 2 else words[200:], k=M.WINDOW))
        if zlib.crc32(M.text_terms(text.decode()).tobytes()) >= 1 << 31:
            texts.append(text.decode())
    docs = spark.createDataFrame([(t,) for t in texts], "text string").select("text", M.terms_column(M.F.col("text")).alias("terms"))
    item = " ".join(f"benchmarkword{k}" for k in range(30))
    item = "".join(c if not c.isdigit() else chr(97 + int(c)) for c in item)
    benchmark = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    fitted, svd = [], M.randomised_svd
    monkeypatch.setattr(M, "randomised_svd", lambda rows: fitted.extend(rows.collect()) or svd(rows))
    next(M.fit_blocks(docs, benchmark, "terms"))
    own = set(M.text_terms(item).tolist())
    energy = sum(v * v for r in fitted for k, v in zip(r["at"], r["value"], strict=True) if k not in own)
    assert energy > 0.1 * M.CORPUS_WEIGHT


def test_the_driver_holds_little_of_the_fit(spark, monkeypatch):
    texts = [prose(k, 90 + k) for k in range(120)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").select("text", M.terms_column(M.F.col("text")).alias("terms")).repartition(4)
    benchmark = spark.createDataFrame([(k, prose(500 + k, 30)) for k in range(20)], "item_id bigint, text string")
    sent, collect = [], type(docs).collect

    def counted(self):
        got = collect(self)
        sent.append(sum(len(r["data"]) for r in got if "data" in r))
        return got

    monkeypatch.setattr(type(docs), "collect", counted)
    tracemalloc.start()
    try:
        list(M.fit_blocks(docs, benchmark, "terms"))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    thin = 4 * M.TERMS * (M.RANK + M.OVERSAMPLE)  # 9 MB
    assert max(sent) <= thin  # not the sums of the corpus (34 MB)
    assert most < 8 * thin


def test_orthonormal_columns_span_the_same():
    rng = np.random.default_rng(3)
    for shape in ((5000, 40), (64, 14), (4, 9)):
        y = rng.normal(size=shape).astype(np.float32) * np.logspace(0, -4, shape[1], dtype=np.float32)
        q = M._orthonormal(y)
        assert q.shape == (shape[0], min(shape)) and np.allclose(q.T @ q, np.eye(min(shape)), atol=1e-5)
        assert np.allclose(q @ (q.T @ y), y, atol=1e-5)


def test_hashing_texts_holds_little_beside_them():
    texts = [prose(k, 40).encode() * 12 for k in range(256)]
    tracemalloc.start()
    try:
        n = sum(len(x) for x in M.terms_of(texts))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n == sum(len(t.split()) for t in texts)
    assert most < 16 << 20


def test_executors_keep_no_matrix_of_the_fit(spark, monkeypatch):
    docs = spark.createDataFrame([(prose(k, 90 + k),) for k in range(120)], "text string").select("text", M.terms_column(M.F.col("text")).alias("terms")).repartition(4)
    benchmark = spark.createDataFrame([(k, prose(500 + k, 30)) for k in range(20)], "item_id bigint, text string")
    large, broadcast = [], type(spark.sparkContext).broadcast

    def seen(self, value):
        got = broadcast(self, value)
        if os.path.getsize(got._path) > 1 << 20:
            large.append(got._path)
        return got

    monkeypatch.setattr(type(spark.sparkContext), "broadcast", seen)
    assert len(list(M.fit_blocks(docs, benchmark, "terms"))) == 1
    assert len(large) >= 5
    assert not any(map(os.path.exists, large))  # destroyed, not left to the collector
