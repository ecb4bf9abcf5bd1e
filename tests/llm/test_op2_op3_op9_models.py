import random

import numpy as np
import pytest
from llm_util import DOCS, SF, doc, folder, prose, rows
from pyspark.sql import functions as F

from segmint.llm import op2_toxicity as T
from segmint.llm import op3_language_id as L
from segmint.llm import op9_quality_classifier as Q
from segmint.llm.common import WordTable, gram_buckets, held_out, sampled_labels


def test_held_out_rows(spark):
    import zlib
    df = spark.createDataFrame([(i,) for i in [*range(200), None]], "doc_id bigint").withColumn("h", held_out())
    assert all(r.h == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in df.collect())


def test_samples_are_bounded_and_of_all_classes(spark):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 100 == 0, "rare").otherwise("often").alias("y"))
    df = df.union(spark.createDataFrame([(None, "often"), (3, None)], "doc_id bigint, y string"))
    n = {r.y: r["count"] for r in sampled_labels(df, "doc_id", "y", 1000).groupBy("y").count().collect()}
    assert n["rare"] == 200 and 800 < n["often"] < 1200


def test_word_tables_are_bounded_and_exact():
    words = [f"w{i % 37}".encode() for i in range(500)]
    t = WordTable(lambda new: np.array([[len(w), w[-1]] for w in new]), 2, limit=10)
    for _ in range(3):
        t.room()
        got = t.sums([words, [], words[:1]])
        assert got.tolist() == [[sum(map(len, words)), sum(w[-1] for w in words)], [0, 0], [len(words[0]), words[0][-1]]]
    flat, owner = gram_buckets([b"ab", b""], (2, 3, 4), 1 << 20)
    assert np.bincount(owner).tolist() == [3 + 2 + 1, 1]


def plain_segments(s):
    """Maximal scoring segments by their recursive definition."""
    best = max(((sum(s[i:j]), -(j - i), i, j) for i in range(len(s)) for j in range(i + 1, len(s) + 1)), default=(0,))
    if best[0] <= 1e-12:
        return []
    i, j = best[2], best[3]
    return plain_segments(s[:i]) + [(i, j)] + [(a + j, b + j) for a, b in plain_segments(s[j:])]


def test_segments_equal_the_definition():
    rng = np.random.default_rng(0)
    for _ in range(200):
        s = rng.normal(-0.2, 1, rng.integers(0, 13))
        assert [(a, b) for a, b, _ in T.segments(s)] == plain_segments(list(s))


def test_lambda_is_the_root():
    p, s = np.array([0.01, 0.99]), np.array([3.0, -0.1])
    assert (p * np.exp(T._lambda(p, s) * s)).sum() == pytest.approx(1)
    assert T._lambda(np.array([1.0]), np.array([0.5])) == 0


def planted(spark, n=400):
    """Toxic texts hold a passage of marked words; labels are right."""
    rng = random.Random(1)
    docs, labels = [], []
    for i in range(n):
        words = prose(i, rng.randint(60, 300)).split()
        toxic = i % 3 == 0
        if toxic:
            at = rng.randrange(len(words))
            words[at:at] = [rng.choice(["vilezz", "scumzz", "hatezz"]) for _ in range(3)]
        docs.append(doc(i, " ".join(words)))
        labels.append((i, 1, int(toxic), "g"))
    return folder(spark, docs, labels), {i: i % 3 == 0 for i in range(n)}


def test_toxicity_on_held_out_rows(spark):
    sf, truth = planted(spark)
    got = [r for r in rows(T.q_op2(spark, sf)) if r["held_out"]]
    assert len(got) > 50
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in got]) > 0.97
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = T.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    for r in T.score(docs.where("doc_id % 3 = 0"), model).select("text", "toxicity").collect():
        words = r.text.split()
        for p in r.toxicity.passages:
            assert any(w.endswith("zz") for w in words[p.first : p.last + 1])


def test_toxicity_on_given_rows(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = [r for r in rows(T.q_op2(spark, sf)) if r["held_out"] and r["doc_id"] in labels]
    yes, no = ([r["predicted"] for r in got if labels[r["doc_id"]] == v] for v in (1, 0))
    assert np.mean(yes) > 0.5 and np.mean(no) < 0.05  # some labels are noise


def test_toxicity_edges(spark, edges, empty):
    for sf, n in ((edges, 11), (empty, 0)):
        got = rows(T.q_op2(spark, sf))
        assert len(got) == n and all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in got)
    docs = spark.createDataFrame([doc(1, "a b"), doc(2, None)], DOCS)
    assert [r.toxicity.score for r in T.score(docs, T.ToxicityModel({}, 0.0, 0.0)).collect()] == [0.0, 0.0]


def test_language_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = [r for r in rows(L.q_op3(spark, sf)) if r["held_out"]]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in got]) > 0.98


def test_language_cached_words_equal_plain_scoring(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = L.fit(docs)
    for r in L.detect(docs, model, reject=False).select("text", "language").collect():
        words = L.letter_words(r.text)
        flat, _ = L.grams(words) if words else (np.zeros(0, int), None)
        if len(flat):
            p = model.probabilities(model.logits[flat].mean(0)[None, :])[0]
            assert r.language.lang == model.langs[int(p.argmax())] and r.language.score == pytest.approx(p.max(), abs=1e-4)


def test_language_edges(spark, edges, empty):
    by = {r["doc_id"]: r for r in rows(L.q_op3(spark, edges))}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (2, 3, 4, 9))
    assert all(by[i]["lang_pred"] == "en" for i in (1, 5, 6, 8, 10))
    assert rows(L.q_op3(spark, empty)) == []
    unlabelled = spark.createDataFrame([doc(1, "text", None)], DOCS)
    assert L.detect(unlabelled, L.fit(unlabelled)).select("language.lang").first()[0] == "und"


def test_language_rejection_is_calibrated():
    model = L.LanguageModel(["a", "b"], np.zeros((L.BUCKETS, 2)), np.array([0.1, 0.0]), 1.0, 0.9)
    assert model.probabilities(np.zeros((1, 2)))[0, 0] < model.reject


def test_thresholds_are_ordered_and_shared():
    rng = np.random.default_rng(0)
    z = rng.normal(size=600)
    y = np.digitize(z + 0.3 * rng.logistic(size=600), [-0.5, 0.7])
    x = [(np.array([0, 1]), np.array([v, 1.0], np.float32)) for v in z]
    m = Q.train(x, y, np.ones(600), 3)
    assert m.thresholds[0] < m.thresholds[1] and m.weights[0] > 0
    t = m.tails(np.array([-3.0, 0.0, 3.0]) * m.weights[0] + m.weights[1])
    assert (np.diff(t[:, 0]) > 0).all() and (t[:, 0] >= t[:, 1]).all()


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    good = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = [r for r in rows(Q.q_op9(spark, sf)) if r["held_out"] and r["doc_id"] in good]
    keep = [r["kept"] for r in got if good[r["doc_id"]]]
    drop = [not r["kept"] for r in got if not good[r["doc_id"]]]
    assert np.mean(keep) > 0.97 and np.mean(drop) > 0.7


def test_quality_cached_words_equal_plain_scoring(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = Q.fit(docs, Q.grades_of(spark.read.parquet(f"{SF}/labels.parquet")))
    f = F.pandas_udf(Q._features, "buckets array<int>, weights array<float>")
    for r in Q.graded(docs, model).select("tails", f("text").alias("f")).collect():
        z = float(np.dot(model.weights[r.f.buckets], r.f.weights)) if r.f.buckets else None
        want = [0.0, 0.0] if z is None else model.tails(z)
        assert np.allclose(r.tails, want, atol=1e-3)


def test_quality_edges(spark, edges, empty):
    got = rows(Q.q_op9(spark, edges))
    assert len(got) == 11
    assert all(not r["kept"] and r["expected_grade"] == 0 for r in got if r["doc_id"] in (2, 3, 4))
    assert rows(Q.q_op9(spark, empty)) == []
    docs = spark.read.parquet(f"{edges}/documents.parquet")
    out = Q.quality_stage(spark, docs, empty)  # no ratings: only texts without words go
    assert out.columns == docs.columns and out.count() == 8
