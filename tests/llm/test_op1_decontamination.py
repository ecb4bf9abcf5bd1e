import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_util import SF, doc, folder, prose, rows

from segmint.llm import op1_decontamination as M


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b, 1):
            new.append(row[j - 1] + 1 if x == y else max(row[j], new[-1]))
        row = new
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abcde"), min_size=1, max_size=70), st.lists(st.sampled_from("abcdef"), max_size=70))
def test_bit_parallel_subsequence(a, b):
    assert M.lcs_length(M.masks_of(a), len(a), b) == plain_lcs(a, b)


def plain_hits(docs, items):
    """Every item against every stretch of every text, without retrieval."""
    ready = [(i, w, M.masks_of(w), a, M.masks_of(a)) for i, w, a in (M.prepare_item(*x) for x in items) if w]
    out = {}
    for d, t in docs:
        words = M.letter_words(t or "")
        found = sorted((x[0] is None, x[0] or 0) for x in ready if words and M.verify(words, x, 0, len(words)))
        out[d] = [None if n else i for n, i in found]
    return out


def test_sample_equals_a_search_without_retrieval(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = rows(M.q_op1(spark, SF))
    want = plain_hits(docs, items)
    assert {r["doc_id"]: r["item_ids"] for r in got} == want
    assert {r["doc_id"]: r["contaminated"] for r in got} == {d: bool(h) for d, h in want.items()}
    exact = {d for d, t in docs if any(x in t for _, x in items)}
    assert exact and all(want[d] for d in exact)


def test_terms_of_texts_are_those_of_their_words():
    for t in ("", None, "  ", "The the THE", "Ünï 12 a-b\nç", "x" * 9000 + " y"):
        words = M.letter_words(t or "")
        assert M.text_terms(t).tolist() == [int(M.term_ids([w])[0]) for w in words]
    assert len(set(M.text_terms("The the THE").tolist())) == 1


def test_paraphrases_and_clean_texts(spark):
    rng = random.Random(4)
    items = [(i, prose(i, 40) + ". " + prose(100 + i, 8)) for i in range(20)]
    docs, planted = [], set()
    for i in range(20):
        words = items[i][1].split()
        for share in (0.0, 0.1, 0.2):
            text = [prose(999, 1, 50) if rng.random() < share else w for w in words]
            k = 10_000 + i * 10 + int(share * 10)
            docs.append(doc(k, prose(500 + i, 300) + " " + " ".join(text) + " " + prose(600 + i, 300)))
            planted.add(k)
        docs.append(doc(i, prose(700 + i, 600)))
    sf = folder(spark, docs, benchmark=[(*x, "w") for x in items])
    got = {r["doc_id"]: r["item_ids"] for r in rows(M.q_op1(spark, sf))}
    assert not any(got[i] for i in range(20))
    found = [k for k in planted if (k - 10_000) // 10 in got[k]]
    assert len(found) / len(planted) >= 0.9 and all(10_000 + i * 10 in found for i in range(20))


def test_blocks_of_items_find_the_same(spark, monkeypatch):
    whole = {r["doc_id"]: r["item_ids"] for r in rows(M.q_op1(spark, SF))}
    monkeypatch.setattr(M, "ITEMS", 15)
    monkeypatch.setattr(M, "BLOCKS_PER_PASS", 1)
    assert {r["doc_id"]: r["item_ids"] for r in rows(M.q_op1(spark, SF))} == whole


def test_svd_equals_numpy(spark, monkeypatch):
    monkeypatch.setattr(M, "TERMS", 64)
    monkeypatch.setattr(M, "OVERSAMPLE", 8)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(90, 6)) @ rng.normal(size=(6, 64)) + 0.01 * rng.normal(size=(90, 64))
    df = spark.createDataFrame([(list(range(64)), r.tolist()) for r in x], "at array<int>, value array<float>").repartition(3)
    v, s = M.randomised_svd(df, rank=6)
    assert np.allclose(s, np.linalg.svd(x)[1][:6], rtol=1e-3)
    assert np.allclose(np.linalg.norm(x @ v, axis=0), s, rtol=1e-3)


def test_frequencies_count_all_passages(spark, edges):
    df, n = M.document_frequencies(spark.read.parquet(f"{edges}/documents.parquet"))
    texts = [M.letter_words(r.text or "") for r in spark.read.parquet(f"{edges}/documents.parquet").collect()]
    assert n == sum(-(-len(w) // M.WINDOW) for w in texts)
    the = M.term_ids([b"the"])[0]
    assert df[the] >= sum(b"the" in w[k : k + M.WINDOW] for w in texts for k in range(0, len(w), M.WINDOW))


def test_edges(spark, edges, empty):
    got = rows(M.q_op1(spark, edges))
    assert len(got) == 11
    by = {r["doc_id"]: r for r in got}
    assert by[1]["item_ids"] == [1] and by[8]["item_ids"] == [1] and by[5]["item_ids"] == [2]
    assert by[6]["item_ids"] == [2]  # its words are "word" with numbers behind
    assert not any(by[i]["contaminated"] for i in (2, 3, 4, 9, 10))
    assert rows(M.q_op1(spark, empty)) == []
    docs = spark.read.parquet(f"{edges}/documents.parquet")
    out = M.decontamination_stage(spark, docs, edges)
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == [2, 3, 4, 9, 10]
    assert M.decontamination_stage(spark, docs, empty).count() == 11
