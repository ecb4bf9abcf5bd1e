import random

from llm_util import doc, folder, prose, rows
from test_op1_decontamination import plain_hits

from segmint.llm import op1_decontamination as M


def test_short_items_equal_a_search_without_retrieval(spark):
    rng = random.Random(9)
    items = [(i, prose(i, 3 + i % 12)) for i in range(60)]
    docs = [(i, prose(300 + i, 200)) for i in range(20)]
    planted = {}
    for i, t in items:
        for k in range(3):
            words = t.split()
            if k == 2 and len(words) >= M.FEW_WORDS:  # a paraphrase
                words[rng.randrange(len(words) // 2)] = "zzz"
            d = 1000 + 10 * i + k
            docs.append((d, " ".join([prose(2000 + d, 150 + 7 * k), *words, prose(4000 + d, 90 + i)])))
            planted[d] = i
    sf = folder(spark, [doc(*d) for d in docs], benchmark=[(*x, "w") for x in items])
    got = {r["doc_id"]: r["item_ids"] for r in rows(M.q_op1(spark, sf))}
    assert all(i in got[d] for d, i in planted.items())
    assert got == plain_hits(docs, items)


def test_short_and_long_items_in_one_block(spark):
    items = [(1, "one two three four"), (2, prose(1, 40)), (3, prose(2, 12))]
    docs = [(i, f"{prose(50 + i, 120)} {t} {prose(80 + i, 120)}") for i, t in items] + [(9, prose(70, 300))]
    sf = folder(spark, [doc(*d) for d in docs], benchmark=[(*x, "w") for x in items])
    assert {r["doc_id"]: r["item_ids"] for r in rows(M.q_op1(spark, sf))} == {1: [1], 2: [2], 3: [3], 9: []} == plain_hits(docs, items)


def test_verbatim_copies_without_the_last_sentence(spark):
    items = [(1, prose(1, 40) + ". " + prose(2, 12) + "."), (2, prose(3, 9) + ". " + prose(4, 4) + ".")]
    short = [" ".join(t.replace(".", "").split()[:n]) for (_, t), n in zip(items, (40, 9), strict=True)]
    broken = " ".join("zzz" if k % 6 == 5 else w for k, w in enumerate(short[0].split()))
    docs = [(i, f"{prose(50 + i, 120, 90)} {t} {prose(80 + i, 120, 90)}") for i, t in enumerate([*short, broken])]
    sf = folder(spark, [doc(*d) for d in docs], benchmark=[(*x, "w") for x in items])
    got = {r["doc_id"]: r["item_ids"] for r in rows(M.q_op1(spark, sf))}
    assert got == {0: [1], 1: [2], 2: []}  # a paraphrase still needs the answer


def test_copies_of_a_passage_enter_the_fit_once(spark):
    docs = spark.createDataFrame([(prose(1, 3 * M.WINDOW),)] * 50 + [(prose(2, M.WINDOW),)], "text string").repartition(5)
    df, n = M.document_frequencies(docs)
    assert n == 151 and M.matrix_rows(docs, [], (df + 1.0), 1.0).count() == 4


def test_models_are_fitted_a_group_at_a_time(spark, monkeypatch):
    items = [(i, prose(i, 30)) for i in range(8)]
    docs = [(i, f"{prose(50 + i, 60)} {t} {prose(80 + i, 60)}") for i, t in items]
    sf = folder(spark, [doc(*d) for d in docs], benchmark=[(*x, "w") for x in items])
    monkeypatch.setattr(M, "ITEMS", 2)
    monkeypatch.setattr(M, "BLOCKS_PER_PASS", 1)
    steps = []
    svd, column = M.randomised_svd, M.hits_column
    monkeypatch.setattr(M, "randomised_svd", lambda *a: steps.append("fit") or svd(*a))
    monkeypatch.setattr(M, "hits_column", lambda *a: steps.append("apply") or column(*a))
    got = {r["doc_id"]: r["item_ids"] for r in rows(M.q_op1(spark, sf))}
    assert steps == ["fit", "apply"] * (len(steps) // 2) and len(steps) >= 4
    assert got == plain_hits(docs, items)
