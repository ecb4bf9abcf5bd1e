from llm_util import DOCS, doc, prose

from segmint.llm import op2_toxicity as M


def test_significant_words_of_small_log_odds_score(spark):
    docs, labels = [], []
    for i in range(800):
        toxic = i % 2
        words = prose(i, 30, 60) + (" vile" if toxic else "") + (" mild" if i // 2 % 10 < (5 if toxic else 2) else "")
        docs.append(doc(i, words))
        labels.append((i, toxic))
    model = M.fit(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    assert 0 < model.scores[b"mild"] < 1 and model.scores[b"mild"] < model.scores[b"vile"]
