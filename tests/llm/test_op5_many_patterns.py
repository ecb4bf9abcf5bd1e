import pytest
from llm_util import doc, folder, rows

from segmint.llm import op5_pii as M


@pytest.mark.parametrize("joined", [False, True])
def test_no_pattern_is_dropped(spark, monkeypatch, joined):
    monkeypatch.setattr(M, "MAX_PATTERNS", 1, raising=False)  # the bound there was
    if joined:
        monkeypatch.setattr(M, "BROADCAST_PATTERNS", 1)
    docs = []
    for c in range(6):
        docs += [doc(100 * c + i, f"w{i} ask{'abcdef'[c]} on phone: +1 (555) 555-{1000 + 50 * c + i} thanks") for i in range(12)]
        docs += [doc(100 * c + i, f"w{i} mail{'abcdef'[c]} to box: ab{i}x{c}@site.example thanks") for i in range(50, 62)]
        docs += [doc(1000 + c, f"é note ask{'abcdef'[c]} on phone: 555-019{c} thanks, mail{'abcdef'[c]} to box: x{c}@local thanks a@b.cc")]
    docs += [docs[-1], doc(None, docs[-1][1]), doc(2000, None), doc(2001, ""), doc(2002, "on phone: none thanks")]
    patterns = M.learn_patterns(spark.createDataFrame(docs, spark.read.parquet(folder(spark, docs) + "/documents.parquet").schema))
    assert len(patterns) == 2  # contexts: "on phone:" and "to box:" before, "thanks" behind
    got = rows(M.q_op5(spark, folder(spark, docs)))
    assert len(got) == len(docs)
    by = {r["doc_id"]: r for r in got}
    for c in range(6):
        t = next(d[1] for d in docs if d[0] == 1000 + c)
        a, b, e = t.index("555-"), t.index(f"x{c}@local"), t.index("a@b.cc")
        assert by[1000 + c]["spans"] == f"phone:{a}:{a + 8},email:{b}:{b + 8},email:{e}:{e + 6}"
        assert by[1000 + c]["n_email"] == 1 and by[1000 + c]["n_phone"] == 0
    assert by[None]["spans"] == by[1005]["spans"] and by[2000]["spans"] == by[2001]["spans"] == by[2002]["spans"] == ""
