import pytest
from llm_util import doc, folder, rows

from segmint.llm import op5_pii as M


@pytest.fixture(params=[False, True])
def joined(request, monkeypatch):
    if request.param:
        monkeypatch.setattr(M, "BROADCAST_PATTERNS", 0)
    return request.param


def test_discovered_identifiers_are_seeds_of_new_patterns(spark, joined):
    # The first context is learned from base spans. It extracts short numbers,
    # which stand in a second context that holds no base span at all.
    docs = [doc(i, f"w{i} my phone number: +1 (555) 555-{1000 + i} thanks") for i in range(120)]
    docs += [doc(200 + i, f"w{i} my phone number: 555-01{i:02d} thanks") for i in range(10)]
    docs += [doc(300 + i, f"v{i} ring us under 555-01{i:02d} tonight") for i in range(10)]
    docs += [doc(400, "please ring us under 444-7777 tonight"), doc(401, "we sold 444-7777 of them")]
    got = {r["doc_id"]: r["spans"] for r in rows(M.q_op5(spark, folder(spark, docs)))}
    at = docs[-2][1].index("444")
    assert got[400] == f"phone:{at}:{at + 8}" and got[401] == ""
    assert all(got[k] for k in (*range(120), *range(200, 210), *range(300, 310)))


def test_contexts_back_off(spark, joined):
    # No full context has enough seeds; the word before them has.
    docs = [doc(i, f"ab{chr(97 + i)} mailto: ab{i}@site.example q{chr(97 + i)}") for i in range(24)]
    docs += [doc(100, "zz mailto: someone@localhost yy"), doc(101, "zz about someone@localhost yy")]
    got = {r["doc_id"]: r["spans"] for r in rows(M.q_op5(spark, folder(spark, docs)))}
    assert got[100] == "email:11:28" and got[101] == ""


def test_long_context_words_and_identifiers(spark, joined):
    long = "x" * 300
    docs = [doc(i, f"{long} a{'b' * 200}: ab{i}@site.example {long}") for i in range(12)]
    docs += [doc(100, f"{long} a{'b' * 200}: {'n' * 100}{'@'}{'m' * 100} {long}")]
    got = {r["doc_id"]: r["spans"] for r in rows(M.q_op5(spark, folder(spark, docs)))}
    at = docs[-1][1].index("nnn")
    assert got[100] == f"email:{at}:{at + 201}"


def test_contexts_are_linear():
    for text in ("1234567a" * 40_000, "1234567 " * 40_000):
        at = M.Contexts(text)
        for a, b in M.candidates(text, M.base_spans(text)):
            assert all(len(c) <= 4 * M.NEAREST for c in at.of(a, b) if c)
