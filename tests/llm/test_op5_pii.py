import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from llm_util import DOCS, SF, doc, folder, rows

from segmint.llm import op5_pii as M

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(text):
        d = re.sub("[ -]", "", m[0])
        if 14 <= len(d) <= 19 and sum(sum(divmod(int(x) * (1 + i % 2), 10)) for i, x in enumerate(d[::-1])) % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], M.KINDS.index(s[0])))


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


PARTS = ["a", "@", ".", "a.b", "1", "25", "256", " ", "-", "+", "1.2.3.4", "4111 1111 1111 1111", "(", "+1 (555) 555-1234", "é", "٣", "@x.y"]


@settings(max_examples=800, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=16).map("".join))
def test_base_spans_equal_the_patterns(text):
    assert M.base_spans(text) == plain(text)


def test_long_runs_are_linear():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "@" * 100_000, "1." * 100_000, "+1 " * 60_000, "1 " * 100_000):
        assert len(list(M.candidates(text, M.base_spans(text)))) < 3


def test_sample_equals_the_patterns(spark):
    got = {r["doc_id"]: r for r in rows(M.q_op5(spark, SF))}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        want, g = plain(r.text or ""), got[r.doc_id]
        assert g["base_sha256"] == digest(want)
        assert [g[f"n_{k}"] for k in M.KINDS] == [sum(s[0] == k for s in want) for k in M.KINDS]


def test_patterns_discover_unseen_identifiers(spark):
    docs = [doc(i, f"please note w{i} my phone number: +1 (555) 555-{1000 + i} thanks, bye") for i in range(20)]
    docs += [doc(100, "note my phone number: 555-0199 thanks a lot"), doc(101, "we sold 1234567 of 555-0199 last year"),
             doc(102, "my phone number: yesterday thanks to all"), doc(103, None), doc(104, "")]
    got = {r["doc_id"]: r for r in rows(M.q_op5(spark, folder(spark, docs)))}
    assert got[100]["spans"] == "phone:22:30" and got[100]["n_phone"] == 0  # counted are base spans
    assert got[101]["spans"] == got[102]["spans"] == got[103]["spans"] == got[104]["spans"] == ""
    assert got[103]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert all(got[i]["n_phone"] == 1 for i in range(20))


def test_doubtful_contexts_add_nothing(spark):
    docs = [doc(i, f"about the price: +1 (555) 555-{1000 + i} now") for i in range(8)]
    docs += [doc(50 + i, f"about the price: {1234567 + i * 31} now") for i in range(30)]
    df = spark.createDataFrame(docs, DOCS)
    assert M.learn_patterns(df) == []


def test_confidence_equals_a_plain_iteration(spark):
    docs = [doc(i, f"call me at +1 (555) 555-{1000 + i} today") for i in range(12)] + [doc(99, "call me at 555-0101 today")]
    (context, kind, p), = M.learn_patterns(spark.createDataFrame(docs, DOCS))
    score = 12 / (13 + M.PRIOR)
    for _ in range(M.ROUNDS):
        score = (12 + score) / (13 + M.PRIOR)
    assert (context, kind) == ("me at _ today", "phone") and abs(p - score) < 1e-9


def test_edges(spark, edges, empty):
    got = rows(M.q_op5(spark, edges))
    assert len(got) == 11 and all(r["spans"] == "" for r in got)
    assert rows(M.q_op5(spark, empty)) == []
