import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_util import DOCS, LONG, SF, doc, rows

from segmint.llm import op12_fill_in_middle as M

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain(doc_id, text):
    """The contract's row straight from its wording."""
    t = text or ""
    units = UNIT.findall(t)
    n = len(units)
    s = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(s[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, x = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not t or any(k in t for k in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, t
    if h[3] % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{x}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{x}<M>{m}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab é<S>PM\n "), max_size=30), st.data())
def test_rotations_restore_every_text(text, data):
    raw = text.encode()
    a, b = sorted(data.draw(st.tuples(st.integers(0, len(text)), st.integers(0, len(text)))))
    a, b = len(text[:a].encode()), len(text[:b].encode())
    if any(m in raw for m in (M.PREFIX, M.SUFFIX, M.MIDDLE)):
        return
    p, m, s = raw[:a], raw[a:b], raw[b:]
    assert M.transform_text(raw, a, b, "psm") == b"<P>" + p + b"<S>" + s + b"<M>" + m
    assert M.transform_text(raw, a, b, "spm") == b"<S>" + s + b"<P>" + p + b"<M>" + m
    for form in ("plain", "psm", "spm"):
        assert M.restore_text(bytes(M.transform_text(raw, a, b, form)), form) == raw


def test_restore_refuses_what_it_did_not_make():
    with pytest.raises(ValueError):
        M.restore_text(b"no sentinel here", "spm")


def test_rows_follow_the_contract(spark):
    texts = ["", None, " ", "word", "  a  b ", "x <P> y", "<S", "a<", "é ü wide\x1cseparator\x0bhere", LONG, "tail blanks \n\n"]
    docs = [doc(i, t) for i, t in enumerate(texts * 9)] + [doc(None, "no id at all here"), doc(3, "same id"), doc(3, "same id")]
    df = spark.createDataFrame(docs, DOCS)
    got = [r.asDict(recursive=True) for r in M.fill_in_middle(df).select("doc_id", "text", "fim").collect()]
    assert len(got) == len(docs)
    for r in got:
        assert tuple(r["fim"].values()) == plain(r["doc_id"], r["text"]), r["doc_id"]
    assert {r["fim"]["form"] for r in got} == {"plain", "psm", "spm"}


def test_given_rows_and_round_trip(spark):
    import pyarrow.parquet as pq
    texts = {r["doc_id"]: r["text"] for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}
    for r in rows(M.q_op12(spark, SF)):
        n, form, p, m, out = plain(r["doc_id"], texts[r["doc_id"]])
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"]) == (n, form, p, m)
        assert r["output_sha256"] == sha(out) and r["restored_sha256"] == sha(texts[r["doc_id"]] or "")


def test_edges(spark, edges, empty):
    got = rows(M.q_op12(spark, edges))
    assert len(got) == 11
    by = {r["doc_id"]: r for r in got}
    for i in (2, 3):
        assert by[i]["n"] == 0 and by[i]["form"] == "plain" and by[i]["restored_sha256"] == sha("")
    assert by[4]["n"] == 1 and by[6]["restored_sha256"] == sha(LONG)
    assert rows(M.q_op12(spark, empty)) == []


def test_new_column_must_be_free(spark):
    with pytest.raises(ValueError):
        M.fill_in_middle(spark.createDataFrame([doc(1, "a")], DOCS), out="words")


def test_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = sorted(map(tuple, con.execute(M.SQL_OP12).fetchall()))
    got = M.q_op12(spark, SF)
    cols = [d[0] for d in con.description]
    assert sorted(tuple(r[c] for c in cols) for r in got.collect()) == want
