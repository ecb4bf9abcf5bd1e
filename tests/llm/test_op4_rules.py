import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_util import DOCS, LONG, SF, doc, rows

from segmint.llm import op4_quality_rules as M

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    """The measurements straight from their definitions."""
    t = text or ""
    w = WORD.findall(t)
    seen, dup = set(), 0
    for x in t.split("\n"):
        if WORD.search(x):
            dup += x in seen
            seen.add(x)
    win = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    rep = {p for i in range(len(w) - 4) if win[tuple(w[i : i + 5])] > 1 for p in range(i, i + 5)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(rep)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab \n\t#é\x1c $"), max_size=80))
def test_measurements_follow_their_definitions(text):
    assert M.measure_text(text)[:5] == plain(text)


def test_repeats_with_many_distinct_words():
    words = [f"w{i}" for i in range(20_000)]
    assert M.repeated_window_words(words + words[100:120]) == 40


def test_edges(spark, edges):
    got = rows(M.q_op4(spark, edges))
    assert len(got) == 11
    by = {r["doc_id"]: r for r in got}
    for i in (2, 3, 4):
        assert by[i]["n_words"] == 0 and by[i]["base_failed"] and not by[i]["kept"]
    assert by[6]["n_words"] == len(WORD.findall(LONG))
    assert by[1]["kept"] and None in by


def test_empty(spark, empty):
    assert rows(M.q_op4(spark, empty)) == []
    assert rows(M.ablations(M.ledger(spark.read.parquet(f"{empty}/documents.parquet")))) == []


def test_policies_and_ablations(spark):
    led = M.ledger(spark.read.parquet(f"{SF}/documents.parquet")).cache()
    failed = [r["failed"] for r in rows(led)]
    for r in rows(M.ablations(led)):
        mask, bit = M.policy_mask(r["policy"]), M.rule_bit(r["rule"])
        assert r["n_kept"] == sum(not f & mask for f in failed)
        assert r["n_kept_without"] == sum(not f & mask & ~bit for f in failed)
        assert r["n_only_this"] == sum(f & mask == bit for f in failed)
    assert {r["kept"] for r in rows(M.apply_policy(led, "v1"))} == {True, False}


def test_policies_read_the_stored_ledger(spark, monkeypatch, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for led in (M.write_ledger(docs), M.write_ledger(docs, str(tmp_path / "ledger"))):
        plan = M.apply_policy(led, "v1")._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "text" not in plan
    want = {r["doc_id"]: r["n_words"] < 100 for r in rows(led)}
    was = {r["doc_id"]: r["failed"] for r in rows(led)}
    monkeypatch.setitem(M.RULES, "under_100", "n_words < 100")
    new = M.evaluate(spark.read.parquet(str(tmp_path / "ledger")))
    bit = M.rule_bit("under_100")
    assert {r["doc_id"]: r["failed"] for r in rows(new)} == {i: f | bit * want[i] for i, f in was.items()}
    assert any(want.values()) and not all(want.values())
    with pytest.raises(ValueError, match="failed"):
        M.ledger(docs.withColumn("failed", docs.doc_id), ("doc_id", "failed"))


def test_every_rule_can_fail(spark):
    texts = ["a b", "one two three four five " * 9, "a### b*** " * 20, "same line here\n" * 9 + "x " * 9, "LOUD WORDS " * 20, "a " * 30]
    df = spark.createDataFrame([doc(i, t) for i, t in enumerate(texts)], DOCS)
    for (name, r) in zip(M.RULES, sorted(rows(M.ledger(df)), key=lambda r: r["doc_id"]), strict=True):
        assert r["failed"] & M.rule_bit(name), name


def test_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = con.execute(M.SQL_OP4).df().sort_values("doc_id").reset_index(drop=True)
    got = M.q_op4(spark, SF).toPandas().sort_values("doc_id").reset_index(drop=True)[want.columns]
    assert got.equals(want.astype(got.dtypes.to_dict()))
