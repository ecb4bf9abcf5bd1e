import random

import pytest
from llm_util import DOCS, SF, doc, prose, rows
from pyspark.sql import functions as F

from segmint.llm import op6_line_dedup as M


def lev(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        q = [i]
        for j, y in enumerate(b, 1):
            q.append(min(p[j] + 1, q[-1] + 1, p[j - 1] + (x != y)))
        p = q
    return p[-1]


def edited(rng, s, n):
    s = list(s)
    for _ in range(n):
        k, i = rng.randint(0, 2), rng.randrange(len(s) + 1)
        if k == 0:
            s.insert(i, rng.choice("abcé "))
        elif s:
            i = min(i, len(s) - 1)
            s[i : i + 1] = [] if k == 1 else [rng.choice("abcé ")]
    return "".join(s)


def judged(x):
    return len(x) >= M.MIN_CHARS or any(c.isalnum() for c in x)


def plain_dedup(docs):
    """Texts without the lines that go, by comparing all pairs of lines of
    every length."""
    order = sorted(range(len(docs)), key=lambda k: (docs[k][0] is None, docs[k][0] or 0))
    lines = sorted({x for _, t in docs for x in (t or "").split("\n") if judged(x)})
    parent = {x: x for x in lines}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(lines):
        for b in lines[i + 1 :]:
            most = min(M.EDITS, max(len(a), len(b)) // M.CHARS_PER_EDIT)
            if abs(len(a) - len(b)) <= most and lev(a, b) <= most:
                parent[find(a)] = find(b)
    seen, out = {}, {}
    for k in order:
        d, t = docs[k]
        if t is None:
            out[k] = None
            continue
        kept = []
        for n, x in enumerate(t.split("\n")):
            if not judged(x) or seen.setdefault(find(x), (d, t, n)) == (d, t, n):
                kept.append(x)
        out[k] = "\n".join(kept)
    return [out[k] for k in range(len(docs))]


def test_bit_parallel_distance_and_screen(spark):
    rng = random.Random(3)
    pairs = []
    for _ in range(1500):
        a = "".join(rng.choice("abcé ") for _ in range(rng.randint(0, 30)))
        pairs.append((a, edited(rng, a, rng.randint(0, 4))))
    n = (F.char_length("a"), F.char_length("b"))
    df = spark.createDataFrame(pairs, "a string, b string")
    for e in (1, 2, 3):
        got = df.select("a", "b", M.banded_distance(F.col("a"), F.col("b"), e).alias("d"),
                        M.within(F.col("a"), F.col("b"), *n, e).alias("w")).collect()
        for r in got:
            d = lev(r.a, r.b)
            assert r.d == min(e + 1, d) and r.w == (d <= e), (r, d)


def test_near_lines_share_a_key(spark):
    rng = random.Random(5)
    rows_ = []
    for i in range(800):
        a = "".join(rng.choice("abcdefgh é") for _ in range(rng.randint(22, 60)))
        rows_ += [(i, 0, a), (i, 1, edited(rng, a, rng.randint(1, 2)))]
    k = M.segment_keys(spark.createDataFrame(rows_, "i long, side int, line string"))
    a, b = k.where("side = 0").select("i", "k"), k.where("side = 1").select("i", "k")
    assert a.join(b, ["i", "k"]).select("i").distinct().count() == 800


@pytest.mark.parametrize("seed", [0, 1])
def test_texts_equal_all_pairs(spark, monkeypatch, seed):
    if seed:
        monkeypatch.setattr(M, "BROADCAST_KEYS", 0)  # the way for many shared keys
    rng = random.Random(seed)
    pool = [prose(i, rng.randint(4, 25)) for i in range(40)] + ["short", "", "again a line"]
    docs = []
    for i in range(60):
        lines = [rng.choice(pool) for _ in range(rng.randint(0, 8))]
        docs.append((i, "\n".join(edited(rng, x, rng.choice([0, 0, 1, 2, 3])) for x in lines)))
    docs += [(None, pool[0]), (70, None), (71, docs[3][1]), (72, docs[3][1])]
    df = spark.createDataFrame([doc(i, t) for i, t in docs], DOCS)
    got = {(r.doc_id): r.text for r in M.dedup_lines(df).select("doc_id", "text").collect()}
    assert got == dict(zip([i for i, _ in docs], plain_dedup(docs), strict=True))


def test_sample_counts(spark):
    got = rows(M.q_op6(spark, SF))
    for r in got:
        assert r["n_lines"] >= r["n_removed"] and len(r["class_ids"]) <= r["n_removed"]
    assert sum(r["n_removed"] for r in got) > 0


def test_one_line_in_all_documents_and_many_versions(spark):
    line = prose(1, 30)
    docs = [doc(i, line + "\n" + line[:40] + "x" * (i % 3) + line[40:] + f"\nown line {prose(i + 50, 6)}") for i in range(120)]
    got = rows(M.q_op6(spark, _folder(spark, docs)))
    assert sum(r["text"].count(line[:30]) for r in got) == 1
    assert sum("own line" in r["text"] for r in got) == 120


def _folder(spark, docs):
    from llm_util import folder
    return folder(spark, docs)


def test_edges(spark, edges, empty):
    got = rows(M.q_op6(spark, edges))
    assert len(got) == 11
    by = {r["doc_id"]: r for r in got if r["doc_id"] != 1}
    assert [r["n_removed"] for r in got if r["doc_id"] == 1] == [0, 0]  # repeated rows are one document
    assert by[2]["text"] is None and by[2]["n_lines"] == 0 and by[3]["text"] == "" and by[4]["text"] == "  \t\n \n"
    assert by[8]["text"] == "" and by[8]["n_removed"] == 1
    assert by[6]["n_lines"] == 801 and by[6]["n_removed"] == 0  # its lines are cut from a longer cycle
    assert rows(M.q_op6(spark, empty)) == []


def test_stage(spark, edges):
    docs = spark.read.parquet(f"{edges}/documents.parquet")
    out = M.line_stage(spark, docs, edges)
    assert out.columns == docs.columns
    kept = [r.doc_id for r in out.collect()]
    assert sorted(k for k in kept if k) == [1, 1, 2, 3, 4, 5, 6, 9, 10] and kept.count(None) == 1


def test_repeated_rows_that_lose_a_line_count_once(spark):
    line = prose(3, 12)
    docs = [doc(1, line + "\nfirst"), doc(2, "own two\n" + line), doc(2, "own two\n" + line), doc(3, line[:-1] + "#\nthird")]
    got = rows(M.q_op6(spark, _folder(spark, docs)))
    two = [r for r in got if r["doc_id"] == 2]
    assert [(r["n_removed"], r["n_links"], r["text"]) for r in two] == [(1, 1, "own two")] * 2
    assert [(r["n_removed"], r["n_links"]) for r in got if r["doc_id"] in (1, 3)] == [(0, 1), (1, 1)]


def test_lines_with_one_hash_are_told_apart(spark, monkeypatch):
    a, b = prose(11, 9), prose(12, 9)
    real = M.line_hash
    monkeypatch.setattr(M, "line_hash", lambda line: F.when(F.col(line).isin(a, b), F.lit(7).cast("long")).otherwise(real(line)))
    docs = [doc(1, a[:-1] + "#"), doc(2, b), doc(3, a)]
    got = {r["doc_id"]: r["text"] for r in rows(M.q_op6(spark, _folder(spark, docs)))}
    assert got == {1: a[:-1] + "#", 2: b, 3: ""}


def test_signature_never_rules_out_a_near_line(spark):
    rng = random.Random(8)
    pairs = []
    for _ in range(400):
        a = prose(rng.random(), rng.randint(1, 9))
        pairs.append((a, edited(rng, a, 2)))
    df = spark.createDataFrame(pairs, "a string, b string")
    apart = F.bit_count(M.signature("a").bitwiseXOR(M.signature("b")))
    assert df.where(apart > 4).count() == 0
