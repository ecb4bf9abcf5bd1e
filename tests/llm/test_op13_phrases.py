import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_util import DOCS, doc, rows

from segmint.llm import op13_phrases as M

SMALL = "/root/testdata/sf0.01"


def plain(docs, min_count, max_words=5, top=2000):
    """(lang, rank, phrase, a, l, r, n, score), straight from the definition."""
    f, n = {}, Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", t):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for i in range(len(w)):
                for z in range(1, max_words + 1):
                    if i + z <= len(w):
                        f.setdefault(lang, Counter())[tuple(w[i : i + z])] += 1
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= min_count}
        got = []
        for p, a in cand.items():
            score, k = min((1000 * a * n[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            inside = any(b >= a and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))
                         for q, b in cand.items())
            if not inside:
                got.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(got)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def talk(seed, n=120):
    rng = random.Random(seed)
    voc = [f"w{k}" for k in range(40)] + ["Élan", "ß", "A\x1cb", "x-y"]
    phrases = [[rng.choice(voc) for _ in range(rng.randint(2, 7))] for _ in range(12)]
    docs = []
    for _ in range(n):
        t = ""
        for _ in range(rng.randint(0, 30)):
            p = rng.choice(phrases) if rng.random() < 0.5 else [rng.choice(voc)]
            t += rng.choice([" ", "\t", "  "]).join(p) + rng.choice([" ", " ", " ", ". ", ",", "\n", "\r\n", "!"])
        docs.append((rng.choice(["en", "en", "de", None, "und"]), t))
    return docs + [("en", None), ("en", ""), (None, "  .. ,")]


def found(spark, docs, **kw):
    df = spark.createDataFrame([doc(i, t, lang) for i, (lang, t) in enumerate(docs)], DOCS).repartition(5)
    return sorted(tuple(r) for r in M.mine_phrases(df, **kw).collect())


def test_equals_brute_force(spark):
    docs = talk(1)
    want = plain(docs, 6)
    assert len(want) > 50 and max(len(r[2].split(" ")) for r in want) == 5
    assert found(spark, docs, min_count=6) == want


@pytest.mark.parametrize("head", [0, 15])
def test_phrases_beyond_the_ranked_ones_are_counted_too(spark, head):
    docs = talk(2, 60)
    assert found(spark, docs, min_count=4, head=head) == plain(docs, 4)


def test_colliding_word_hashes_lead_to_another_seed(spark):
    docs = talk(3, 40)
    assert found(spark, docs, min_count=5, bits=12, max_words=3, top=7) == plain(docs, 5, 3, 7)


def test_tiles_count_dense_and_sparse(monkeypatch):
    monkeypatch.setattr(M, "TILE_BITS", 3)
    monkeypatch.setattr(M, "DENSE", 40)
    rng = np.random.default_rng(1)
    x, y = (np.minimum(rng.geometric(0.05, 5000) - 1, 60) for _ in range(2))
    key, count = M.count_tiles(x, y)
    want = Counter(((x << M.ID_BITS) | y).tolist())
    assert dict(zip(key.tolist(), count.tolist(), strict=True)) == want and len(key) == len(want)
    assert [len(a) for a in M.count_tiles(x[:0], y[:0])] == [0, 0]


def test_equal_phrase_hashes_are_kept_apart(monkeypatch):
    monkeypatch.setattr(M, "phrase_hashes", lambda lang, words, size: np.zeros(max(0, len(words) - size + 1), np.uint64))
    level = M.Level(1, np.array([[1, 1], [5, 7]], np.uint64), None)
    got = level.states(np.ones(3, np.uint64), np.array([7, 5, 7], np.uint64), np.arange(3))
    assert got.tolist() == [-2, 0, -2]


def test_products_pass_64_bits(spark):
    p = spark.createDataFrame([("en", [1, 2], "a", 1, 3 * 10**9), ("en", [1, 3], "b", 1, 4 * 10**9), ("en", [1, 2, 3], "a b", 2, 2 * 10**9)],
                              "lang string, words array<bigint>, phrase string, size int, f bigint")
    t = spark.createDataFrame([("en", 10**13 + 7)], "lang string, n bigint")
    got = M.scored(p, t).first()
    assert got["score"] == 1000 * 2 * 10**9 * (10**13 + 7) // (12 * 10**18)


def test_edges(spark, edges, empty):
    got = rows(M.q_op13(spark, edges))
    assert got and {r["lang"] for r in got} == {"en"}  # the very long text alone has phrases of 100
    assert rows(M.q_op13(spark, empty)) == []


def test_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SMALL}/documents.parquet'")
    want = sorted(con.execute(M.SQL_OP13).fetchall())
    assert len(want) > 10 and sorted(tuple(r) for r in M.q_op13(spark, SMALL).collect()) == want
