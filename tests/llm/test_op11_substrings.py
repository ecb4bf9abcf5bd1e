import hashlib
import random
import re

import pytest
from llm_util import DOCS, LONG, SF, doc, prose, rows

from segmint.llm import op11_substring_dedup as M

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(docs, window=M.WINDOW):
    """(words, removed, kept text) of each (id, text), window by window."""
    ws = [WORD.findall(t or "") for _, t in docs]
    key = [M.LAST if i is None else i for i, _ in docs]
    first = {}
    for k, w in zip(key, ws, strict=True):
        for p in range(len(w) - window + 1):
            g = tuple(w[p : p + window])
            first[g] = min(first.get(g, k), k)
    out = []
    for k, w in zip(key, ws, strict=True):
        gone = {q for p in range(len(w) - window + 1) if first[tuple(w[p : p + window])] < k for q in range(p, p + window)}
        out.append((len(w), len(gone), " ".join(x for q, x in enumerate(w) if q not in gone)))
    return out


def sharing(seed, n=60, few=False):
    """Documents that share passages, overlap, branch and repeat themselves."""
    rng = random.Random(seed)
    pool = [prose(seed * 100 + k, rng.randint(5, 60), 12 if few else 400) for k in range(12)]
    docs = []
    for i in rng.sample(range(1000), n):
        parts = []
        for _ in range(rng.randint(0, 5)):
            w = rng.choice(pool).split() if rng.random() < 0.7 else prose(rng.random(), rng.randint(1, 20)).split()
            a = rng.randint(0, len(w) // 3)
            if w and rng.random() < 0.3:
                w[rng.randrange(len(w))] = "changed"
            parts.append(rng.choice([" ", "\n", "  \t"]).join(w[a:]))
        docs.append((i, " ".join(parts)))
    return docs + [docs[0], (docs[1][0], docs[2][1]), (None, docs[3][1]), (None, docs[4][1]), (None, docs[3][1]), (-5, pool[0])]


def found(spark, docs, **kw):
    df = spark.createDataFrame([doc(i, t) for i, t in docs], DOCS)
    got = M.dedup_substrings(df, **kw).select("doc_id", "text", "substrings").collect()
    return sorted((r[0] is None, r[0] or 0, r[1] or "", *r[2]) for r in got)


def expected(docs, **kw):
    return sorted((i is None, i or 0, t or "", *p) for (i, t), p in zip(docs, plain(docs, **kw), strict=True))


@pytest.mark.parametrize("seed,few", [(1, False), (2, True)])
def test_equals_brute_force(spark, seed, few):
    docs = sharing(seed, few=few)
    want = expected(docs)
    assert sum(r[4] for r in want) > 100
    assert found(spark, docs) == want


def test_colliding_hashes_change_nothing(spark):
    docs = sharing(3, 25)
    assert found(spark, docs, bits=3) == expected(docs)


def test_other_sizes(spark):
    docs = sharing(4, 30)
    assert found(spark, docs, window=5, anchor=3) == expected(docs, window=5)


def test_one_passage_in_every_document(spark):
    p = prose(9, 40)
    docs = [(i, f"{prose(i + 50, i % 9)} {p} {prose(i + 500, 8)}") for i in range(300)] + [(None, p)] * 50
    got = found(spark, docs)
    assert got == expected(docs)
    assert sum(r[4] == 0 for r in got) == 1


def test_anchors_cover_every_window():
    import numpy as np
    words = M.word_hashes(*(lambda b: (np.frombuffer(b, np.uint8), *M.word_places(
        np.frombuffer(b, np.uint8), np.array([0, len(b)]), M.blank_mask(M.BLANKS))[:2]))(LONG[:20000].encode()))
    owner, start, count, a = M.anchor_runs(words, np.array([0, len(words)]))
    assert count.sum() == len(words) - M.WINDOW + 1 and count.max() <= M.WINDOW - M.ANCHOR + 1
    assert (start[1:] == start[:-1] + count[:-1]).all() and start[0] == 0


def test_blocks_of_texts(monkeypatch):
    import numpy as np
    import pyarrow as pa
    from segmint.llm import wordscan as W
    texts = ["", None, "a b", " c ", "dd  ee", "", "é\x1cx y", "tail"] * 5
    want = [len(WORD.findall(t or "")) for t in texts]
    whole = None
    for chunk in (1, 3, 1 << 20):
        monkeypatch.setattr(W, "CHUNK", chunk)
        counts, hashes = [], []
        for lo, hi, data, offsets in W.text_blocks(pa.array(texts), chunk):
            s, e, first = W.word_places(data, offsets, W.blank_mask(W.BLANKS))
            counts += np.diff(first).tolist()
            hashes += W.word_hashes(data, s, e).tolist()
        assert counts == want
        whole = whole or hashes
        assert hashes == whole
    assert len(set(whole)) == len({w for t in texts for w in WORD.findall(t or "")})


def test_edges(spark, edges, empty):
    got = rows(M.q_op11(spark, edges))
    assert len(got) == 11
    by = {r["doc_id"]: r for r in got}
    none = hashlib.sha256(b"").hexdigest()
    for i in (2, 3, 4):
        assert (by[i]["n_words"], by[i]["n_removed"], by[i]["kept_sha256"]) == (0, 0, none)
    assert by[1]["n_removed"] == 0 and by[8]["n_removed"] == by[8]["n_words"] == 16
    assert by[None]["n_removed"] == 16 and by[None]["n_words"] == 17
    assert by[6]["n_removed"] == 0 and rows(M.q_op11(spark, empty)) == []


def test_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = sorted(con.execute(M.SQL_OP11).fetchall())
    got = sorted(tuple(r) for r in M.q_op11(spark, SF).select("doc_id", "n_words", "n_removed", "kept_sha256").collect())
    assert got == want and sum(r[2] for r in want) > 0
