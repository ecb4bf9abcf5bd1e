import numpy as np
import pytest
import xxhash
from llm_util import SF, rows
from pyspark.sql import functions as F

from segmint.llm import op10_simhash as M
from segmint.llm.components import connected_components


def plain_fingerprint(text):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in __import__("re").findall(r"[^\x20\x09-\x0D]+", t)]
    if not w:
        return 0
    sh = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps, ids):
    """Smallest id reachable over links of at most 4 bits."""
    f = np.array(fps, np.uint64)
    label = np.arange(len(f))
    near = np.bitwise_count(f[:, None] ^ f[None, :]) <= 4
    left, right = np.nonzero(near)
    label = M._settle(len(f), left, right)
    low = {}
    for i, v in zip(ids, label, strict=True):
        if i is not None:
            low[v] = min(low.get(v, i), i)
    return [low.get(v) for v in label]


def test_golay_tables_are_perfect():
    parity, patterns = M.golay_tables()
    weight = np.bitwise_count(np.maximum(patterns, 0))
    assert sorted(np.unique((patterns >= 0).sum(1)).tolist()) == [1, 6]
    assert ((patterns[:, 0] >= 0) & (weight[:, 0] <= 3)).all()
    words = np.array([m << 11 | parity[m] for m in range(4096)])
    assert np.bitwise_count(words[1:]).min() == 7


def test_linked_pairs_share_a_key():
    rng = np.random.default_rng(0)
    tables = M.golay_tables()
    n = 20_000
    x = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    y = x.copy()
    for k in range(4):  # up to four flips, in one segment or spread
        where = rng.integers(0, 64, n) if k % 2 else rng.integers(0, 23, n) + np.where(rng.random(n) < 0.5, 0, 23)
        y ^= np.where(rng.random(n) < 0.9, np.uint64(1) << where.astype(np.uint64), np.uint64(0))
    kx, rx = M.keys_of(x, tables)
    ky, ry = M.keys_of(y, tables)
    shared = np.intersect1d((rx.astype(object) << 64) + kx, (ry.astype(object) << 64) + ky)
    assert len(set((shared >> 64).tolist())) == n


@pytest.mark.parametrize("block", [2048, 40])
def test_search_equals_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(M, "BLOCK", block)
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 150, dtype=np.uint64)
    near = [base, np.full(400, base[0])]
    for v in (base.copy(), near[1]):
        for _ in range(5):
            v ^= np.uint64(1) << rng.integers(0, 64, len(v)).astype(np.uint64)
        near.append(v)
    fp = np.unique(np.concatenate(near))
    df = spark.createDataFrame([(int(v),) for v in fp.view(np.int64)], "fp bigint")
    got = {r.node: r.root for r in connected_components(M.similar_links(df)).collect()}
    signed = fp.view(np.int64).tolist()
    mine = [got.get(v, v) for v in signed]
    want = plain_components(fp, list(range(len(fp))))
    pairs = set(zip(mine, want, strict=True))
    assert len(pairs) == len(set(mine)) == len(set(want))


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 260)] + [(5, 5)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "x long, y long")).collect()}
    assert all(got[i] == 100 for i in range(100, 141)) and all(got[i] == 7 for i in range(200, 260)) and 5 not in got
    assert connected_components(spark.createDataFrame([], "x long, y long")).count() == 0


@pytest.mark.parametrize("which", ["edges", "sample"])
def test_query_equals_brute_force(spark, edges, which):
    sf = edges if which == "edges" else SF
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    fps = [plain_fingerprint(t) for _, t in docs]
    ids = plain_components(fps, [i for i, _ in docs])
    want = sorted((i or -1, f"{f:016x}", c or -1) for (i, _), f, c in zip(docs, fps, ids, strict=True))
    got = sorted((r["doc_id"] or -1, r["fingerprint"], r["component_id"] or -1) for r in rows(M.q_op10(spark, sf)))
    assert got == want


def test_empty(spark, empty):
    assert rows(M.q_op10(spark, empty)) == []


def test_stage_keeps_one_row_of_each_component(spark, edges):
    docs = spark.read.parquet(f"{edges}/documents.parquet")
    out = M.simhash_stage(spark, docs, edges)
    assert out.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in out.collect()]
    fps = [plain_fingerprint(r.text) for r in docs.collect()]
    assert len(kept) == len(set(plain_components(fps, list(range(len(fps))))))
    assert len({plain_fingerprint(t) for _, t in kept}) == len(kept)
    lone = docs.where("doc_id is null").union(docs.where("doc_id is null"))
    assert M.simhash_stage(spark, lone, edges).count() == 1
    assert M.simhash_stage(spark, docs.limit(0), edges).count() == 0
    assert docs.where(F.col("doc_id") == 1).count() == 2
