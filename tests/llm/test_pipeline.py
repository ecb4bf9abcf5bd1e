import hashlib

import corpus_pipeline
import pytest
from llm_util import SF, rows
from test_op1_decontamination import plain_hits
from test_op6_lines import judged
from test_op10_simhash import plain_components, plain_fingerprint

from segmint.llm import op6_line_dedup, op8_sentencepiece, op9_quality_classifier
from segmint.llm.queries import ORACLE_SQL, QUERIES


def test_stages_are_the_dealt_ones():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "line dedup", "SimHash near-dedup", "benchmark decontamination", "SentencePiece encoding and decoding"]
    assert corpus_pipeline.ORACLE_SQL is None
    assert {int(k[2:].split("_")[0]) for k in QUERIES} == set(range(1, 14)) and set(ORACLE_SQL) <= set(QUERIES)


def test_run_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    # Quality: the fitted model's decisions (its scoring is tested by itself).
    model = op9_quality_classifier.fit(docs, op9_quality_classifier.grades_of(spark.read.parquet(f"{SF}/labels.parquet")))
    good = [(r.doc_id, r.text) for r in op9_quality_classifier.graded(docs, model).collect()
            if r.tails[0] >= op9_quality_classifier.MIN_TAIL]
    # Lines: equal lines, and those linked by an exact distance.
    lines = sorted({x for _, t in good for x in t.split("\n") if judged(x)})
    df = spark.createDataFrame([(x,) for x in lines], "a string")
    from pyspark.sql import functions as F
    most = F.least(F.lit(op6_line_dedup.EDITS), F.floor(F.greatest(F.length("a"), F.length("b")) / op6_line_dedup.CHARS_PER_EDIT))
    near = df.join(df.withColumnRenamed("a", "b"), (F.col("a") < F.col("b")) & (F.abs(F.length("a") - F.length("b")) <= most)
                   & F.levenshtein("a", "b", 2).between(0, most)).collect()
    parent = {x: x for x in lines}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in near:
        parent[find(r.a)] = find(r.b)
    seen, cleaned = set(), []
    for d, t in sorted(good):
        kept = []
        for x in t.split("\n"):
            if judged(x):
                if find(x) in seen:
                    continue
                seen.add(find(x))
            kept.append(x)
        new = "\n".join(kept)
        if new == t or new.strip(" \t\n\v\f\r"):
            cleaned.append((d, new))
    ids = plain_components([plain_fingerprint(t) for _, t in cleaned], [d for d, _ in cleaned])
    lone = [(d, t) for (d, t), c in zip(cleaned, ids, strict=True) if d == c]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hit = plain_hits(lone, items)
    sp = op8_sentencepiece.processor(op8_sentencepiece.read_model(op8_sentencepiece.production_model()))
    want = []
    for d, t in lone:
        if not hit[d]:
            i = sp.encode(t)
            want.append((d, len(i), hashlib.sha256(",".join(map(str, i)).encode()).hexdigest(),
                         hashlib.sha256(sp.decode(i).encode()).hexdigest()))
    got = sorted((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows(corpus_pipeline.run(spark, SF)))
    assert got == sorted(want) and 100 < len(got) < 200


@pytest.mark.parametrize("which", ["edges", "empty"])
def test_edges(spark, edges, empty, which):
    got = rows(corpus_pipeline.run(spark, edges if which == "edges" else empty))
    assert (len(got) > 0) == (which == "edges")
