"""A caller's column that has the name of an output is replaced; all others,
whatever their names, keep their values."""

import pytest
from llm_util import DOCS, doc, rows
from pyspark.sql import functions as F

from segmint.llm import op2_toxicity, op3_language_id, op8_sentencepiece, op9_quality_classifier
from segmint.llm.op1_decontamination import contamination
from segmint.llm.op5_pii import find_spans
from segmint.llm.op6_line_dedup import dedup_lines

MODEL = "/opt/tokenizers/" + op8_sentencepiece.PRODUCTION_MODEL
CASES = {
    "toxicity": lambda d: op2_toxicity.score(d, op2_toxicity.ToxicityModel({}, 0.0, 0.0)),
    "language": lambda d: op3_language_id.detect(d, op3_language_id.LanguageModel([], None, None, 1.0, 0.0)),
    "found": lambda d: find_spans(d, []),
    "tails": lambda d: op9_quality_classifier.graded(d, None),
    "pieces": lambda d: op8_sentencepiece.encode_decode(d, MODEL),
    "dedup": dedup_lines,
    "hits": lambda d: contamination(d, d.sparkSession.createDataFrame([(1, "a b c d e f g h i j")], "item_id bigint, text string")),
}


@pytest.mark.parametrize("name", CASES)
def test_only_the_output_is_replaced(spark, name):
    docs = spark.createDataFrame([doc(1, "call +1 234 567 8901 now"), doc(2, None), doc(None, "a")], DOCS)
    others = [c for c in CASES if c != name] + ["n", "th", "s", "words_", "row", "p"]
    docs = docs.withColumns({c: F.lit(f"own {c}") for c in [*others, name] if c not in docs.columns or c == name})
    before = {c for c in docs.columns if c != name}
    got = CASES[name](docs)
    assert sorted(got.columns) == sorted(docs.columns)
    key = lambda r: str(r["doc_id"])
    for a, b in zip(sorted(rows(got), key=key), sorted(rows(docs), key=key), strict=True):
        assert {c: a[c] for c in before} == {c: b[c] for c in before}
        assert a[name] != f"own {name}"
