"""Corpus pipeline: documents that are good, free of repeated lines, of near
copies and of benchmark passages, encoded and decoded. Each stage works on all
its predecessor kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from segmint.llm.op1_decontamination import decontamination_stage
from segmint.llm.op6_line_dedup import line_stage
from segmint.llm.op8_sentencepiece import tokenize_stage
from segmint.llm.op9_quality_classifier import quality_stage
from segmint.llm.op10_simhash import simhash_stage
from segmint.session import materialize

STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("SimHash near-dedup", simhash_stage),
    ("benchmark decontamination", decontamination_stage),
    ("SentencePiece encoding and decoding", tokenize_stage),
]

#: Fitted classifiers, edit links and components are beyond SQL; the tests hold
#: the rows against a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The stages applied to ``documents``, each written as Parquet to the
    shared folder and read again as the next one's docs."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{k}")
    return docs
