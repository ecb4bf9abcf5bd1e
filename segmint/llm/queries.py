"""Registered queries of this subpackage and the SQL of those that SQL can
express on whole tables."""

from __future__ import annotations

from . import op1_decontamination as op1
from . import op2_toxicity as op2
from . import op3_language_id as op3
from . import op4_quality_rules as op4
from . import op5_pii as op5
from . import op6_line_dedup as op6
from . import op7_warc as op7
from . import op8_sentencepiece as op8
from . import op9_quality_classifier as op9
from . import op10_simhash as op10
from . import op11_substring_dedup as op11
from . import op12_fill_in_middle as op12
from . import op13_phrases as op13

QUERIES = {
    "op1_decontamination": op1.q_op1,
    "op2_toxicity": op2.q_op2,
    "op3_language_id": op3.q_op3,
    "op4_quality_rules": op4.q_op4,
    "op5_pii": op5.q_op5,
    "op6_line_dedup": op6.q_op6,
    "op7_warc": op7.q_op7,
    "op8_sentencepiece": op8.q_op8,
    "op9_quality_classifier": op9.q_op9,
    "op10_simhash": op10.q_op10,
    "op11_substring_dedup": op11.q_op11,
    "op12_fill_in_middle": op12.q_op12,
    "op13_phrases": op13.q_op13,
}

ORACLE_SQL = {
    "op4_quality_rules": op4.SQL_OP4,
    "op7_warc": op7.SQL_OP7,
    "op11_substring_dedup": op11.SQL_OP11,
    "op12_fill_in_middle": op12.SQL_OP12,
    "op13_phrases": op13.SQL_OP13,
}
