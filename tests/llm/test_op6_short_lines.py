import random

import pytest
from llm_util import DOCS, doc, folder, prose, rows
from test_op6_lines import edited, lev

from segmint.llm import op6_line_dedup as M


def judged(x):
    return len(x) >= M.MIN_CHARS or any(c.isalnum() for c in x)


def plain_dedup(docs):
    """Texts without the lines that go, by comparing all pairs of lines of
    every length; ids are not null."""
    lines = sorted({x for _, t in docs for x in t.split("\n") if judged(x)})
    parent = {x: x for x in lines}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(lines):
        for b in lines[i + 1 :]:
            most = min(2, max(len(a), len(b)) // 10)
            if abs(len(a) - len(b)) <= most and lev(a, b) <= most:
                parent[find(a)] = find(b)
    seen, out = set(), {}
    for d, t in sorted(docs):
        kept = []
        for x in t.split("\n"):
            if not judged(x) or find(x) not in seen:
                kept.append(x)
            if judged(x):
                seen.add(find(x))
        out[d] = "\n".join(kept)
    return out


@pytest.mark.parametrize("bound", [M.BROADCAST_KEYS, 0])
def test_lines_of_all_lengths_equal_all_pairs(spark, monkeypatch, bound):
    monkeypatch.setattr(M, "BROADCAST_KEYS", bound)
    rng = random.Random(7)
    pool = [prose(i, 8)[: rng.randint(1, 26)] for i in range(60)] + ["", "}", "---", "Les."]
    docs = []
    for i in range(90):
        lines = [rng.choice(pool) for _ in range(rng.randint(1, 8))]
        docs.append((i, "\n".join(edited(rng, x, rng.choice([0, 0, 1, 2])) for x in lines)))
    df = spark.createDataFrame([doc(i, t) for i, t in docs], DOCS)
    got = {r.doc_id: r.text for r in M.dedup_lines(df).select("doc_id", "text").collect()}
    assert got == plain_dedup(docs)


def test_short_lines(spark):
    line = "abcdefghijklmnopqrst"
    texts = ["Les.\nfirst", "Les.\nsecond", "Len.", line, line[:-1], line[1:-1], "a nine ch\n}", "a nine ck\n}", "ten letter", "ten lettes"]
    got = {r["doc_id"]: r["text"] for r in rows(M.q_op6(spark, folder(spark, [doc(i, t) for i, t in enumerate(texts)])))}
    assert got[0] == "Les.\nfirst" and got[1] == "second" and got[2] == "Len."
    assert got[3] == line and got[4] == got[5] == ""  # one and two edits from a line of 20 characters
    assert got[6] == texts[6] and got[7] == texts[7]  # too short for an edit; brackets stay
    assert got[8] == texts[8] and got[9] == ""
