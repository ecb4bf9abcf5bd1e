"""Small inputs for the tests of the llm operators: rows with nulls, empty and
very long texts, repeated rows, and columns whose names the operators use."""

import random
import tempfile

import pytest

SF = "/root/testdata/sf0.001"
DOCS = ("doc_id bigint, text string, lang string, source string, n_chars bigint, score double, words string, "
        "k bigint, line string, hits string, failed string, fp bigint, tails string")
EXTRA = (0.5, "w", 7, "l", "h", "f", 3, "t")
LONG = " ".join(f"word{i % 977} the of\n" if i % 50 == 0 else f"word{i % 977}" for i in range(40_000))


def doc(i, text, lang="en", source="s"):
    return (i, text, lang, source, None if text is None else len(text), *EXTRA)


def edge_docs():
    base = "the quick brown fox jumps over the lazy dog and runs far away from here today"
    return [
        doc(1, base), doc(1, base), doc(2, None), doc(3, ""), doc(4, "  \t\n \n"), doc(5, "word"), doc(6, LONG),
        doc(None, base + " again"), doc(8, base, None, None), doc(9, "12 34 !!"), doc(10, "Ünïcödé Straße für Élan"),
    ]


def folder(spark, docs=None, labels=None, benchmark=None, pages=None):
    """A table folder like the test data's; tables given as lists of rows."""
    d = tempfile.mkdtemp()
    spark.createDataFrame(docs or [], DOCS).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels or [], "doc_id bigint, quality int, toxic int, grade string").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(benchmark or [], "item_id bigint, text string, words string").write.parquet(f"{d}/benchmark.parquet")
    spark.createDataFrame(pages or [], "page_id bigint, url string, html string, digest string").write.parquet(f"{d}/pages.parquet")
    return d


def edge_folder(spark):
    labels = [(1, 1, 0, "g"), (1, 1, 1, None), (5, 0, 0, "g"), (6, 1, 1, "g"), (None, 1, 0, "g"), (8, None, None, "g"),
              (9, 0, None, "g"), (10, 1, 0, "g"), (77, 1, 1, "g")]
    bench = [(1, "the quick brown fox jumps over the lazy dog. And runs far away from here today."), (1, None), (None, ""),
             (2, "word"), (3, "nothing like this anywhere in those texts at all")]
    return folder(spark, edge_docs(), labels, [(*b, "w") for b in bench])


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


@pytest.fixture(scope="session")
def edges(spark):
    return edge_folder(spark)


@pytest.fixture(scope="session")
def empty(spark):
    return folder(spark)


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    voc = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 9))) for _ in range(vocabulary)]
    return " ".join(r.choice(voc) for _ in range(n))
