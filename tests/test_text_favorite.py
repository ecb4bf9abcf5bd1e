from decimal import Decimal

from segmint.operators import categorize as cat
from segmint.operators.favorite import category_rank, favorite_category
from segmint.schemas import GOLD


def test_whitespace_and_stop_words(spark):
    df = spark.createDataFrame([(1, " A  b\tC "), (2, "the red box")], "id int, t string")
    got = {r.id: r.words for r in cat.tokens(df, "id", "t", remove_stop=False).collect()}
    assert got[1] == ["a", "b", "c"]
    kept = {r.id: r.words for r in cat.tokens(df, "id", "t", keep_empty=True, remove_stop=False).collect()}
    assert kept[1] == ["", "a", "", "b", "c", ""]
    sw = {r.id: r.words for r in cat.tokens(df, "id", "t").collect()}
    assert sw[2] == ["red", "box"]
    rows = sorted((r.id, r.pos, r.token) for r in cat.token_rows(df, "id", "t").collect())
    assert rows == [(1, 3, "b"), (1, 4, "c"), (2, 1, "red"), (2, 2, "box")]  # "a" is a stop word


def test_rare_term_gets_zero_idf(spark):
    docs = spark.createDataFrame([(1, "red box"), (2, "red cup"), (3, "")], "id int, t string")
    t = {(r.id, r.token): r for r in cat.tfidf_terms(docs, cat.token_rows(docs, "id", "t"), "id").collect()}
    assert t[(1, "box")].idf == 0.0
    import math
    assert abs(t[(1, "red")].idf - math.log(4 / 3)) < 1e-9


def test_favorite_tie_break(spark):
    rows = [("a", 1, "x", 5, 3, 10.0, 0, 0, 0), ("a", 2, "y", 5, 3, 10.0, 0, 0, 0),
            ("a", 3, "z", 1, 3, 10.0, 0, 0, 0), ("b", None, None, 1, 1, 1.0, 0, 0, 0),
            ("b", 0, "w", 1, 1, 1.0, 0, 0, 0)]
    g = spark.createDataFrame(rows, GOLD)
    fav = {r.CustomerID: r.FavoriteCategoryID for r in favorite_category(g).collect()}
    assert fav == {"a": 3, "b": 0}
    assert category_rank(g).where("rn = 1").count() == 2


def test_favorite_plan_limits_before_shuffle(spark):
    rows = [("a", 1, "x", 5, 3, 10.0, 0, 0, 0)]
    plan = favorite_category(spark.createDataFrame(rows, GOLD))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_pipeline_pieces_join(spark):
    bronze = spark.createDataFrame(
        [("1", "s", "red box", 1, None, 1.0, "a", "X", Decimal("1.00")),
         ("2", "s", None, 1, None, 1.0, "a", "X", Decimal("1.00"))],
        "InvoiceNo string, StockCode string, Description string, Quantity long, InvoiceDate timestamp_ntz, "
        "UnitPrice double, CustomerID string, Country string, SalesAmount decimal(18,2)")
    categorized = spark.createDataFrame([("red box", 0)], "Description string, ProductCategoryID int")
    labels = spark.createDataFrame([(0, "boxes")], "ProductCategoryID int, ProductCategoryName string")
    s = {r.InvoiceNo: (r.ProductCategoryID, r.ProductCategoryName)
         for r in cat.attach_category(bronze, categorized, labels).collect()}
    assert s == {"1": (0, "boxes"), "2": (None, None)}


def test_tfidf_does_not_sort_terms_or_shuffle_tokens(spark):
    off = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in off}
    rows = [(1, "red fish red"), (2, "blue fish"), (2, "blue blue"), (None, "red"), (None, "red"), (3, None)]
    docs = spark.createDataFrame(rows, "id int, t string")

    def terms(most):
        dealt = cat.dealt_by_id(docs, "id", most)
        tok = cat.token_rows(dealt, "id", "t")
        return cat.term_frequency(tok, "id"), cat.tfidf_terms(dealt, tok, "id")

    for k in off:
        spark.conf.set(k, "-1")
    try:
        (tf, near), (_, spread) = terms(2), terms(1)
        p, q = (x._jdf.queryExecution().executedPlan().toString() for x in (tf, near))
        got = [sorted(map(str, x.collect())) for x in (near, spread)]
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "ShuffledHashJoin" in q and "SortMergeJoin" not in q
    assert "hashpartitioning(id" in p and ", token" not in "".join(x for x in p.splitlines() if "Exchange" in x)
    assert got[0] == got[1] and len(got[0]) == 5
    assert {(r.id, r.token): r.tf for r in near.collect()} == {
        (1, "red"): 2, (1, "fish"): 1, (2, "blue"): 3, (2, "fish"): 1, (None, "red"): 2}
