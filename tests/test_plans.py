"""Physical-plan properties the design relies on (checked without running
the full queries where possible)."""

import pytest

from segmint.plans import catalog as C

SF = "/root/testdata/sf0.001"
CHEAP = ["bronze_orders", "silver_typed", "daily_sales", "snapshot_date", "rfmp_metrics", "rfmp_capped",
         "rfmp_gold", "favorite_category", "category_rank", "category_samples", "segment_assign",
         "score_gold", "orders_with_segment", "segment_top_categories", "tokens", "term_frequency",
         "tfidf_terms", "category_terms", "metric_histogram", "segment_bin_counts", "audience_export"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(C.QUERIES))
def test_no_pairwise_joins(spark, key):
    p = plan(C.QUERIES[key](spark, SF))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_favorite_limits_before_shuffle(spark):
    p = plan(C.q_favorite_category(spark, SF))
    assert "WindowGroupLimit" in p


def test_samples_limit_before_shuffle(spark):
    assert "WindowGroupLimit" in plan(C.q_category_samples(spark, SF))


def test_stop_words_are_a_broadcast_anti_join(spark):
    p = plan(C.q_tokens(spark, SF))
    assert "BroadcastHashJoin" in p and "LeftAnti" in p


def test_daily_sales_partial_aggregation_and_pruning(spark):
    df = C.q_daily_sales(spark, SF)
    p = plan(df)
    assert "partial_sum" in p
    # country lookup (customer/nation) is not needed for daily sales: pruned away
    assert "customer.parquet" not in p and "nation.parquet" not in p
    assert "l_shipdate" not in p and "l_discount" not in p


def test_segment_assign_is_an_equi_join_on_cells(spark):
    p = plan(C.q_segment_assign(spark, SF))
    assert "BroadcastHashJoin" in p


def test_null_customers_are_salted_in_one_pass(spark):
    p = plan(C.q_orders_with_segment(spark, SF))
    assert "xxhash64" in p and "Union" not in p


def test_left_lookup_null_rows(spark):
    from segmint.functions.joins import left_lookup
    left = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("b", 4)], "k string, v int")
    right = spark.createDataFrame([("a", 10)], "k string, w int")
    got = sorted(left_lookup(left, right, "k").collect(), key=lambda r: r.v)
    assert [(r.k, r.v, r.w) for r in got] == [(None, 1, None), (None, 2, None), ("a", 3, 10), ("b", 4, None)]


def test_lines_are_not_shuffled_for_what_their_order_has(spark):
    import re
    off = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in off}
    for k in off:
        spark.conf.set(k, "-1")
    try:
        lines = plan(C.q_orders_with_segment(spark, SF)).splitlines()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    depth = [len(re.match(r"[\s:|+*-]*", x)[0]) for x in lines]
    scans = [i for i, x in enumerate(lines) if "lineitem.parquet" in x and "Scan" in x]
    assert scans
    for i in scans:
        above, at = [], depth[i]
        for k in range(i, -1, -1):
            if depth[k] < at:
                at = depth[k]
                above.append(lines[k])
        # by order and by product: country and segment join the orders
        assert sum("Exchange hashpartitioning" in x for x in above) == 2
