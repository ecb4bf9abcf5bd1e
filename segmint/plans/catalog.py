"""Registered queries over the test tables: one builder per operator key.

Each builder takes (spark, sf_dir) and returns a DataFrame. Fits (bin edges,
segment models) run eagerly inside the builder, as an Estimator's ``fit``
would; everything data-sized stays a Spark plan.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import categorize as cat
from ..operators import report as rep
from ..operators.binning import fit_edges, fit_edges_many
from ..operators.cluster import SegmentModel, bin_cells, k_choice, k_sweep, fit_segments, \
    silhouette_of_cells
from ..operators.favorite import category_rank, category_samples, customer_lookup, favorite_category, preview
from ..operators.metrics import cap_metrics, daily_sales, group_totals, rfmp_from_totals, rfmp_metrics, snapshot_date
from ..schemas import EVENTS, GROUP_KEYS
from ..session import materialize, shared_path
from ..sources.layers import write_layer
from ..sources.transactions import load_transactions, load_typed_silver, product_types, read_orders_checked, reject_counts
from ..streaming.stream import file_stream, late_rows, run_to_completion, stream_daily_sales, stream_score, \
    stream_score_production, stream_to_end
from . import params as P


# ----------------------------------------------------------------------------
# shared chain
# ----------------------------------------------------------------------------
def silver(spark, sf):
    return load_typed_silver(spark, sf)


def metrics(spark, sf):
    return rfmp_metrics(daily_sales(silver(spark, sf)))


def capped(spark, sf):
    return cap_metrics(metrics(spark, sf), P.FREQ_CAP, P.MONETARY_CAP)


def gold_and_binner(spark, sf, n_bins=P.N_BINS, strategy="quantile"):
    c = capped(spark, sf)
    b = fit_edges(c, n_bins=n_bins, strategy=strategy)
    return b.transform(c), b


def gold(spark, sf):
    return gold_and_binner(spark, sf)[0]


def favorites(spark, sf):
    return favorite_category(gold(spark, sf))


def gold_fav_model(spark, sf, with_sales=False):
    """Gold (bins from edges on all rows), favourites, and the fixed model
    whose edges are re-fitted on the favourites. Favourites are picked by
    R/F/M alone, so they are written once (customer grain), both edge sets are
    fitted in the same passes, and bins are projections. ``with_sales`` adds
    the sales per (customer, category), from the table written for the metrics:
    the order lines are read once."""
    daily = daily_sales(silver(spark, sf))
    if with_sales:
        per = materialize(group_totals(daily), "rfm_partial")
        c = cap_metrics(rfmp_from_totals(per), P.FREQ_CAP, P.MONETARY_CAP)
    else:
        c = capped(spark, sf)
    fav = materialize(favorite_category(c), "favorites")
    gold_b, model_b = fit_edges_many([c, fav], n_bins=P.N_BINS)
    out = gold_b.transform(c), gold_b.transform(fav), SegmentModel(model_b, list(P.FIXED_CENTROIDS))
    return (*out, per) if with_sales else out


def assigned(spark, sf):
    _, fav, model = gold_fav_model(spark, sf)
    return model.assign(fav)


def member_centroids(asg: DataFrame) -> DataFrame:
    """Per segment, the mean bin vector of its members (k-means' update step)."""
    return asg.where(F.col("cluster").isNotNull()).groupBy("cluster").agg(
        F.avg(F.col("r_bin").cast("double")).alias("r"), F.avg(F.col("f_bin").cast("double")).alias("f"),
        F.avg(F.col("m_bin").cast("double")).alias("m"))


# ----------------------------------------------------------------------------
# builders
# ----------------------------------------------------------------------------
def q_bronze_orders(spark, sf):
    return load_transactions(spark, sf)


def q_category_labels(spark, sf):
    return product_types(spark, sf)


def q_silver_typed(spark, sf):
    return silver(spark, sf)


def q_silver_roundtrip(spark, sf):
    """Silver written as a Parquet table under the shared folder, read back."""
    return materialize(silver(spark, sf), "silver_table")


def q_distinct_descriptions(spark, sf):
    return cat.distinct_descriptions(load_transactions(spark, sf))


def q_daily_sales(spark, sf):
    return daily_sales(silver(spark, sf))


def q_snapshot_date(spark, sf):
    return snapshot_date(silver(spark, sf))


def q_rfmp_metrics(spark, sf):
    return metrics(spark, sf)


def q_rfmp_capped(spark, sf):
    return capped(spark, sf)


def q_metric_histogram(spark, sf):
    return rep.metric_histogram(capped(spark, sf), ["Recency", "Frequency", "MonetaryValue"], P.HIST_BINS)


def q_bin_edges(spark, sf):
    return fit_edges(capped(spark, sf), n_bins=P.N_BINS).edges_frame(spark).drop("version")


def q_rfmp_bins(spark, sf):
    g = gold(spark, sf)
    return g.select(*GROUP_KEYS, "r_bin", "f_bin", "m_bin")


def q_rfmp_gold(spark, sf):
    return gold(spark, sf)


def q_rfmp_bins_uniform(spark, sf):
    return gold_and_binner(spark, sf, strategy="uniform")[0]


def q_rfmp_bins_10(spark, sf):
    return gold_and_binner(spark, sf, n_bins=10)[0]


def q_bin_histogram(spark, sf):
    return rep.metric_histogram(gold(spark, sf), ["r_bin", "f_bin", "m_bin"], P.N_BINS)


def q_level_counts(spark, sf):
    return rep.level_counts(gold(spark, sf), ["r_bin", "f_bin", "m_bin"])


def q_customer_lookup(spark, sf):
    return customer_lookup(gold(spark, sf), P.LOOKUP_CUSTOMER)


def q_category_rank(spark, sf):
    return category_rank(gold(spark, sf)).select(*GROUP_KEYS, "Frequency", "rn")


def q_favorite_category(spark, sf):
    return favorites(spark, sf)


def q_gold_preview(spark, sf):
    return preview(gold(spark, sf), GROUP_KEYS, P.PREVIEW_ROWS)


def q_category_samples(spark, sf):
    return category_samples(silver(spark, sf), P.SAMPLES_PER_CATEGORY)


def q_segment_assign(spark, sf):
    return assigned(spark, sf).select("CustomerID", "r_bin", "f_bin", "m_bin", "cluster")


def q_centroid_levels(spark, sf):
    return rep.centroid_levels(member_centroids(assigned(spark, sf)))


def q_segment_labels(spark, sf):
    asg = assigned(spark, sf)
    return rep.segment_labels(asg, member_centroids(asg))


def q_score_gold(spark, sf):
    g, _, model = gold_fav_model(spark, sf)
    return model.score(g, "Cluster")


def q_orders_with_segment(spark, sf):
    """Silver lines with their customer's segment. The segment joins the
    orders: a line is not shuffled for what its order has."""
    asg = assigned(spark, sf)
    return load_typed_silver(spark, sf, per_order=lambda orders: rep.orders_with_segment(orders, asg))


def q_map_labels(spark, sf):
    asg = assigned(spark, sf).select("CustomerID", F.col("cluster").alias("Cluster"))
    return rep.map_labels(asg, P.FIXED_SEGMENT_NAMES)


def q_silhouette_fixed(spark, sf):
    """Mean silhouette of the fixed model's assignment over all customers,
    computed on the weighted cells (rounded to 9 decimals)."""
    return silhouette_of_cells(bin_cells(assigned(spark, sf), extra=["cluster"]))


def q_segment_profile(spark, sf):
    _, fav, model, sales = gold_fav_model(spark, sf, with_sales=True)
    return rep.segment_profile(model.assign(fav), sales)


def q_segment_top_categories(spark, sf):
    _, fav, model, sales = gold_fav_model(spark, sf, with_sales=True)
    return rep.segment_top_categories(model.assign(fav), sales, P.TOP_CATEGORIES)


def q_segment_bin_counts(spark, sf):
    return rep.segment_bin_counts(assigned(spark, sf))


def q_audience_export(spark, sf):
    asg = assigned(spark, sf)
    labels = rep.label_text(rep.centroid_levels(member_centroids(asg)))
    return rep.audience_export(asg, labels)


def q_k_candidates(spark, sf):
    return rep.k_candidates(bin_cells(favorites(spark, sf)), P.MAX_K)


def _documents(spark, sf):
    return spark.read.parquet(os.path.join(sf, "documents.parquet")).select("doc_id", "text")


def q_tokens(spark, sf):
    return cat.token_rows(_documents(spark, sf), "doc_id", "text")


def q_term_frequency(spark, sf):
    return cat.term_frequency(cat.token_rows(_documents(spark, sf), "doc_id", "text"), "doc_id")


def q_tfidf_terms(spark, sf):
    docs = cat.dealt_by_id(_documents(spark, sf), "doc_id")
    return cat.tfidf_terms(docs, cat.token_rows(docs, "doc_id", "text"), "doc_id")


def q_category_terms(spark, sf):
    return cat.category_terms(silver(spark, sf), P.TOP_CATEGORIES)


def _events_stream(spark, sf):
    return file_stream(spark, sf, EVENTS, glob="events.parquet")


def q_stream_daily_sales(spark, sf):
    return run_to_completion(stream_daily_sales(_events_stream(spark, sf), P.STREAM_WATERMARK), "daily")


def q_stream_score(spark, sf):
    """Favourites written as files, read back as a stream, scored."""
    _, fav, model = gold_fav_model(spark, sf)
    src = shared_path(spark, "fav-src")
    fav.drop("r_bin", "f_bin", "m_bin").write.parquet(src)
    stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    return run_to_completion(stream_score(stream, model).select("CustomerID", "r_bin", "f_bin", "m_bin", "cluster"),
                             "score")


def q_stream_late_rows(spark, sf):
    """The events arrive in three files, one behind the other; of each later
    one the rows whose day the watermark has closed."""
    events = spark.read.schema(EVENTS).parquet(os.path.join(sf, "events.parquet"))
    src, base = shared_path(spark, "events-src"), shared_path(spark, "late")
    for k in range(P.ARRIVALS):
        events.where(F.pmod("event_id", F.lit(P.ARRIVALS)) == k).write.mode("append").parquet(src)
        out = late_rows(file_stream(spark, src, EVENTS), "late", P.STREAM_WATERMARK, base=base)
    return out


def q_stream_score_production(spark, sf):
    """Favourites arrive in two files; between them another version goes into
    production. Rows after it carry the new version and its segments."""
    from ..sources import model_store
    _, fav, model = gold_fav_model(spark, sf)
    store, src, sink = (shared_path(spark, n) for n in ("models", "fav-src", "scores"))
    other = SegmentModel(model.binner, [(c + 10, *at) for c, *at in P.FIXED_CENTROIDS])
    plain = fav.drop("r_bin", "f_bin", "m_bin")
    for k, m in enumerate((model, other)):
        version = model_store.save_model(spark, store, "segments", m)
        model_store.promote(spark, store, "segments", version)
        plain.where(F.pmod(F.col("CustomerID").cast("long"), F.lit(2)) == k).write.mode("append").parquet(src)
        stream = file_stream(spark, src, plain.schema)
        out = stream_score_production(stream, store, "segments", sink)
    return out


def q_order_reject_counts(spark, sf):
    """Order lines exported as CSV text, some with a field that cannot be read
    (by order number), read back: how many are rejected, and why."""
    lines = load_transactions(spark, sf).drop("SalesAmount")
    text = lines.select([F.col(c).cast("string").alias(c) for c in lines.columns])
    order = F.col("InvoiceNo").cast("long")
    broken = {"Quantity": (3, "many"), "InvoiceDate": (5, "someday"), "UnitPrice": (8, None)}
    for c, (rest, value) in broken.items():
        text = text.withColumn(c, F.when(order % 101 == rest, F.lit(value)).otherwise(F.col(c)))
    day = F.substring("InvoiceDate", 1, 10)
    text = text.withColumn("InvoiceDate", F.when(F.length("InvoiceDate") >= 10, F.concat(day, F.lit(" 00:00:00"))).otherwise(F.col("InvoiceDate")))
    path = shared_path(spark, "orders-csv")
    text.write.option("header", True).csv(path)
    good, rejects = read_orders_checked(spark, path)
    return reject_counts(rejects).union(good.agg(F.lit("read"), F.count(F.lit(1))))


def q_latest_model(spark, sf):
    """Save the model (two versions), promote the second, load the production
    version back and assign with it: must equal ``segment_assign``."""
    from ..sources import model_store
    _, fav, model = gold_fav_model(spark, sf)
    where = shared_path(spark, "models")
    model_store.save_model(spark, where, "segments", model)
    v2 = model_store.save_model(spark, where, "segments", model)
    model_store.promote(spark, where, "segments", v2)
    loaded = model_store.load_model(spark, where, "segments")
    return loaded.assign(fav).select("CustomerID", "r_bin", "f_bin", "m_bin", "cluster")


# ---- rows-only (no SQL twin) ----------------------------------------------
def q_k_sweep(spark, sf):
    return k_sweep(bin_cells(favorites(spark, sf)), P.N_BINS, list(range(2, P.MAX_K + 1)), P.RESTARTS, P.SEED)


def q_k_choice(spark, sf):
    return k_choice(q_k_sweep(spark, sf))


def q_k_choice_levels(spark, sf):
    """The elbow rule on a sweep that SQL can make too: customers grouped by
    the sum of their bins into k equal ranges, explained variance for score."""
    cells = bin_cells(favorites(spark, sf)).groupBy((F.col("r_bin") + F.col("f_bin") + F.col("m_bin")).alias("total")).agg(
        F.sum("w").alias("w"))
    at = cells.select("total", "w", F.explode(F.sequence(F.lit(2).cast("long"), F.lit(12).cast("long"))).alias("k"))
    g = F.least(F.floor(F.col("total") * F.col("k") / F.lit(13.0)), F.col("k") - 1)
    grp = at.groupBy("k", g.alias("g")).agg(F.sum("w").alias("w"), F.sum(F.col("w") * F.col("total")).alias("t"),
                                            F.sum(F.col("w") * F.col("total") * F.col("total")).alias("t2"))
    within = F.sum(F.col("t2") - F.col("t") * F.col("t") / F.col("w").cast("double"))
    whole = F.sum("t2") - F.sum("t") * F.sum("t") / F.sum("w").cast("double")
    sweep = grp.groupBy("k").agg(F.round(within, 6).alias("inertia"), whole.alias("all"))
    sweep = sweep.select("k", "inertia", F.round(1 - F.col("inertia") / F.col("all"), 6).alias("silhouette"))
    return k_choice(sweep).withColumn("gain", F.round("gain", 6))


def q_segment_model(spark, sf):
    _, fav, fixed = gold_fav_model(spark, sf)
    m = fit_segments(fav, P.SEGMENTS_K, P.RESTARTS, P.SEED, P.N_BINS, binner=fixed.binner)
    return m.centroids_frame(spark)


def q_segment_projection(spark, sf):
    return rep.segment_projection(assigned(spark, sf))


def q_customer_sample(spark, sf):
    return rep.customer_sample(favorites(spark, sf), P.SAMPLE_FRACTION, P.SEED)


def _product_model(spark, sf, pca_k=P.PCA_K):
    bronze = load_transactions(spark, sf)
    descs = cat.description_table(bronze)
    return bronze, descs, cat.fit_categories(bronze, P.NUM_FEATURES, pca_k, P.PRODUCT_K, P.SEED,
                                             descriptions=descs)


def q_category_vectors(spark, sf):
    _, descs, model = _product_model(spark, sf)
    from pyspark.ml.functions import vector_to_array
    return model.reduced(descs).select("Description", vector_to_array("pca_features").alias("pca_features"))


def q_product_categories(spark, sf):
    bronze, descs, model = _product_model(spark, sf)
    return cat.categorize(model, bronze, descriptions=descs)


def q_product_categories_all_rows(spark, sf):
    """Categories of a fit on every line: descriptions weighted by lines."""
    bronze = load_transactions(spark, sf)
    descs = cat.description_table(bronze)
    model = cat.fit_categories(bronze, P.NUM_FEATURES, P.PCA_K, P.PRODUCT_K, P.SEED, dedupe=False)
    return cat.categorize(model, bronze, descriptions=descs)


def q_hashed_tf(spark, sf):
    return cat.hashed_tf(_documents(spark, sf), "doc_id", "text", P.NUM_FEATURES)


def q_category_assign(spark, sf):
    """Every description assigned to the nearest of the stored centres."""
    return cat.assign_stored(cat.distinct_descriptions(load_transactions(spark, sf)), "Description", P.STORED_CENTRES)


def q_product_categories_nopca(spark, sf):
    bronze, descs, model = _product_model(spark, sf, pca_k=None)
    return cat.categorize(model, bronze, descriptions=descs)


def q_silver_orders(spark, sf):
    """Silver from learned categories with generated default labels."""
    bronze, descs, model = _product_model(spark, sf)
    categorized = cat.categorize(model, bronze, descriptions=descs)
    tf = cat.tfidf_terms(descs, cat.token_rows(descs, "Description", "Description"), "Description")
    labels = cat.default_labels(categorized, tf)
    return cat.attach_category(bronze, categorized, labels)


def q_silver_structured(spark, sf):
    """Silver through the path of learned categories (both left joins), with a
    category table taken from the structured product type."""
    types = product_types(spark, sf)
    part = spark.read.parquet(os.path.join(sf, "part.parquet"))
    cats = part.join(types, F.col("p_type") == F.col("ProductCategoryName")).groupBy(
        F.col("p_name").alias("Description")).agg(F.min("ProductCategoryID").alias("ProductCategoryID"))
    return cat.attach_category(load_transactions(spark, sf), cats, types)


def q_silver_catalog(spark, sf):
    """Silver written as a layer of the catalog and read back from it."""
    spark.sql("CREATE SCHEMA IF NOT EXISTS segmint_layers")
    return write_layer(silver(spark, sf), "segmint_layers.silver")


def q_tokens_raw(spark, sf):
    """Reference token mode: every piece of the white-space split, empty ones
    kept."""
    return cat.tokens(_documents(spark, sf), "doc_id", "text", keep_empty=True, remove_stop=False)


def q_stream_daily_all(spark, sf):
    """The stream consolidated to the end: days still open come out as well."""
    return stream_to_end(_events_stream(spark, sf), "daily-all")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}

ROWS_ONLY = {"k_sweep", "k_choice", "segment_model",
             "category_vectors", "product_categories", "product_categories_all_rows", "product_categories_nopca", "silver_orders"}

