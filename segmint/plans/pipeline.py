"""End-to-end medallion pipeline: bronze -> silver -> gold -> segments ->
orders_gold, each hand-off a layer of the catalog (staged, then swapped in one step; every
layer is a lineage cut that survives executor loss and can be re-run on its own).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators import categorize as cat
from ..operators import report as rep
from ..operators.binning import fit_edges
from ..operators.cluster import SegmentModel, bin_cells, choose_k, fit_segments, k_sweep
from ..operators.favorite import favorite_category
from ..operators.metrics import cap_metrics, daily_sales, group_totals, rfmp_metrics, snapshot_date, with_recency_sign
from ..sources import model_store
from ..sources.layers import write_layer


@dataclass
class PipelineConfig:
    schema: str = "rfm"
    fmt: str = "parquet"
    num_features: int = 4096
    pca_k: int | None = 50
    product_k: int = 10
    seed: int = 42
    anonymous: str = "keep"
    freq_cap: int | None = 30
    monetary_cap: float | None = 2500.0
    n_bins: int = 5
    k: int | None = 8          # None: choose by the silhouette sweep
    max_k: int = 20
    restarts: int = 10_000
    model_name: str = "rfm_segments"
    recency_sign: int = 1      # -1 stores Recency negated in the gold table


def _save(df: DataFrame, table: str, fmt: str) -> DataFrame:
    return write_layer(df, table, fmt)


def run_pipeline(spark: SparkSession, bronze: DataFrame, cfg: PipelineConfig = PipelineConfig(),
                 labels: DataFrame | None = None, categorized: DataFrame | None = None) -> dict[str, DataFrame]:
    """Run every layer and return the written tables.

    ``categorized`` (Description, ProductCategoryID) skips the text model;
    ``labels`` (ProductCategoryID, ProductCategoryName) names categories
    (default: top tf-idf terms of each category)."""
    s = cfg.schema
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {s}")
    out: dict[str, DataFrame] = {}
    out["orders_bronze"] = bronze = _save(bronze, f"{s}.orders_bronze", cfg.fmt)

    # silver: learned product categories
    docs = cat.description_table(bronze)
    if categorized is None:
        model = cat.fit_categories(bronze, cfg.num_features, cfg.pca_k, cfg.product_k, cfg.seed,
                                   descriptions=docs)
        categorized = cat.categorize(model, bronze, descriptions=docs)
    if labels is None:
        tf = cat.tfidf_terms(docs, cat.token_rows(docs, "Description", "Description"), "Description")
        labels = cat.default_labels(categorized, tf)
    out["orders_silver"] = silver = _save(cat.attach_category(bronze, categorized, labels),
                                          f"{s}.orders_silver", cfg.fmt)

    # gold: metrics, caps, bins (snapshot from the silver table: a 2-column scan)
    as_of = snapshot_date(silver).first()[0]
    metrics = cap_metrics(rfmp_metrics(daily_sales(silver, cfg.anonymous), as_of), cfg.freq_cap, cfg.monetary_cap)
    metrics = _save(metrics, f"{s}.metrics", cfg.fmt)
    gold_binner = fit_edges(metrics, n_bins=cfg.n_bins)
    gold = gold_binner.transform(metrics)
    out["gold"] = _save(with_recency_sign(gold, cfg.recency_sign), f"{s}.gold", cfg.fmt)
    gold = with_recency_sign(out["gold"], cfg.recency_sign)  # back to days for the model

    # segments
    fav = _save(favorite_category(gold), f"{s}.favorites", cfg.fmt)
    k = cfg.k
    if k is None:
        sweep = k_sweep(bin_cells(fav), cfg.n_bins, list(range(2, cfg.max_k + 1)), cfg.restarts, cfg.seed)
        out["k_sweep"] = sweep = _save(sweep, f"{s}.k_sweep", cfg.fmt)
        k = choose_k(sweep)
    seg: SegmentModel = fit_segments(fav, k, cfg.restarts, cfg.seed, cfg.n_bins)
    version = model_store.save_model(spark, s, cfg.model_name, seg, cfg.fmt)
    model_store.promote(spark, s, cfg.model_name, version, cfg.fmt)
    seg = model_store.load_model(spark, s, cfg.model_name)

    assigned = seg.assign(fav)
    levels = rep.label_text(rep.centroid_levels(seg.centroids_frame(spark)))
    out["rfmp_clusters"] = _save(levels, f"{s}.rfmp_clusters", cfg.fmt)
    out["scored_gold"] = _save(seg.score(gold, "Cluster"), f"{s}.scored_gold", cfg.fmt)
    orders = rep.orders_with_segment(silver, assigned)
    names = {int(r["cluster"]): r["label"] for r in out["rfmp_clusters"].collect()}  # k rows
    out["orders_gold"] = _save(rep.map_labels(orders, names), f"{s}.orders_gold", cfg.fmt)
    out["audience"] = _save(rep.audience_export(assigned, out["rfmp_clusters"]), f"{s}.audience", cfg.fmt)
    sales = _save(group_totals(daily_sales(silver, cfg.anonymous)), f"{s}.sales", cfg.fmt)
    out["segment_profile"] = rep.segment_profile(assigned, sales)
    out["segment_top_categories"] = rep.segment_top_categories(assigned, sales)
    return out
