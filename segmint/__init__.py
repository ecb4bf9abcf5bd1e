"""segmint: customer segmentation (RFM + product category) on Spark.

Public API (all DataFrame -> DataFrame unless noted)."""

from .operators.binning import BinnerModel, QuantileBinner, apply_edges, fit_edges, fit_edges_many
from .operators.categorize import (attach_category, categorize, category_terms, default_labels,
                                   distinct_descriptions, fit_categories, term_frequency, tfidf_terms,
                                   token_rows, tokens)
from .operators.cluster import (SegmentModel, assign_segment, bin_cells, choose_k, fit_segments, k_choice,
                                k_sweep, silhouette)
from .operators.favorite import category_rank, category_samples, customer_lookup, favorite_category, preview
from .operators.metrics import cap_metrics, daily_sales, rfmp_metrics, snapshot_date, with_recency_sign
from .operators.quantiles import approx_quantiles, exact_quantiles, exact_quantiles_many
from .operators.report import (audience_export, centroid_levels, customer_sample, k_candidates, label_text,
                               level_counts, map_labels, metric_histogram, orders_with_segment,
                               segment_bin_counts, segment_labels, segment_profile, segment_projection,
                               segment_top_categories)
from .session import checkpoint_dir, get_spark, materialize
from .sources.model_store import latest_model, load_model, promote, save_model
from .sources.transactions import load_transactions, load_typed_silver, read_orders
from .streaming.stream import run_to_completion, stream_daily_sales, stream_score

__all__ = [n for n in dir() if not n.startswith("_")]
