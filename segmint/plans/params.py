"""Parameters of the registered test-data queries.

The reference values are 30 / 2500 for the caps; on the test tables those
would flatten the monetary bins (nearly every group spends more than 2500),
so the registered queries use caps that act on this data (see SURVEY 7.3).
"""

FREQ_CAP = 8
MONETARY_CAP = 120000.0
N_BINS = 5
SEGMENTS_K = 8
MAX_K = 20
RESTARTS = 10_000
SEED = 42
PRODUCT_K = 10
NUM_FEATURES = 4096
PCA_K = 50
HIST_BINS = 10
TOP_CATEGORIES = 3
SAMPLES_PER_CATEGORY = 10
PREVIEW_ROWS = 10
LOOKUP_CUSTOMER = "42"
SAMPLE_FRACTION = 0.1
STREAM_WATERMARK = "2 days"
ARRIVALS = 3

# The model of our own seeded fit (k = 6, 10,000 restarts, seed
# 42) on the sf0.001 tables, centroids rounded to two decimals, with canonical
# ids (cluster id, r, f, m in bin units). Scoring queries use it so that SQL can
# check them; no grid cell is equidistant from two of its centroids.
FIXED_CENTROIDS = [
    (0, 3.61, 3.71, 2.86),
    (1, 1.29, 3.62, 2.57),
    (2, 2.79, 1.11, 3.05),
    (3, 3.0, 3.34, 0.48),
    (4, 0.33, 0.62, 3.48),
    (5, 0.81, 1.56, 0.66),
]

# Display names of the fixed model's segments (stand-ins for user labels).
FIXED_SEGMENT_NAMES = {c[0]: f"segment {c[0]}" for c in FIXED_CENTROIDS}

# Stored centres of the assignment query: a rule over 8 hashed buckets.
STORED_CENTRES = [[(5 * c + 3 * b) % 4 for b in range(8)] for c in range(5)]
