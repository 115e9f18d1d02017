"""basketmine: market-basket segmentation and promotion mining on Spark DataFrames.

Baskets are encoded as the set of catalogue categories they touch, grouped by a
must-link-constrained Jaccard k-means (one customer, one cluster), compared with
the Adjusted Rand Index, and mined for frequent category sets and association
rules inside the cluster of each incoming basket.  Every step is a DataFrame
plan; Catalyst, AQE and MLlib do the execution.
"""

from basketmine.functions.catalog import explode_paths
from basketmine.operators.ckmeans import ConstrainedKMeans, ConstrainedKMeansModel
from basketmine.operators.encode import encode_baskets, to_vectors, vocabulary
from basketmine.operators.metrics import adjusted_rand_index, ari_table
from basketmine.operators.mining import mine_clusters
from basketmine.operators.selection import select_k_constrained, select_k_kmeans
from basketmine.plans.promote import promote, promote_from_text, train_and_promote
from basketmine.session import build_session, ensure_checkpoint_dir
from basketmine.sources.text import incoming_baskets, read_basket_lines, read_catalog

__all__ = [
    "ConstrainedKMeans", "ConstrainedKMeansModel", "adjusted_rand_index", "ari_table", "build_session",
    "encode_baskets", "ensure_checkpoint_dir", "explode_paths", "incoming_baskets", "mine_clusters", "promote",
    "promote_from_text", "read_basket_lines", "read_catalog", "select_k_constrained", "select_k_kmeans",
    "to_vectors", "train_and_promote", "vocabulary",
]
