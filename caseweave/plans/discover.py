"""Discovery of an intent taxonomy: sample, embed, cluster, typical messages."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from caseweave import fixed
from caseweave.operators.clustering import (
    TOLERANCE, cluster_sizes, model_centres, nearest_per_cluster, run_clustering,
)
from caseweave.operators.embedding import embed, fit_embedder
from caseweave.operators.sampling import sample_exact
from caseweave.session import store_stage


@dataclass
class Discovery:
    assigned: DataFrame  # rows with embedding and cluster
    sizes: DataFrame  # cluster, n_rows
    examples: DataFrame  # cluster, key, distance, rank, text


def discover_intents(
    pairs: DataFrame,
    key: str = "brand_tweet_id",
    text: str = "customer_msg_clean",
    n: int = fixed.DISCOVERY_SAMPLE_SIZE,
    n_clusters: int = fixed.N_CLUSTERS,
    seed: int = fixed.DISCOVERY_SEED,
    n_starts: int = fixed.N_CLUSTER_STARTS,
    n_examples: int = fixed.EXAMPLES_PER_CLUSTER,
    max_iter: int = fixed.MAX_CLUSTER_ITERATIONS,
    tolerance: float = TOLERANCE,
) -> Discovery:
    """Cluster a sample of messages and list the messages nearest to each centre."""
    sample = store_stage(sample_exact(pairs, n, seed, key), "sample")
    embedded = store_stage(embed(sample, text, fit_embedder(sample, text)), "discovery")
    assigned, model = run_clustering(
        embedded, n_clusters, seed, n_starts, max_iter=max_iter, key=key, tolerance=tolerance
    )
    assigned = store_stage(assigned, "assigned")
    nearest = nearest_per_cluster(
        assigned, model_centres(assigned, model), "cluster", key, n_examples
    )
    examples = nearest.join(assigned.select(key, text), key)
    return Discovery(assigned, cluster_sizes(assigned), examples)
