"""Analytics of customer-support messages on Spark DataFrames.

The most used operators are importable from here; every module documents its own.
"""

from caseweave.functions.decision import decide_escalation
from caseweave.functions.keywords import add_keyword_intent, rule_decision
from caseweave.functions.text import clean_text, word_count
from caseweave.operators.classify import classify, classify_batch
from caseweave.operators.clustering import nearest_per_cluster, run_clustering
from caseweave.operators.embedding import embed, embed_with, fit_embedder
from caseweave.operators.labelling import (
    attach_suggestions, bucket_members, bulk_finalize, golden_candidates, split_valid,
)
from caseweave.operators.metrics import (
    accuracy, confusion, disagreements, label_agreement, mean_scores, rater_agreement,
    score_distribution,
)
from caseweave.operators.pairs import (
    filter_brand_replies, keep_first, reconstruct_pairs, stage_counts,
)
from caseweave.operators.patches import Patch, apply_patches, patch_residual, review_queue
from caseweave.operators.providers import (
    extractive_provider, function_provider, nearest_example_provider, rule_batch_provider,
    rule_provider,
)
from caseweave.operators.retrieval import (
    broadcast_index, build_index, retrieve_similar, sample_index, top_k_similar,
)
from caseweave.operators.sampling import sample_exact, sample_per_group, sample_prefix
from caseweave.plans.discover import discover_intents
from caseweave.plans.evaluate import (
    evaluation_results, judge_replies, pair_labels, pair_scores,
)
from caseweave.plans.handle import draft_reply, handle_messages
from caseweave.plans.prepare import clean_pairs, prepare_pairs
from caseweave.session import build_session, store_stage
from caseweave.sources.incremental import pending, record_labels, run_resumable
from caseweave.sources.tables import append, overwrite, read_table, read_tweets_csv
from caseweave.streaming.messages import decide_stream, decided

__all__ = [name for name, value in list(globals().items()) if callable(value)]
