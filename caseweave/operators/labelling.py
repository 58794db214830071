"""Golden set: candidates, suggested labels, finished labels, validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseweave import fixed
from caseweave.functions.keywords import (
    LOWERED, bucket_order, keyword_buckets, rule_decision, with_lowered,
)
from caseweave.functions.text import is_blank
from caseweave.operators.pairs import keep_first
from caseweave.operators.patches import is_flagged
from caseweave.operators.sampling import sample_per_group

CANDIDATE_LABELS = [
    "true_intent", "good_reply_should_include", "escalate_or_auto", "escalate_reason",
]
PRELABELED_COLUMNS = [
    "message_id", "customer_msg_clean", "brand_reply_clean", "candidate_intent_heuristic",
    "suggested_intent", "true_intent", "suggested_escalate_or_auto", "escalate_or_auto",
    "good_reply_should_include", "escalate_reason",
]
GOLDEN_COLUMNS = [
    "message_id", "customer_msg_clean", "brand_reply_clean", "true_intent", "escalate_or_auto",
    "good_reply_should_include", "escalate_reason",
]


def bucket_members(
    df: DataFrame,
    key: str = "message_id",
    text: str = "customer_msg_clean",
    rules: dict[str, list[str]] = fixed.KEYWORD_RULES,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``(key, bucket)``, one row per message and bucket it belongs to, with the columns ``keep``."""
    # exploded in the same expression: from a named array column the optimizer would infer a
    # filter on its size and compute all hits a second time
    buckets = keyword_buckets(F.col(text), F.col(LOWERED), rules)
    columns = list(dict.fromkeys([key, text, *keep]))
    return with_lowered(df.select(*columns), text).select(
        key, *[c for c in keep if c != key], F.explode(buckets).alias("bucket")
    )


def bucket_sizes(members: DataFrame, per_bucket: int = fixed.CANDIDATES_PER_INTENT) -> DataFrame:
    """Messages found and sampled per bucket."""
    return (
        members.groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("n_found"))
        .withColumn("n_sampled", F.least(F.col("n_found"), F.lit(per_bucket)))
    )


def golden_candidates(
    df: DataFrame,
    per_bucket: int = fixed.CANDIDATES_PER_INTENT,
    seed: int = fixed.CANDIDATE_SEED,
    key: str = "message_id",
    text: str = "customer_msg_clean",
    reply: str = "brand_reply_clean",
    rules: dict[str, list[str]] = fixed.KEYWORD_RULES,
    defaults: dict[str, str | None] | None = None,
) -> DataFrame:
    """A sample from every bucket, without repeated messages, with label columns to fill.

    A message sampled for several buckets stays with the first one.  Texts are read and cleaned
    once: they travel with the bucket members, of which each task sends at most ``per_bucket`` per
    bucket.
    """
    members = bucket_members(df, key, text, rules, (text, reply))
    chosen = sample_per_group(members, per_bucket, seed, "bucket", key, keep_rank=True)
    order = [bucket_order(F.col("bucket"), rules).asc(), F.col("sample_rank").asc()]
    rows = keep_first(chosen, [text], order)
    defaults = defaults or {}
    return rows.select(
        F.col(key).alias("message_id"),
        F.col(text).alias("customer_msg_clean"),
        F.col(reply).alias("brand_reply_clean"),
        F.col("bucket").alias("candidate_intent_heuristic"),
        *[F.lit(defaults.get(c)).cast("string").alias(c) for c in CANDIDATE_LABELS],
    )


def attach_suggestions(candidates: DataFrame, labels: DataFrame) -> DataFrame:
    """Candidates with suggested intent and decision; blank where no label was given.

    ``labels`` has ``message_id`` and ``intent``.  Works for a finished and for an interrupted
    labelling run: what is missing stays blank.
    """
    suggested = labels.select(
        "message_id",
        F.col("intent").alias("suggested_intent"),
        rule_decision(F.col("intent")).alias("suggested_escalate_or_auto"),
    )
    joined = candidates.join(suggested, "message_id", "left")
    blank = {
        c: F.coalesce(F.col(c), F.lit(""))
        for c in ("suggested_intent", "suggested_escalate_or_auto")
    }
    return joined.withColumns(blank).select(*PRELABELED_COLUMNS)


def _from_templates(intent: Column, part: int, templates: dict[str, tuple[str, str]]) -> Column:
    chain = F.when(F.lit(False), F.lit(""))
    for name, texts in templates.items():
        chain = chain.when(intent == name, F.lit(texts[part]))
    return chain.otherwise(F.lit(""))


def fill_labels(
    prelabeled: DataFrame, templates: dict[str, tuple[str, str]] = fixed.LABEL_TEMPLATES
) -> DataFrame:
    """Labels from the suggestions, with the note and reason of the intent's template.

    Rows without a suggestion get the safe default and are flagged for review.
    """
    missing = is_blank(F.col("suggested_intent"))
    intent = F.when(missing, fixed.AMBIGUOUS).otherwise(F.col("suggested_intent"))
    decision = F.when(missing, "escalate").otherwise(F.col("suggested_escalate_or_auto"))
    note = F.when(missing, fixed.REVIEW_NOTE).otherwise(_from_templates(intent, 0, templates))
    reason = F.when(missing, fixed.REVIEW_FLAG).otherwise(_from_templates(intent, 1, templates))
    return prelabeled.select(
        "message_id",
        "customer_msg_clean",
        "brand_reply_clean",
        intent.alias("true_intent"),
        decision.alias("escalate_or_auto"),
        note.alias("good_reply_should_include"),
        reason.alias("escalate_reason"),
    )


def bulk_finalize(
    prelabeled: DataFrame,
    done: DataFrame | None = None,
    templates: dict[str, tuple[str, str]] = fixed.LABEL_TEMPLATES,
) -> DataFrame:
    """Hand-made labels as they are, generated labels for every other row."""
    if done is None:
        return fill_labels(prelabeled, templates)
    rest = prelabeled.join(done.select("message_id"), "message_id", "left_anti")
    return done.select(*GOLDEN_COLUMNS).unionByName(fill_labels(rest, templates))


def label_counts(golden: DataFrame) -> DataFrame:
    """Rows in all and rows flagged for review."""
    return golden.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(is_flagged(F.col("escalate_reason")), 1)).alias("n_flagged"),
    )


INTENT_CHECK = {"true_intent": list(fixed.INTENTS)}
DECISION_CHECK = {"escalate_or_auto": fixed.DECISIONS}
RUBRIC_CHECKS = {d: fixed.RUBRIC_SCORES for d in fixed.RUBRIC_DIMENSIONS}


def check_labels(df: DataFrame, allowed: dict[str, list]) -> DataFrame:
    """``df`` with ``invalid_columns``, the columns whose value is not an allowed one."""
    bad = [
        F.when(~F.coalesce(F.col(c).isin(values), F.lit(False)), F.lit(c))
        for c, values in allowed.items()
    ]
    return df.withColumn("invalid_columns", F.array_compact(F.array(*bad)))


def split_valid(df: DataFrame, allowed: dict[str, list]) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and rejected rows with ``invalid_columns``.  Values match exactly."""
    checked = check_labels(df, allowed)
    n_bad = F.size("invalid_columns")
    return checked.where(n_bad == 0).drop("invalid_columns"), checked.where(n_bad > 0)
