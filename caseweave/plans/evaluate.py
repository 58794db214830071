"""Evaluation against baselines, rubric scoring, comparison of raters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseweave import fixed, schemas
from caseweave.functions.keywords import add_keyword_intent, rule_decision
from caseweave.functions.prompts import rubric_prompt
from caseweave.functions.responses import parse_rubric
from caseweave.operators.metrics import majority_labels, same
from caseweave.operators.providers import Provider
from caseweave.operators.sampling import sample_exact


def add_baselines(
    results: DataFrame, golden: DataFrame, rules: dict[str, list[str]] = fixed.KEYWORD_RULES
) -> DataFrame:
    """``results`` with the trivial and the keyword baseline.

    The trivial one predicts the most frequent labels of the whole golden set; they come in as
    a scalar.
    """
    simple = add_keyword_intent(results, "message", rules, out="simple_intent")
    majority = majority_labels(golden, ["true_intent", "escalate_or_auto"]).scalar()
    return simple.withColumns(
        {
            "simple_escalate": rule_decision(F.col("simple_intent")),
            "trivial_intent": majority["true_intent"],
            "trivial_escalate": majority["escalate_or_auto"],
        }
    )


def evaluation_rows(
    golden: DataFrame,
    n: int | None = fixed.EVALUATION_SAMPLE_SIZE,
    seed: int = fixed.EVALUATION_SEED,
) -> DataFrame:
    """Golden rows to evaluate: a sample, or all of them with ``n=None``."""
    sample = golden if n is None else sample_exact(golden, n, seed, "message_id")
    return sample.withColumnsRenamed(
        {"customer_msg_clean": "message", "escalate_or_auto": "true_escalate"}
    )


def evaluation_results(
    golden: DataFrame,
    handle: Callable[[DataFrame], DataFrame],
    n: int | None = fixed.EVALUATION_SAMPLE_SIZE,
    seed: int = fixed.EVALUATION_SEED,
    rules: dict[str, list[str]] = fixed.KEYWORD_RULES,
) -> DataFrame:
    """Evaluated golden rows with the predictions of the full system and of both baselines.

    ``handle`` is ``handle_messages`` with the caller's settings, keeping the columns
    ``true_intent`` and ``true_escalate``; truth and predictions travel together, so nothing has
    to be joined.
    """
    predicted = handle(evaluation_rows(golden, n, seed)).withColumnsRenamed(
        {
            "intent": "pipeline_intent",
            "decision": "pipeline_escalate",
            "drafted_reply": "pipeline_reply",
            "top_similarity": "pipeline_top_similarity",
        }
    )
    return add_baselines(predicted, golden, rules).select(*schemas.EVAL_RESULTS.names)


def judge_replies(results: DataFrame, provider: Provider) -> DataFrame:
    """``results`` (with ``message``, ``pipeline_reply``) with rubric scores per reply."""
    prompt = rubric_prompt(F.col("message"), F.col("pipeline_reply"))
    judged = provider(results.withColumn("prompt", prompt))
    scored = judged.withColumn("_scores", parse_rubric(F.col("raw_response")))
    return scored.select(*results.columns, "_scores.*")


def attach_scores(results: DataFrame, scores: DataFrame, key: str = "message_id") -> DataFrame:
    """Results with scores that were made separately, matched by key."""
    columns = [key, *fixed.RUBRIC_DIMENSIONS, "justification"]
    return results.join(scores.select(*columns), key, "left")


def pair_scores(
    judged: DataFrame,
    human: DataFrame,
    n: int | None = fixed.AGREEMENT_SAMPLE_SIZE,
    seed: int = fixed.AGREEMENT_SEED,
    key: str = "message_id",
) -> DataFrame:
    """Scores of two raters side by side, for a sample (or all, ``n=None``) of the judged rows."""
    sample = judged if n is None else sample_exact(judged, n, seed, key)
    mine = human.select(key, *[F.col(d).alias(f"my_{d}") for d in fixed.RUBRIC_DIMENSIONS])
    scores = []
    for d in fixed.RUBRIC_DIMENSIONS:
        scores += [F.col(d).alias(f"judge_{d}"), F.col(f"my_{d}")]
    return sample.join(mine, key).select(
        key, "message", F.col("pipeline_reply").alias("reply"), *scores
    )


def pair_labels(
    golden: DataFrame,
    human: DataFrame,
    n: int | None = fixed.SPOT_CHECK_SAMPLE_SIZE,
    seed: int = fixed.SPOT_CHECK_SEED,
    key: str = "message_id",
) -> DataFrame:
    """Existing and independent labels side by side with their agreement."""
    sample = golden if n is None else sample_exact(golden, n, seed, key)
    mine = human.select(
        key,
        F.col("true_intent").alias("my_intent"),
        F.col("escalate_or_auto").alias("my_escalate"),
    )
    return sample.join(mine, key).select(
        key,
        F.col("customer_msg_clean").alias("message"),
        F.col("true_intent").alias("existing_intent"),
        "my_intent",
        same(F.col("my_intent"), F.col("true_intent")).alias("intent_agree"),
        F.col("escalate_or_auto").alias("existing_escalate"),
        "my_escalate",
        same(F.col("my_escalate"), F.col("escalate_or_auto")).alias("escalate_agree"),
    )
