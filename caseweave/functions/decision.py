"""Auto / escalate decision with its reason."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from caseweave import fixed
from caseweave.functions.text import fill


def two_decimals(value: Column) -> Column:
    """Number as text with two decimals; ties are rounded before formatting."""
    return F.format_string("%.2f", F.round(value.cast("double"), 2))


def decide_escalation(
    intent: Column,
    confidence: Column,
    max_similarity: Column,
    escalate: list[str] = fixed.ALWAYS_ESCALATE_INTENTS,
    min_confidence: str = fixed.MIN_CONFIDENCE_FOR_AUTO,
    min_similarity: float = fixed.MIN_SIMILARITY_FOR_AUTO,
    vague_intent: str = fixed.AMBIGUOUS,
) -> Column:
    """``struct<decision, reason>`` of the first rule that applies.

    Sensitive intent, then lack of confidence, then lack of a precedent, else auto.
    """
    similarity = F.coalesce(max_similarity, F.lit(0.0))

    def outcome(decision: str, reason: Column) -> Column:
        return F.struct(F.lit(decision).alias("decision"), reason.alias("reason"))

    sensitive = F.when(intent == vague_intent, F.lit(fixed.REASON_VAGUE)).otherwise(
        fill(fixed.REASON_SENSITIVE, {"intent": intent})
    )
    unsure = fill(
        fixed.REASON_CONFIDENCE, {"confidence": F.coalesce(confidence, F.lit("None"))}
    )
    novel = fill(fixed.REASON_NOVEL, {"similarity": two_decimals(similarity)})
    return (
        F.when(intent.isin(escalate), outcome("escalate", sensitive))
        .when(~confidence.eqNullSafe(min_confidence), outcome("escalate", unsure))
        .when(similarity < min_similarity, outcome("escalate", novel))
        .otherwise(outcome("auto", F.lit(fixed.REASON_AUTO)))
    )
