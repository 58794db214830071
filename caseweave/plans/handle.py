"""A message in, a decision out: classify, retrieve, draft, decide."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseweave import fixed
from caseweave.functions.decision import decide_escalation
from caseweave.functions.prompts import reply_prompt
from caseweave.functions.text import strip
from caseweave.operators.classify import classify
from caseweave.operators.providers import Provider, extractive_provider, rule_provider
from caseweave.operators.retrieval import (
    MAX_BROADCAST_BYTES, BroadcastIndex, retrieve_similar, top_similarity,
)

RESULT_COLUMNS = [
    "message_id", "message", "intent", "confidence", "drafted_reply", "decision",
    "decision_reason", "top_similarity",
]


def draft_reply(
    df: DataFrame,
    message: str = "message",
    provider: Provider | None = None,
    brand: str = fixed.DEFAULT_BRAND,
) -> DataFrame:
    """``df`` (with ``intent`` and ``retrieved``) with ``drafted_reply``."""
    provider = provider or extractive_provider()
    prompt = reply_prompt(F.col(message), F.col("intent"), F.col("retrieved"), brand)
    drafted = provider(df.withColumn("prompt", prompt))
    return drafted.withColumn("drafted_reply", strip(F.col("raw_response"))).select(
        *df.columns, "drafted_reply"
    )


def handle_messages(
    messages: DataFrame,
    index: DataFrame | BroadcastIndex,
    classifier: Provider | None = None,
    drafter: Provider | None = None,
    k: int = fixed.RETRIEVED_PER_MESSAGE,
    exclude_self: bool = False,
    brand: str = fixed.DEFAULT_BRAND,
    intents: dict[str, dict] = fixed.INTENTS,
    keep: list[str] | None = None,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Intent, drafted reply and decision for every message.

    ``messages`` has ``message_id``, ``message`` and ``embedding``.  With an index of the usual,
    bounded size the whole plan is one map-only stage.  ``exclude_self`` keeps a message that is
    itself in the index from being its own precedent.  ``keep`` names further columns of
    ``messages`` to carry along.
    """
    keep = keep or []
    classifier = classifier or rule_provider("message")
    labelled = classify(
        messages.select("message_id", "message", "embedding", *keep),
        "message", classifier, intents,
    )
    found = retrieve_similar(
        labelled, index, "message_id", k, exclude_self, max_broadcast_bytes=max_broadcast_bytes
    )
    drafted = draft_reply(found.drop("embedding"), "message", drafter, brand)
    scored = drafted.withColumn("top_similarity", top_similarity(F.col("retrieved")))
    verdict = decide_escalation(F.col("intent"), F.col("confidence"), F.col("top_similarity"))
    return (
        scored.withColumn("_verdict", verdict)
        .withColumns(
            {
                "decision": F.col("_verdict.decision"),
                "decision_reason": F.col("_verdict.reason"),
            }
        )
        .select(*RESULT_COLUMNS, *keep)
    )
