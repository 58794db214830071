"""Intent classification through a provider, one message or one batch per request."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseweave import fixed
from caseweave.functions.prompts import classify_batch_prompt, classify_prompt
from caseweave.functions.responses import parse_label, parse_label_batch
from caseweave.operators.numbering import number_rows
from caseweave.operators.providers import Provider

#: Buckets that messages are numbered in. A run fixes the number and keeps it: a message's batch then
#: depends on the other members of its bucket only, however large the table is or becomes.
N_BUCKETS = 8


def classify(
    df: DataFrame, text: str, provider: Provider, intents: dict[str, dict] = fixed.INTENTS
) -> DataFrame:
    """``df`` with ``intent`` and ``confidence``; one request per message."""
    asked = provider(df.withColumn("prompt", classify_prompt(F.col(text), intents)))
    label = parse_label(F.col("raw_response"), list(intents))
    return (
        asked.withColumn("_label", label)
        .withColumns({"intent": F.col("_label.intent"), "confidence": F.col("_label.confidence")})
        .select(*df.columns, "intent", "confidence")
    )


def message_batches(
    df: DataFrame,
    key: str,
    text: str,
    batch_size: int = fixed.LABEL_BATCH_SIZE,
    n_buckets: int = N_BUCKETS,
    intents: dict[str, dict] = fixed.INTENTS,
) -> DataFrame:
    """Batches of messages with their prompt: ``(bucket, batch, items, prompt)``.

    Messages are numbered inside ``n_buckets`` hash buckets, by key.  The caller fixes their number,
    so another message changes the batches of its own bucket only.  Numbering is distributed
    (:mod:`caseweave.operators.numbering`): a task's share does not depend on the number of buckets.
    ``items`` is an array of ``struct<index, key, message>`` with at most ``batch_size`` members.
    ``key`` identifies a message.
    """
    digits = F.substring(F.md5(F.col(key).cast("string")), 1, 8)
    bucket = F.pmod(F.conv(digits, 16, 10).cast("bigint"), F.lit(n_buckets).cast("bigint"))
    messages = df.select(F.col(key).alias("key"), F.col(text).alias("message"), bucket.alias("bucket"))
    return (
        number_rows(messages, "bucket", "key", "number")
        .withColumn("batch", F.floor(F.col("number") / batch_size))
        .groupBy("bucket", "batch")
        .agg(
            F.array_sort(
                F.collect_list(F.struct(F.pmod("number", F.lit(batch_size)).alias("index"),
                                        "key", "message"))
            ).alias("items")
        )
        .withColumn(
            "prompt",
            classify_batch_prompt(
                F.transform("items", lambda item: F.coalesce(item["message"], F.lit(""))), intents
            ),
        )
    )


def classify_batch(
    df: DataFrame,
    key: str,
    text: str,
    provider: Provider,
    batch_size: int = fixed.LABEL_BATCH_SIZE,
    n_buckets: int = N_BUCKETS,
    intents: dict[str, dict] = fixed.INTENTS,
) -> DataFrame:
    """``(key, intent, confidence)`` per message; one request per batch."""
    asked = provider(message_batches(df, key, text, batch_size, n_buckets, intents))
    labels = parse_label_batch(F.col("raw_response"), F.size("items"), list(intents))
    return (
        asked.select("items", labels.alias("labels"))
        .select(F.explode(F.arrays_zip("items", "labels")).alias("row"))
        .select(
            F.col("row.items.key").alias(key),
            F.col("row.labels.intent").alias("intent"),
            F.col("row.labels.confidence").alias("confidence"),
        )
    )
