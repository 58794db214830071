"""Keyword rules as expressions: classifier, bucket membership, rule-based decision.

``rules`` maps an intent to its keywords; the order of the mapping is the order of the rules.
The functions take text that is lower-cased already, so that a plan lowers each message once
(see :func:`with_lowered`) instead of once per keyword.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseweave import fixed
from caseweave.functions.text import contains_any, is_short

LOWERED = "_lowered"


def with_lowered(df: DataFrame, text: str) -> DataFrame:
    return df.withColumn(LOWERED, F.lower(F.col(text)))


def keyword_intent(
    text: Column,
    lowered: Column,
    rules: dict[str, list[str]] = fixed.KEYWORD_RULES,
    fallback: str = fixed.AMBIGUOUS,
) -> Column:
    """Short messages are ambiguous; else the first rule with a hit; else ambiguous."""
    chain = F.when(text.isNull() | is_short(text), F.lit(fallback))
    for intent, keywords in rules.items():
        if keywords:
            chain = chain.when(contains_any(lowered, keywords), F.lit(intent))
    return chain.otherwise(F.lit(fallback))


def keyword_buckets(
    text: Column,
    lowered: Column,
    rules: dict[str, list[str]] = fixed.KEYWORD_RULES,
    short_bucket: str = fixed.AMBIGUOUS,
) -> Column:
    """Array of all buckets a message belongs to: one per rule with a hit, and the short one."""
    members = [
        F.when(contains_any(lowered, keywords), F.lit(intent))
        for intent, keywords in rules.items()
        if keywords
    ]
    members.append(F.when(is_short(text), F.lit(short_bucket)))
    return F.array_compact(F.array(*members))


def bucket_order(
    bucket: Column,
    rules: dict[str, list[str]] = fixed.KEYWORD_RULES,
    short_bucket: str = fixed.AMBIGUOUS,
) -> Column:
    """Rank of a bucket: rules in order, the short bucket last."""
    names = [intent for intent, keywords in rules.items() if keywords]
    if short_bucket not in names:
        names.append(short_bucket)
    return F.array_position(F.array(*[F.lit(n) for n in names]), bucket).cast("int")


def rule_decision(
    intent: Column, escalate: list[str] = fixed.ALWAYS_ESCALATE_INTENTS
) -> Column:
    """Decision from the intent alone."""
    return F.when(intent.isin(escalate), F.lit("escalate")).otherwise(F.lit("auto"))


def add_keyword_intent(
    df: DataFrame,
    text: str,
    rules: dict[str, list[str]] = fixed.KEYWORD_RULES,
    out: str = "intent",
) -> DataFrame:
    return (
        with_lowered(df, text)
        .withColumn(out, keyword_intent(F.col(text), F.col(LOWERED), rules))
        .drop(LOWERED)
    )
