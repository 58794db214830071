"""Rebuild (customer message, brand reply) pairs from a flat message table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caseweave import fixed
from caseweave.functions.text import clean_text, long_enough
from caseweave.operators.lookup import HOT_KEY_ROWS, lookup_join

# Order in which rows that share a tweet id are considered.  Rows that are equal in all of these
# give the same pair.
PARENT_ORDER = ["created_at", "text", "inbound"]

REPLY_STATUSES = ["no_pointer", "parent_absent", "parent_not_inbound", "pair"]


def filter_brand_replies(tweets: DataFrame, brand: str = fixed.DEFAULT_BRAND) -> DataFrame:
    """Rows written by the brand itself."""
    return tweets.where((F.col("author_id") == brand) & ~F.col("inbound"))


def _with_parent(
    tweets: DataFrame, replies: DataFrame, how: str, order: list[str], hot_key_rows: int
) -> DataFrame:
    renamed = {"tweet_id": "parent_id", "inbound": "parent_inbound", "text": "parent_text"}
    extra = {c: f"_order_{c}" for c in order if c not in renamed}
    parents = tweets.select(*[F.col(c).alias(n) for c, n in {**renamed, **extra}.items()])
    joined = lookup_join(
        replies.select("tweet_id", "text", "created_at", "in_response_to_tweet_id"),
        parents,
        fact_key="in_response_to_tweet_id",
        dim_key="parent_id",
        spread_by="tweet_id",
        how=how,
        first_by=[F.col({**renamed, **extra}[c]).asc_nulls_last() for c in order],
        hot_key_rows=hot_key_rows,
    )
    return joined.drop(*extra.values())


def reconstruct_pairs(
    tweets: DataFrame,
    replies: DataFrame,
    order: list[str] = PARENT_ORDER,
    hot_key_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """Pairs of a reply and the inbound message it answers.

    Replies without a pointer, with an unknown parent or with a parent that is not inbound are
    dropped.  If several rows carry the parent's id, the first in ``order`` is the parent, and
    only then is it tested for being inbound.
    """
    found = _with_parent(tweets, replies, "inner", order, hot_key_rows)
    return found.where(F.col("parent_inbound")).select(
        F.col("parent_id").alias("thread_id"),
        F.col("parent_text").alias("customer_msg"),
        F.col("text").alias("brand_reply"),
        F.col("parent_id").alias("customer_tweet_id"),
        F.col("tweet_id").alias("brand_tweet_id"),
        F.col("created_at").alias("timestamp"),
    )


def reply_outcomes(
    tweets: DataFrame,
    replies: DataFrame,
    order: list[str] = PARENT_ORDER,
    hot_key_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """Every reply with what became of it: one of :data:`REPLY_STATUSES`."""
    found = _with_parent(tweets, replies, "left", order, hot_key_rows)
    status = (
        F.when(F.col("in_response_to_tweet_id").isNull(), "no_pointer")
        .when(F.col("parent_id").isNull(), "parent_absent")
        .when(~F.col("parent_inbound"), "parent_not_inbound")
        .otherwise("pair")
    )
    return found.select(
        F.col("tweet_id").alias("brand_tweet_id"),
        F.col("parent_text").alias("customer_msg"),
        status.alias("status"),
    )


def add_clean(df: DataFrame, *texts: str) -> DataFrame:
    """``<text>_clean`` beside each of the text columns."""
    return df.withColumns({f"{text}_clean": clean_text(F.col(text)) for text in texts})


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    ``row_number() = 1`` becomes a group limit before and after the shuffle, so each map task
    sends at most one row per key however many copies there are.
    """
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def stage_counts(
    tweets: DataFrame,
    brand: str = fixed.DEFAULT_BRAND,
    sample_size: int = fixed.PAIR_SAMPLE_SIZE,
    order: list[str] = PARENT_ORDER,
) -> DataFrame:
    """Row counts of the preparation stages as ``(stage, n_rows)``, from a single pass."""
    outcomes = reply_outcomes(tweets, filter_brand_replies(tweets, brand), order)
    is_pair = F.col("status") == "pair"
    cleaned = F.when(is_pair, clean_text(F.col("customer_msg")))
    kept = F.when(long_enough(F.col("cleaned")), F.col("cleaned"))
    counts = (
        outcomes.select("status", cleaned.alias("cleaned"))
        .withColumn("kept", kept)
        .agg(
            F.count(F.lit(1)).alias("replies"),
            *[
                F.count(F.when(F.col("status") == s, 1)).alias(s)
                for s in REPLY_STATUSES[:-1]
            ],
            F.count(F.when(is_pair, 1)).alias("pairs"),
            F.count("kept").alias("long_enough"),
            F.count_distinct("kept").alias("distinct_messages"),
        )
        .withColumn("sampled", F.least(F.col("distinct_messages"), F.lit(sample_size)))
    )
    return counts.unpivot([], counts.columns, "stage", "n_rows")
