"""Conversation turns as a flat message table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseweave.sources.tables import normalise_tweets

TURNS_PER_CONVERSATION = 1_000_000


def tweets_from_turns(turns: DataFrame) -> DataFrame:
    """Each turn as a message that answers the turn before it; user turns are inbound.

    Ids are computed from conversation and turn number, so no ordering of a conversation, and
    no task that holds a whole conversation, is needed.
    """
    tweet_id = F.col("conv_id") * TURNS_PER_CONVERSATION + F.col("turn")
    return normalise_tweets(
        turns.select(
            tweet_id.alias("tweet_id"),
            F.col("role").alias("author_id"),
            F.when(F.col("role") == "user", "True").otherwise("False").alias("inbound"),
            F.concat_ws("-", F.col("conv_id"), F.col("turn")).alias("created_at"),
            "text",
            F.lit(None).cast("string").alias("response_tweet_id"),
            F.when(F.col("turn") > 0, tweet_id - 1).alias("in_response_to_tweet_id"),
        )
    )
