"""Raw messages to a table of clean pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseweave import fixed
from caseweave.operators.filters import drop_short
from caseweave.operators.pairs import (
    PARENT_ORDER, add_clean, filter_brand_replies, keep_first, reconstruct_pairs,
)
from caseweave.operators.sampling import sample_exact
from caseweave.session import store_stage


def _distinct_pairs(tweets: DataFrame, brand: str, order: list[str]) -> DataFrame:
    pairs = reconstruct_pairs(tweets, filter_brand_replies(tweets, brand), order)
    kept = drop_short(add_clean(pairs, "customer_msg"))
    return keep_first(kept, ["customer_msg_clean"], [F.col("brand_tweet_id").asc()])


def clean_pairs(
    tweets: DataFrame, brand: str = fixed.DEFAULT_BRAND, order: list[str] = PARENT_ORDER
) -> DataFrame:
    """All clean, distinct pairs of a brand; the first reply of each customer message text.

    Replies are cleaned last, when only the rows that stay are left.
    """
    return add_clean(_distinct_pairs(tweets, brand, order), "brand_reply")


def prepare_pairs(
    tweets: DataFrame,
    brand: str = fixed.DEFAULT_BRAND,
    sample_size: int = fixed.PAIR_SAMPLE_SIZE,
    seed: int = fixed.PAIR_SEED,
    order: list[str] = PARENT_ORDER,
) -> DataFrame:
    """A sample of the clean pairs.

    The sample reads its input twice, so the pairs are stored once in between.
    """
    pairs = store_stage(_distinct_pairs(tweets, brand, order), "pairs")
    return add_clean(sample_exact(pairs, sample_size, seed, "brand_tweet_id"), "brand_reply")
