"""Filters on derived text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseweave import fixed
from caseweave.functions.text import has_at_most_words, long_enough


def filter_in_place(df: DataFrame, column: str, predicate: Callable[[Column], Column]) -> DataFrame:
    """``df.where(predicate(column))``, with the column evaluated once and before the filter.

    The optimizer moves a plain filter below the projection that computes its column by copying the
    column's expression into the filter.  For a cheap column that is what one wants; cleaned text
    would be computed twice per row, and below a join for rows that never match.  Here the value
    is kept or dropped by exploding an array of none or one, which is never moved, while later
    filters on other columns still pass through and reach the scan.
    """
    kept = F.explode(F.filter(F.array(F.col(column)), predicate)).alias(column)
    return df.select(*(kept if c == column else F.col(f"`{c}`") for c in df.columns))


def drop_short(
    df: DataFrame, text: str = "customer_msg_clean", longer_than: int = fixed.MIN_CLEAN_LENGTH
) -> DataFrame:
    """Rows whose text is longer than ``longer_than`` characters."""
    return filter_in_place(df, text, lambda value: long_enough(value, longer_than))


def only_short(
    df: DataFrame, text: str = "customer_msg_clean", limit: int = fixed.SHORT_MESSAGE_WORDS
) -> DataFrame:
    """Rows whose text has at most ``limit`` words."""
    return filter_in_place(df, text, lambda value: has_at_most_words(value, limit))
