"""Reproducible samples of an exact size.

A row's place in a sample is decided by the md5 of seed and key, so the same rows are chosen
whatever the partitioning, file order or number of executors, and a smaller sample with the
same seed is a prefix of a larger one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Samples up to this size end in one task.
ONE_TASK_ROWS = 50_000
#: The last slot is looked at row by row when it has at most so many.
SLOT_ROWS = 10_000
_HASH = "_sample_hash"
_SLOT_DIGITS = 4  # hex digits of the hash that make a slot: 65,536 slots


def sample_hash(seed: int, *keys: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[k.cast("string") for k in keys]))


def _last_slot(df: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """One row: the hash slot in which the n-th row lies.

    Reads only the key.  A map task sends at most one count per slot, and the running total is
    over at most 65,536 rows.
    """
    slot = F.substring(sample_hash(seed, F.col(key)), 1, _SLOT_DIGITS)
    counts = df.select(slot.alias("slot")).groupBy("slot").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(W.orderBy("slot")) - F.col("n")
    reached = counts.withColumn("before", before).where(F.col("before") < n)
    return reached.agg(F.max("slot").alias("last"))


def _cut(df: DataFrame, n: int, seed: int, key: str) -> tuple[str, object, int] | None:
    """Hash and key of the n-th row in sample order, and how many rows up to it share both; None if there are no more than n.

    Reads only the key.  Rows are counted by the first digits of their hash, then those in the slot of the n-th
    row by the next digits, until the slot is small.
    """
    keys = df.select(F.col(key).alias("key")).withColumn(_HASH, sample_hash(seed, F.col("key")))
    prefix, left = "", n  # the n-th row of the table is the left-th of those whose hash starts with the prefix
    while len(prefix) < 32:
        digits = len(prefix) + _SLOT_DIGITS
        inside = keys.where(F.col(_HASH).startswith(prefix)) if prefix else keys
        counts = inside.groupBy(F.substring(_HASH, 1, digits).alias("slot")).agg(F.count(F.lit(1)).alias("n"))
        up_to = F.sum("n").over(W.orderBy("slot"))  # over 65,536 rows at most
        row = counts.withColumn("up_to", up_to).where(F.col("up_to") >= left).orderBy("slot").first()
        if row is None:
            return None
        prefix, left = row["slot"], left - (row["up_to"] - row["n"])
        if row["n"] <= SLOT_ROWS:
            break
    inside = keys.where(F.col(_HASH).startswith(prefix)).groupBy(_HASH, "key").agg(F.count(F.lit(1)).alias("n"))
    for row in inside.orderBy(_HASH, "key").collect():
        if row["n"] >= left:
            return row[_HASH], row["key"], left
        left -= row["n"]
    raise AssertionError("the table changed while it was sampled")


def sample_exact(df: DataFrame, n: int, seed: int, key: str, keep_hash: bool = False) -> DataFrame:
    """``min(n, rows)`` rows in sample order.  ``key`` identifies a row.

    A small sample: the slot of the n-th row is located first, from the keys alone.  Rows beyond it are then
    dropped at the scan, so the final top-n sees n rows and one slot more instead of n rows from
    every partition.  A larger one: the hash and key of the n-th row are found exactly, rows beyond it
    are dropped at the scan, and those that are left are sorted by ranges, spread over tasks.
    ``df`` is read more than once: pass a stored table.
    """
    hashed = df.withColumn(_HASH, sample_hash(seed, F.col(key)))
    if n <= ONE_TASK_ROWS:
        last = _last_slot(df, n, seed, key).scalar()
        chosen = hashed.where(F.substring(_HASH, 1, _SLOT_DIGITS) <= last).orderBy(_HASH, key).limit(n)
    else:
        cut = _cut(df, n, seed, key)
        if cut is not None:
            digest, own, n_last = cut
            is_last = (F.col(_HASH) == digest) & F.col(key).eqNullSafe(F.lit(own))
            below = (F.col(_HASH) < digest) | ((F.col(_HASH) == digest) & (F.col(key) < F.lit(own)))
            # rows that share the last key cannot be told apart: as many of them as are left
            hashed = hashed.where(below).unionByName(hashed.where(is_last).limit(n_last))
        chosen = hashed.orderBy(_HASH, key)
    return chosen.withColumnRenamed(_HASH, "sample_hash") if keep_hash else chosen.drop(_HASH)


def sample_per_group(
    df: DataFrame, n: int, seed: int, group: str, key: str, keep_rank: bool = False
) -> DataFrame:
    """``min(n, rows)`` rows of every group, in the order of the same hash.

    The rank filter becomes a group limit before the shuffle: each task sends at most ``n``
    rows per group, so one very large group is no hot spot.
    """
    order = W.partitionBy(group).orderBy(sample_hash(seed, F.col(key)), F.col(key))
    ranked = df.withColumn("sample_rank", F.row_number().over(order))
    chosen = ranked.where(F.col("sample_rank") <= n)
    return chosen if keep_rank else chosen.drop("sample_rank")


def sample_prefix(df: DataFrame, n_done: int, n: int, seed: int, key: str) -> DataFrame:
    """The first ``n_done`` rows of the sample of size ``n``."""
    return sample_exact(df, min(n_done, n), seed, key)
