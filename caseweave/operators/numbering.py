"""Row numbers inside groups, without a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caseweave.session import store_stage

_ROW_BITS = 33  # of monotonically_increasing_id: the partition's number is above, the row's place below


def number_rows(df: DataFrame, group: str, order: str, out: str = "number") -> DataFrame:
    """``df`` with each row's place, from 0, among the rows of its group in the order of a column.

    Rows are dealt out by ranges of (group, order) and sorted there, so every task has its share of the table
    however few groups there are; a place is the row's place in its range, and the rows of the group in the
    ranges before.  Only the totals of each range and group, some numbers a task, are added up.  Rows that tie
    get consecutive places in any order.
    """
    at, part, tie, first, before = "_at", "_part", "_tie", "_first", "_before"
    # read once more when ranges are chosen, so ties are told apart by something that stays: a hash of the row
    columns = [F.col(group).asc_nulls_first(), F.col(order).asc_nulls_first(), F.col(tie)]
    ranged = (
        df.withColumn(tie, F.xxhash64(*df.columns))
        .repartitionByRange(*columns)
        .sortWithinPartitions(*columns)
        .drop(tie)
        .withColumn(at, F.monotonically_increasing_id())
    )
    ranged = store_stage(ranged, "ranges").withColumn(part, F.shiftright(at, _ROW_BITS))
    totals = ranged.groupBy(part, group).agg(F.min(at).alias(first), F.count(F.lit(1)).alias("_n"))
    earlier = W.partitionBy(group).orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    totals = totals.select(
        F.col(part).alias("_p"), F.col(group).alias("_g"), first,
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias(before),
    )
    # a range holds few groups or a group few ranges: as many rows as partitions and groups together
    same = (F.col(part) == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g"))
    return ranged.join(totals, same).select(*df.columns, (F.col(at) - F.col(first) + F.col(before)).alias(out))
