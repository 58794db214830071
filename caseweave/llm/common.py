"""Helpers that several corpus operators share."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseweave.session import ship_package, store_stage

#: Text bytes that a vectorised step handles at once; a longer single text is one step.
STEP_BYTES = 1 << 20
#: Rows of an Arrow batch in jobs that the operators run themselves.
BATCH_ROWS = 500


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A given table. Tasks of these operators import this library, so it is sent to them first."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names near ``names`` that ``df`` doesn't use, whatever its letter case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> Iterator[None]:
    """Arrow batches of few rows while a job runs: a row may hold a long text or a large set."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back; later jobs start from the files."""
    with small_batches(df.sparkSession):
        return store_stage(df, name)


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a column ``name`` that identifies each row and stays the same when it is read again.

    For a plain scan of Parquet files that is the file and the row's place in it; anything else is
    written to the shared folder with a row number first.
    """
    if "_metadata" not in df.columns:
        with contextlib.suppress(AnalysisException):
            place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
            return df.select("*", place.alias(name))
    return stored(df.withColumn(name, F.monotonically_increasing_id()), "rows")


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its row offsets; null counts as empty."""
    column = pc.fill_null(column, "").cast(pa.large_utf8())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def steps(batch: pa.RecordBatch, text: str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``limit`` bytes of text each, or one row."""
    _, offsets = texts(batch.column(text))
    begin = 0
    while begin < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[begin] + limit, "right")) - 1
        end = min(max(end, begin + 1), batch.num_rows)
        yield batch.slice(begin, end - begin)
        begin = end


def ordered_starts(df: DataFrame, group: list[str], order: list[str], starts: dict[str, str]) -> DataFrame:
    """Add running sums before each row, per ``group`` and in ``order``; ``starts``: new column -> summed one.

    ``df`` should be a stored table. Rows are dealt out by ranges of (group, order), so a group
    that holds most rows is split over many tasks; sums per range are small and give each range
    its start. Rows that tie in ``order`` get consecutive places in any order.
    """
    part, tie, *bases = fresh(df, "range_no", "range_tie", *(f"{c}_base" for c in starts))
    keys = [F.col(c).asc_nulls_first() for c in group + order]
    ranged = stored(
        df.withColumn(tie, F.xxhash64(F.monotonically_increasing_id()))
        .repartitionByRange(*keys, F.col(tie))
        .withColumn(part, F.spark_partition_id()),
        "ranges",
    )
    totals = ranged.groupBy(part, *group).agg(*(F.sum(c).alias(b) for c, b in zip(starts.values(), bases, strict=True)))
    before = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumns({b: F.coalesce(F.sum(b).over(before), F.lit(0)) for b in bases})
    inside = Window.partitionBy(part, *group).orderBy(*keys, tie).rowsBetween(Window.unboundedPreceding, -1)
    left = ranged.withColumns({s: F.coalesce(F.sum(c).over(inside), F.lit(0)) for s, c in starts.items()})
    same = reduce(lambda a, b: a & b, (left[c].eqNullSafe(totals[c]) for c in [part, *group]))
    return left.join(totals, same, "left").select(
        *(left[c] for c in df.columns),
        *((left[s] + totals[b]).cast("long").alias(s) for s, b in zip(starts, bases, strict=True)),
    )
