"""Work that can be interrupted and resumed, by key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseweave.operators.labelling import split_valid
from caseweave.session import scratch_path, store_stage
from caseweave.sources.commits import Transaction, read_log

_PART, _RANK = "_part", "_rank"


def pending(source: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows of ``source`` whose key is not done yet.  Rows without a key can never be done; none are."""
    return source.where(F.col(key).isNotNull()).join(done.select(key), key, "left_anti")


def table_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def read_done(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What earlier runs have committed; an empty table if there was none."""
    return read_log(spark, path, schema)


def record_labels(
    labels: DataFrame, path: str, key: str, allowed: dict[str, list]
) -> DataFrame:
    """Append labels made by hand: valid values only, and no row that is labelled already.

    The rows are committed together; if someone else records one of the keys meanwhile, none are
    (:class:`~caseweave.sources.commits.CommitConflict`).
    A row without a key is rejected, and of several rows with one key all but the first in the
    order of all their columns.  Returns the rejected rows with the columns that are not valid.
    """
    valid, rejected = split_valid(labels, allowed)
    order = W.partitionBy(key).orderBy(*[F.col(c) for c in labels.columns])
    ranked = valid.withColumn(_RANK, F.row_number().over(order))
    usable = F.col(key).isNotNull() & (F.col(_RANK) == 1)
    table = Transaction(labels.sparkSession, path, labels.schema, key)
    ranked = store_stage(ranked, "labels")  # before the table that it is compared with changes
    table.append(pending(ranked.where(usable).drop(_RANK), table.read(), key))
    repeated = ranked.where(~usable).drop(_RANK)
    return rejected.unionByName(repeated.withColumn("invalid_columns", F.array(F.lit(key))))


def run_resumable(
    source: DataFrame,
    path: str,
    key: str,
    process: Callable[[DataFrame], DataFrame],
    schema: T.StructType,
    n_parts: int = 1,
) -> DataFrame:
    """Process the rows not yet in ``path`` and append them, in ``n_parts`` separate commits.

    An interrupted run loses at most the part it was writing, of which nothing is seen, and a new run
    processes only the keys that are missing.  A run that finds that another one has committed some of its
    keys stops (:class:`~caseweave.sources.commits.CommitConflict`); no row is written twice.  With several parts
    the pending rows are stored once, by part, so that every part reads only its own rows.  ``schema`` is
    that of the result and contains the key.
    """
    spark = source.sparkSession
    table = Transaction(spark, path, schema, key)
    todo = pending(source, table.read(), key)
    if n_parts == 1:
        table.append(process(todo))
        return table.read()

    staged = scratch_path(spark, "pending")
    slices = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // n_parts)
    part = F.pmod(F.xxhash64(key), F.lit(n_parts)).cast("int")
    slice_ = F.pmod(F.xxhash64(key, F.lit(1)), F.lit(slices))
    todo.withColumn(_PART, part).repartition(_PART, slice_).write.partitionBy(_PART).parquet(staged)
    rows = spark.read.schema(T.StructType(todo.schema.fields)).option("basePath", staged)
    for number in range(n_parts):
        folder = f"{staged}/{_PART}={number}"
        if table_exists(spark, folder):
            table.append(process(rows.parquet(folder)))
    return table.read()
