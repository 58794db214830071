"""Reading and writing tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseweave import fixed, schemas
from caseweave.functions.text import as_boolean
from caseweave.sources import commits
from caseweave.sources.csv_records import CSV, read_csv

MAX_SPREAD_SPLITS = 64  # a few gigabytes at the usual size of a split



def _id(df: DataFrame, name: str) -> Column:
    """Id column; tools that hold nullable ids as floats write ``8.0`` for 8."""
    if isinstance(df.schema[name].dataType, T.IntegralType):
        return F.col(name).cast("bigint").alias(name)
    text = F.col(name).cast("string")
    return text.try_cast("decimal(20,0)").try_cast("bigint").alias(name)


def normalise_tweets(raw: DataFrame) -> DataFrame:
    """The seven message columns with their types, from any table that has them by name."""
    return raw.select(
        _id(raw, "tweet_id"),
        F.col("author_id").cast("string").alias("author_id"),
        as_boolean(F.col("inbound")).alias("inbound"),
        F.col("created_at").cast("string").alias("created_at"),
        F.col("text").cast("string").alias("text"),
        F.col("response_tweet_id").cast("string").alias("response_tweet_id"),
        _id(raw, "in_response_to_tweet_id"),
    )


def read_tweets_csv(
    spark: SparkSession, path: str, multi_line: bool = True, whole_files: bool = False
) -> DataFrame:
    """Raw message export.  Columns are matched by header name; others are not read.

    All files of one export have the same columns in the same order, whatever that order is; a file
    with another header is an error, never misread.  Read exports of different layouts one by one.

    Messages contain line breaks.  Files are cut into splits all the same
    (:mod:`caseweave.sources.csv_records`); a file whose quotes break the rules of CSV is an error then.  With
    ``whole_files`` Spark reads each file in one task and takes stray quotes as they are.  An export without
    line breaks can be read with ``multi_line=False``, in one pass.
    """
    header = spark.read.options(**CSV).csv(path).columns
    missing = [c for c in fixed.RAW_COLUMNS if c not in header]
    if missing:
        raise ValueError(f"{path} lacks the columns {', '.join(missing)}")
    schema = T.StructType([T.StructField(name, T.StringType()) for name in header])
    if multi_line and not whole_files:
        return normalise_tweets(read_csv(spark, path, schema, check_header=True).select(*fixed.RAW_COLUMNS))
    reader = spark.read.schema(schema).options(**CSV, enforceSchema="false")
    return normalise_tweets(reader.option("multiLine", multi_line).csv(path).select(*fixed.RAW_COLUMNS))


def read_table(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet"
) -> DataFrame:
    """Stored table with its declared schema; of a table with a commit log, what is committed."""
    if fmt == "parquet" and commits.has_log(spark, path):
        return commits.read_log(spark, path, schema)
    reader = spark.read.schema(schema)
    if fmt == "csv":
        return read_csv(spark, path, schema)
    return reader.format(fmt).load(path)


def spread_few_splits(df: DataFrame, *key: str) -> DataFrame:
    """Use all cores on a table that comes in fewer splits than there are cores.

    Text work is bound by the processor, and a file with a single row group is a single task.
    Rows are then spread by hash of ``key``, the columns that identify a row.  A table with
    enough splits, or with more than :data:`MAX_SPREAD_SPLITS`, is returned as it is, so nothing is
    shuffled at scale however many cores there are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = df.rdd.getNumPartitions()
    return df.repartition(cores, *key) if splits < min(cores, MAX_SPREAD_SPLITS) else df


def overwrite(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    _writer(df, fmt).mode("overwrite").save(path)


def append(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Add rows to a table; creates it if it does not exist.

    Parquet tables get a commit log (:mod:`caseweave.sources.commits`): readers see all of the rows or none, and
    :func:`read_table` reads what is committed.  Text files have none; a broken write leaves a part of the rows.
    """
    if fmt == "parquet":
        commits.add_rows(df, path)
    else:
        _writer(df, fmt).mode("append").save(path)


def _writer(df: DataFrame, fmt: str):
    writer = df.write.format(fmt)
    return writer.options(**CSV) if fmt == "csv" else writer


def save_vectors(df: DataFrame, path: str) -> None:
    """Store rows with their vectors side by side; the key column links them."""
    overwrite(df, path)


def load_vectors(
    spark: SparkSession, path: str, schema: T.StructType = schemas.VECTORS
) -> DataFrame:
    return read_table(spark, path, schema)
