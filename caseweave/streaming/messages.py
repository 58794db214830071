"""Decisions for a stream of messages."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from caseweave import schemas
from caseweave.sources.commits import adopt, commit_once, commits, live, read_commits
from caseweave.sources.incremental import read_done

_NEW, _ALONE = "_new", "_alone"


def _with_new_keys(messages: DataFrame, key: str, keep_for: tuple[str, str] | None) -> DataFrame:
    """The messages, and one row more (``_new``) for each key that comes for the first time.

    Only this second branch has state: the keys, and nothing of the rows.
    """
    keyed = messages.where(F.col(key).isNotNull())
    if keep_for:
        keyed = keyed.withWatermark(*keep_for).select(key, keep_for[0]).dropDuplicatesWithinWatermark([key])
    else:
        keyed = keyed.select(key).dropDuplicates([key])
    others = [f for f in messages.schema.fields if f.name != key]
    marks = keyed.select(key, *(F.lit(None).cast(f.dataType).alias(f.name) for f in others), F.lit(True).alias(_NEW))
    return messages.withColumn(_NEW, F.lit(False)).unionByName(marks)


def _to_decide(batch: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Of a micro-batch: for each new key its first row in ``order``, and all rows without a key.

    One pass and one shuffle; rows are reduced to one per key before it.
    """
    names = [c for c in batch.columns if c != _NEW]
    columns = [*order, *(c for c in names if c != key and c not in order)]
    row = F.when(~F.col(_NEW), F.struct(*columns)) if columns else F.lit(None)
    numbered = batch.withColumn(_ALONE, F.when(F.col(key).isNull(), F.monotonically_increasing_id()))
    first = numbered.groupBy(key, _ALONE).agg(F.min(row).alias("_first"), F.max(_NEW).alias(_NEW))
    wanted = first.where(F.col(_NEW) | F.col(key).isNull())
    return wanted.select(key, "_first.*").select(*names) if columns else wanted.select(key)


def decide_stream(
    messages: DataFrame,
    handle: Callable[[DataFrame], DataFrame],
    sink: str,
    checkpoint: str,
    key: str = "message_id",
    schema: T.StructType = schemas.MESSAGE_RESULT,
    trigger: dict | None = None,
    order: list[str] | None = None,
    keep_for: tuple[str, str] | None = None,
) -> StreamingQuery:
    """Run ``handle`` on every micro-batch and add its rows to the table ``sink``.

    Each message is decided once:

    * of rows that share a key in one micro-batch the first in ``order`` (all columns by default) is
      decided, and a key that came in an earlier micro-batch is skipped.  The state is the keys seen so
      far and nothing else of their rows; a micro-batch costs the same however much was decided before.
      With ``keep_for``, an event time column and a delay, a key is forgotten that long after its time;
    * rows without a key cannot be told from each other: all of them are decided;
    * a micro-batch is one commit of the sink (:mod:`caseweave.sources.commits`), named after the query (which keeps
      its id as long as it keeps its checkpoint) and the batch.  A micro-batch that is repeated after a crash
      adds nothing if it was committed, and what a broken write left behind is never read;
    * a stream that is started without its checkpoint on a sink that has decisions skips the keys that
      other queries have committed before it started.  Its rows without a key are decided again.

    ``handle`` maps messages to results with the columns of ``schema``.  For a large state set
    ``spark.sql.streaming.stateStore.providerClass`` to the RocksDB provider.
    """
    spark = messages.sparkSession
    keys = T.StructType([f for f in schema.fields if f.name == key])
    adopt(spark, sink)
    earlier = live(commits(spark, sink))
    query_id: list[str] = []
    started = threading.Event()

    def write(batch: DataFrame, batch_id: int) -> None:
        started.wait()
        todo = _to_decide(batch, key, order or [])
        others = [c for c in earlier if c.source != query_id[0]]
        if others:
            done = read_commits(batch.sparkSession, sink, keys, others)
            todo = todo.join(done.where(F.col(key).isNotNull()), key, "left_anti")
        token = f"{query_id[0]}-{batch_id:012d}"
        if not commit_once(handle(todo).select(*schema.names), sink, token, source=query_id[0]):
            batch.write.format("noop").mode("overwrite").save()  # the state has to take the batch in all the same

    query = (
        _with_new_keys(messages, key, keep_for)
        .writeStream.foreachBatch(write)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
    query_id.append(query.id)
    started.set()
    return query


def decided(
    spark: SparkSession, sink: str, schema: T.StructType = schemas.MESSAGE_RESULT
) -> DataFrame:
    """The decisions made so far."""
    return read_done(spark, sink, schema)
