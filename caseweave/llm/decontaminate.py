"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are the benchmark's windows of ``WINDOW`` consecutive words, and whole items that are
shorter. A table gives, for every block of up to three words, how far the search may jump: a block that
ends no pattern prefix lets it pass over the whole pattern length less the block. Where the jump is zero,
the block is the last one of some patterns; those are compared with the text. Patterns of one length share
a table, so short items don't shorten the jumps of the others.

The benchmark is searched in blocks of bounded size (``BLOCK_BYTES`` of words each), one after another: a block is one
pass over the documents, its patterns are sent out for that pass and then taken back; with several, documents get a row
number first and the hits of all passes are merged by it. Nothing else of the benchmark leaves its executors.

Defined cases: a null or empty text has no words and no hits; an item without words is no pattern; items are
told apart by item_id as text, so repeated rows of one id count once, and a null id is shown as ``null`` and is one
item with the id ``null``; rows of
documents that repeat are judged one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseweave.llm.common import stored, union_all
from caseweave.llm.words import WORD_BYTES

WINDOW = 10
BLOCK_WORDS = 3
BLOCK_BYTES = 2 << 20
SEGMENT_WORDS = 10_000

_TABLE = bytes(int(b) or 32 for b in WORD_BYTES)


def words(text: str | bytes | None) -> list[bytes]:
    if not text:
        return []
    return (text.encode() if isinstance(text, str) else text).translate(_TABLE).split()


class Patterns:
    """Jump table and suffix buckets for patterns of one length."""

    def __init__(self, size: int):
        self.size, self.block = size, min(BLOCK_WORDS, size)
        self.jump: dict[tuple, int] = {}
        self.buckets: dict[tuple, dict[tuple, set[str]]] = {}

    def add(self, pattern: tuple, item: str) -> None:
        b, m = self.block, self.size
        for end in range(b, m + 1):
            block = pattern[end - b : end]
            self.jump[block] = min(self.jump.get(block, m - b + 1), m - end)
        self.buckets.setdefault(pattern[m - b :], {}).setdefault(pattern, set()).add(item)

    def search(self, text: list[bytes]) -> Iterator[tuple[int, int, set[str]]]:
        """(first word, word after the last, items) of every occurrence, in order."""
        m, b, jump, far = self.size, self.block, self.jump.get, self.size - self.block + 1
        end, n = m, len(text)
        while end <= n:
            block = tuple(text[end - b : end])
            step = jump(block, far)
            if step:
                end += step
                continue
            items = self.buckets[block].get(tuple(text[end - m : end]))
            if items:
                yield end - m, end, items
            end += 1


def compile_patterns(rows: list[tuple[str, bytes]], window: int) -> list[Patterns]:
    """Tables, one per pattern length, from (item, words joined by a space)."""
    sizes: dict[int, Patterns] = {}
    same: dict[bytes, bytes] = {}
    for item, joined in rows:
        text = [same.setdefault(w, w) for w in joined.split(b" ")]
        size = min(window, len(text))
        table = sizes.setdefault(size, Patterns(size))
        for i in range(len(text) - size + 1):
            table.add(tuple(text[i : i + size]), item)
    return list(sizes.values())


def _segments(window: int):
    """Items as runs of words; long items are cut so that every window lies in one run."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                w = words(text)
                for i in range(0, max(1, len(w) - window + 1) if w else 0, SEGMENT_WORDS):
                    out.append((item, b" ".join(w[i : i + SEGMENT_WORDS + window - 1])))
            yield pa.record_batch(
                {"item": pa.array([x[0] for x in out], pa.string()), "words": pa.array([x[1] for x in out], pa.binary())}
            )

    return cut


def _merge(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


def _scan(rows, window: int):
    """For each document: key, n_words, merged hit ranges and items. ``rows`` is a broadcast."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = compile_patterns(rows.value, window)
        for batch in batches:
            column = batch.column(1)
            n_words, spans, items = [], [], []
            for value in column:
                text = words(value.as_py())
                found, names = [], set()
                for table in tables:
                    for a, b, hit in table.search(text):
                        found.append((a, b))
                        names |= hit
                n_words.append(len(text))
                spans.append([{"first": a, "last": b} for a, b in _merge(found)])
                items.append(sorted(names))
            kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
            yield pa.record_batch(
                {
                    "key": batch.column(0),
                    "n_words": np.array(n_words, np.int64),
                    "spans": pa.array(spans, kind),
                    "items": pa.array(items, pa.list_(pa.string())),
                }
            )

    return scan


_FOUND = "n_words long, spans array<struct<first: long, last: long>>, items array<string>"


def _join_spans(spans):
    """Union of ranges: sort, then extend the last range or start a new one."""
    ordered = F.array_sort(F.flatten(spans))
    empty = F.expr("cast(array() as array<struct<first: long, last: long>>)")

    def step(done, x):
        last = F.element_at(done, -1)
        longer = F.concat(
            F.slice(done, 1, F.size(done) - 1),
            F.array(F.struct(last["first"].alias("first"), F.greatest(last["last"], x["last"]).alias("last"))),
        )
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["last"] >= x["first"]), longer).otherwise(
            F.concat(done, F.array(x))
        )

    return F.aggregate(ordered, empty, step)


def _blocks(docs: DataFrame, benchmark: DataFrame, window: int, block_bytes: int) -> list:
    """The benchmark's words in blocks of bounded size: functions that broadcast one block each."""
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")), F.col("text").cast("string"))
    segments = stored(items.mapInArrow(_segments(window), "item string, words binary"), "patterns")
    total = segments.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))

    def block(i: int):
        rows = segments if n == 1 else segments.where(F.pmod(F.xxhash64("item", "words"), F.lit(n)) == i)
        return spark.sparkContext.broadcast([(r["item"], bytes(r["words"])) for r in rows.collect()])

    return [lambda i=i: block(i) for i in range(n)]


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES, key: str = "doc_id"
) -> DataFrame:
    """One row per document: key, n_words, spans (word ranges that are hit), items (ids, sorted)."""
    blocks = _blocks(docs, benchmark, window, block_bytes)
    kind = docs.schema[key].dataType.simpleString()

    texts = docs.select(F.col(key).alias("key"), F.col("text").cast("string").alias("text"))
    if len(blocks) == 1:
        return texts.mapInArrow(_scan(blocks[0](), window), f"key {kind}, {_FOUND}").withColumnRenamed("key", key)
    spark = docs.sparkSession
    numbered = stored(texts.withColumn("row", F.monotonically_increasing_id()), "documents")
    passes = []
    for block in blocks:  # the patterns of one block are held at a time
        rows = block()
        found = numbered.select("row", "text").mapInArrow(_scan(rows, window), f"key long, {_FOUND}")
        passes.append(stored(found.where(F.size("spans") > 0).select(F.col("key").alias("row"), "spans", "items"), "hits"))
        rows.destroy()
    hits = (
        union_all(passes)
        .groupBy("row")
        .agg(
            _join_spans(F.collect_list("spans")).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        )
    )
    counted = numbered.select("row", F.col("text")).mapInArrow(
        _scan(spark.sparkContext.broadcast([]), window), f"key long, {_FOUND}"
    ).select(F.col("key").alias("row"), "n_words")
    none = F.expr("cast(array() as array<struct<first: long, last: long>>)")
    return (
        numbered.select("row", F.col("key").alias(key))
        .join(counted, "row")
        .join(hits, "row", "left")
        .select(
            key,
            "n_words",
            F.coalesce("spans", none).alias("spans"),
            F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"),
        )
    )


def judge(found: DataFrame) -> DataFrame:
    """Counts and digest of ``find_contamination``'s rows."""
    return found.withColumns(
        {
            "n_hit": F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"]),
            "n_items": F.size("items").cast("long"),
            "items_sha256": F.sha2(F.array_join("items", ","), 256),
            "contaminated": F.size("spans") > 0,
        }
    )


def _clean(rows, window: int, at: int):
    """Passes on the rows whose text, column ``at``, holds no pattern."""

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = compile_patterns(rows.value, window)
        for batch in batches:
            keep = []
            for value in batch.column(at):
                text = words(value.as_py())
                keep.append(not any(next(table.search(text), None) for table in tables))
            yield batch.filter(pa.array(keep, pa.bool_()))

    return clean


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The documents in which no benchmark window occurs, with all their columns; no join, one pass per block."""
    at = docs.columns.index("text")
    kept = docs
    blocks = _blocks(docs, benchmark, window, block_bytes)
    for i, block in enumerate(blocks):
        rows = block()
        kept = kept.mapInArrow(_clean(rows, window, at), docs.schema)
        if i < len(blocks) - 1:  # the tables of one block are held at a time
            kept = stored(kept, "kept")
            rows.destroy()
    return kept
