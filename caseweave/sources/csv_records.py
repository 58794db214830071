"""CSV files with line breaks inside quotes, read by many tasks.

A line of a CSV file starts a record only if an even number of quotes comes before it in the file. So a file can be
cut anywhere at a line break, as long as the number of quotes before each cut is known:

1. Spark reads the files as text, in splits; the quotes of each split are counted, and their parity is added up along
   each file (exclusive or over the splits before).
2. Each task then knows whether its split begins inside a record, and joins lines into records. The lines before
   its first record and after its last whole one are *fragments*, two for each split at most; those of
   neighbouring splits are put together, and are as many as there are splits, however large the files.
3. Records are parsed by Spark's own CSV parser, one by one.

What is sent to the tasks is 17 bytes a split. A file that breaks the rule is an error and never misread: an odd
number of quotes in the whole file, or a quote inside a field that doesn't begin with one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseweave.session import store_stage

CSV = {"header": "true", "quote": '"', "escape": '"'}

_RECORD, _HEADER, _HEAD, _TAIL, _HEADER_TAIL = range(5)
#: A well-formed record; repeats are possessive, so that the check takes linear time.
_WELL_FORMED = r'(?s)\A(?:"(?:[^"]|"")*+"|[^",]*+)(?:,(?:"(?:[^"]|"")*+"|[^",]*+))*+\z'


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, value): the lines of each split in their order, without their line breaks."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value"
    )


@dataclass
class _Splits:
    """For each split, by (file, start): whether it begins inside a record."""

    file: np.ndarray
    start: np.ndarray
    inside: np.ndarray

    def begins_inside(self, file: int, start: int) -> bool:
        low, high = np.searchsorted(self.file, file, "left"), np.searchsorted(self.file, file, "right")
        at = low + np.searchsorted(self.start[low:high], start)
        if at == high or self.start[at] != start:
            raise ValueError("the files are cut differently than in the first pass; set spark.sql.files.minPartitionNum")
        return bool(self.inside[at])


def _find_splits(lines: DataFrame) -> _Splits:
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    odd = (F.sum(quotes.cast("long")) % 2).cast("int")
    before = W.partitionBy("file").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    counted = lines.groupBy("file", "start").agg(odd.alias("odd"))  # one row per split
    placed = counted.select(
        "file", "start", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("inside"),
        (F.sum("odd").over(W.partitionBy("file")) % 2).alias("open"),
    )
    table = store_stage(placed, "splits").orderBy("file", "start").toArrow()
    if pc.any(pc.equal(table.column("open"), 1)).as_py():
        raise ValueError("a file has an odd number of quotes; read it with whole_files=True")
    return _Splits(*(table.column(c).to_numpy() for c in ("file", "start", "inside")))


def _join_lines(splits, wanted: tuple[int, ...]):
    """Lines of a task's splits as records and fragments: file, start, kind, text."""

    def rows(file: int, start: int, kinds, texts: pa.Array) -> pa.RecordBatch:
        keep = np.flatnonzero(np.isin(kinds, wanted))
        return pa.record_batch(
            {
                "file": np.full(len(keep), file, np.int64),
                "start": np.full(len(keep), start, np.int64),
                "kind": np.asarray(kinds, np.int32)[keep],
                "text": texts.take(pa.array(keep)),
            }
        )

    def joined(lines: pa.Array, first: np.ndarray) -> pa.Array:
        """One string for each run of lines that starts at ``first``."""
        ends = pa.array(np.append(first, len(lines)), pa.int32())
        return pc.binary_join(pa.ListArray.from_arrays(ends, lines), "\n")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = start = None
        held: list[pa.Array] = []  # lines of the open record, or of the head fragment
        inside = head = fresh = False

        def close() -> pa.RecordBatch:
            whole = pa.concat_arrays(held)
            return rows(file, start, [_HEAD if head else _HEADER_TAIL if fresh else _TAIL], joined(whole, np.array([0])))

        for batch in batches:
            files, starts = (batch.column(c).to_numpy() for c in ("file", "start"))
            cut = np.flatnonzero((files[1:] != files[:-1]) | (starts[1:] != starts[:-1])) + 1
            for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(files)], strict=True):
                if a == b:
                    continue
                if (files[a], starts[a]) != (file, start):
                    if held:
                        yield close()
                    file, start, held = int(files[a]), int(starts[a]), []
                    inside = head = splits.value.begins_inside(file, start)
                    fresh = start == 0
                lines = batch.column("value").slice(a, b - a)
                odd = pc.count_substring(lines, '"').to_numpy().astype(np.int64) & 1
                after = (np.cumsum(odd) + inside) & 1  # whether a record is open after the line
                ends = np.flatnonzero(after == 0)
                inside = bool(after[-1])
                if not len(ends):
                    held.append(lines)
                    continue
                whole = pa.concat_arrays([*held, lines.slice(0, ends[-1] + 1)])
                skipped = sum(map(len, held))
                found = joined(whole, np.concatenate([[0], skipped + ends[:-1] + 1]))
                kinds = np.full(len(ends), _RECORD)
                if head:
                    kinds[0], head = _HEAD, False
                if fresh:  # the first line that isn't blank
                    shown = np.flatnonzero(pc.not_equal(pc.utf8_rtrim(found, "\r"), "").to_numpy(zero_copy_only=False))
                    kinds[shown[:1]], fresh = _HEADER, not len(shown)
                yield rows(file, start, kinds, found)
                rest = lines.slice(ends[-1] + 1)
                held = [rest] if len(rest) else []
        if held:
            yield close()

    return join


_JOINED = "file long, start long, kind int, text string"


def _mended(fragments: DataFrame) -> DataFrame:
    """Records that cross splits, from their fragments: a tail, whole splits inside the record, a head."""
    order = W.partitionBy("file").orderBy("start", "kind")
    number = F.sum((F.col("kind") != _HEAD).cast("int")).over(order.rowsBetween(W.unboundedPreceding, 0))
    parts = F.array_sort(F.collect_list(F.struct("start", "kind", "text")))
    return (
        fragments.withColumn("number", number)
        .groupBy("file", "number")
        .agg(
            F.array_join(F.transform(parts, lambda x: x["text"]), "\n").alias("text"),
            (F.max("kind") == _HEADER_TAIL).alias("is_header"),
        )
        .select("is_header", "text")
    )


def _ddl(schema: T.StructType) -> str:
    fields = [(f.name.replace("`", "``"), f.dataType.simpleString()) for f in schema.fields]
    return ", ".join(f"`{name}` {kind}" for name, kind in fields)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, check_header: bool = False) -> DataFrame:
    """Rows of CSV files with a header line each. With ``check_header`` another header than ``schema`` is an error."""
    lines = _lines(spark, path)
    splits = spark.sparkContext.broadcast(_find_splits(lines))
    fragments = store_stage(lines.mapInArrow(_join_lines(splits, (_HEAD, _TAIL, _HEADER_TAIL)), _JOINED), "fragments")
    records = lines.mapInArrow(_join_lines(splits, (_RECORD, _HEADER)), _JOINED)
    plain = records.select((F.col("kind") == _HEADER).alias("is_header"), "text")
    text = F.regexp_replace("text", r"\r\z", "")
    found = plain.unionByName(_mended(fragments)).select("is_header", text.alias("text")).where(F.col("text") != "")

    parsed = F.from_csv("text", _ddl(schema), {**CSV, "header": "false", "multiLine": "true"})
    as_text = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(schema))])
    names = F.from_csv(F.regexp_replace("text", "\\A\ufeff", ""), _ddl(as_text), {**CSV, "header": "false"})
    same = F.lit(True)
    if check_header:
        for i, name in enumerate(schema.names):
            same &= F.coalesce(F.lower(names[f"c{i}"]) == name.lower(), F.lit(False))
    wrong = F.raise_error(F.concat(F.lit("not the header of the first file: "), F.col("text"))).cast("boolean")
    stray = F.raise_error(F.concat(F.lit("a quote inside an unquoted field; read with whole_files=True: "), F.col("text")))
    is_row = F.when(F.col("is_header"), F.when(same, F.lit(False)).otherwise(wrong)).otherwise(
        F.when(F.col("text").rlike(_WELL_FORMED), F.lit(True)).otherwise(stray.cast("boolean"))
    )
    return found.where(is_row).select(parsed.alias("row")).select("row.*")
