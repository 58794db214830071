"""Binary token shards with a minimal perfect hash index for keyed access.

A store is a folder in a file system that every executor reaches (``pyarrow.fs`` opens it):

``shards/NNNNNN-<attempt>.ids``
    ids of consecutive documents, in ascending key order over all shards: 16 header bytes
    (``CWTOKEN1``, width of an id, zeros), the raw little-endian ids, the place of each document's
    first id and one more (64-bit, in ids), the number of documents (64-bit).
``entries/``  Parquet: one row per document (key, shard, ordinal, first id, number of ids).
``files/``    Parquet: one row per shard (its file, the ids of all shards before it).
``index/``    Parquet: one row per hash bucket of about ``BUCKET_KEYS`` keys. A multi-level bit array
    maps each key of the bucket to its own slot in 0..n-1; a slot holds a 32-bit fingerprint of the
    key and the runs of documents (shard, first ordinal, count) that carry the key.

A lookup hashes the key, finds its slot and compares the fingerprint; an absent key is reported as
absent but for one in 2**32. Work and memory of a task are bounded by one shard or one bucket. A shard
written by a lost or repeated task is never named in ``files`` and so never read.

Defined cases: a null text is empty and holds the end id only; a null key is a key of its own and
comes first; rows that share a key lie together, ordered by a hash of their text, and a lookup of the
key returns them all; an empty table makes a store without shards.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseweave.llm.common import small_batches, steps, texts
from caseweave.llm.encoding import encoder, tokenizer_path
from caseweave.llm.words import mix

MAGIC = b"CWTOKEN1"
BUCKET_KEYS = 4096
ENCODE_BYTES = 4 << 20


def _file_system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _hashes(key: str):
    """Two independent 64-bit hashes of a key; null differs from every string."""
    text = F.coalesce(F.concat(F.lit("k"), F.col(key).cast("string")), F.lit("null"))
    return F.xxhash64(text), F.xxhash64(F.lit("second"), text)


def _place(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
    spread = mix(h1.astype(np.uint64) ^ mix(h2.astype(np.uint64) + np.uint64(level + 1)))
    return (spread % np.uint64(size)).astype(np.int64)


def _fingerprint(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    return (mix(h2.astype(np.uint64) * np.uint64(3) + h1.astype(np.uint64)) >> np.uint64(32)).astype(np.uint32)


def build_hash(h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(level sizes, bits): on each level the keys that are alone on their bit keep it."""
    sizes, bits, left = [], [], np.arange(len(h1))
    while len(left):
        if len(sizes) > 200:
            raise ValueError("two keys share both 64-bit hashes")
        size = max(64, 2 * len(left))
        at = _place(h1[left], h2[left], len(sizes), size)
        counts = np.bincount(at, minlength=size)
        sizes.append(size)
        bits.append(counts == 1)
        left = left[counts[at] != 1]
    return np.array(sizes, np.int64), np.concatenate(bits) if bits else np.zeros(0, bool)


def find_slots(h1: np.ndarray, h2: np.ndarray, sizes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """The slot of each key, -1 for a key that no level holds."""
    ranks = np.cumsum(bits) - 1
    slots, left, base = np.full(len(h1), -1, np.int64), np.arange(len(h1)), 0
    for level, size in enumerate(sizes):
        at = base + _place(h1[left], h2[left], level, int(size))
        hit = bits[at]
        slots[left[hit]] = ranks[at[hit]]
        left, base = left[~hit], base + int(size)
    return slots


def _write_shard(path: str, tokenizer: str, end_id: int, key: str, text: str, special_as_text: bool):
    """Encodes a partition into one shard file and reports its documents."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, out = TaskContext.get().partitionId(), None
        enc, firsts, total = encoder(tokenizer, special_as_text), [], 0
        fs, folder = _file_system(path)
        name = f"{shard:06d}-{uuid.uuid4().hex}.ids"
        for batch in batches:
            for rows in steps(batch, text, ENCODE_BYTES):
                if out is None:
                    fs.create_dir(f"{folder}/shards", recursive=True)
                    out = fs.open_output_stream(f"{folder}/shards/{name}")
                    out.write(MAGIC + bytes([enc.dtype.itemsize]) + bytes(7))
                ids, starts = enc.encode_rows(*texts(rows.column(text)))
                ids = np.insert(ids, starts[1:], end_id)
                starts = starts + np.arange(len(starts))
                out.write(ids.astype(enc.dtype).tobytes())
                first = total + starts[:-1]
                yield pa.record_batch(
                    {
                        "key": rows.column(key),
                        "shard": np.full(rows.num_rows, shard, np.int32),
                        "file": [name] * rows.num_rows,
                        "ordinal": np.arange(rows.num_rows) + sum(map(len, firsts)),
                        "first": first,
                        "n_ids": np.diff(starts),
                    }
                )
                firsts.append(first)
                total += len(ids)
        if out is not None:
            places = np.append(np.concatenate(firsts), total).astype("<u8")
            out.write(places.tobytes() + np.array([len(places) - 1], "<u8").tobytes())
            out.close()

    return write


def _build_bucket(runs: pd.DataFrame) -> pd.DataFrame:
    runs = runs.sort_values(["h1", "h2", "shard"], kind="stable")
    h1, h2 = runs["h1"].to_numpy(), runs["h2"].to_numpy()
    new = np.append(True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]))
    sizes, bits = build_hash(h1[new], h2[new])
    slots = find_slots(h1[new], h2[new], sizes, bits)
    of_run = slots[np.cumsum(new) - 1]
    order = np.argsort(of_run, kind="stable")
    prints = np.zeros(len(slots), np.uint32)
    prints[slots] = _fingerprint(h1[new], h2[new])
    starts = np.searchsorted(of_run[order], np.arange(len(slots) + 1))
    return pd.DataFrame(
        {
            "bucket": [runs["bucket"].iloc[0]],
            "n_keys": [len(slots)],
            "sizes": [sizes.tobytes()],
            "bits": [np.packbits(bits).tobytes()],
            "prints": [prints.tobytes()],
            "run_starts": [starts.astype(np.int64).tobytes()],
            "shards": [runs["shard"].to_numpy(np.int32)[order].tobytes()],
            "ordinals": [runs["ordinal"].to_numpy(np.int64)[order].tobytes()],
            "counts": [runs["n"].to_numpy(np.int64)[order].tobytes()],
        }
    )


_BUCKET = (
    "bucket long, n_keys long, sizes binary, bits binary, prints binary, run_starts binary,"
    " shards binary, ordinals binary, counts binary"
)


def write_store(
    docs: DataFrame,
    path: str,
    tokenizer: str | None = None,
    end_id: int = 1,
    key: str = "doc_id",
    text: str = "text",
    special_as_text: bool = False,
) -> None:
    """Encode ``docs`` and write a store at ``path``, which must not exist yet.

    With ``special_as_text`` the tokenizer's special strings in a text are ordinary text.
    """
    spark = docs.sparkSession
    tokenizer = tokenizer or tokenizer_path("word_bpe_49k.json")
    tie, by_text = "tie", "by_text"
    rows = docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    rows = rows.withColumns({by_text: F.xxhash64("t"), tie: F.xxhash64(F.monotonically_increasing_id())})
    order = [F.col("k").asc_nulls_first(), F.col(by_text), F.col(tie)]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("k", "t")
    kind = docs.schema[key].dataType.simpleString()
    with small_batches(spark):
        ranged.mapInArrow(
            _write_shard(path, tokenizer, end_id, "k", "t", special_as_text),
            f"key {kind}, shard int, file string, ordinal long, first long, n_ids long",
        ).write.parquet(f"{path}/entries")
    entries = spark.read.parquet(f"{path}/entries")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    (
        entries.groupBy("shard", "file")
        .agg(F.sum("n_ids").alias("n"), F.count(F.lit(1)).alias("n_docs"))
        .withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))  # one row per shard
        .write.parquet(f"{path}/files")
    )
    h1, h2 = _hashes("key")
    runs = entries.groupBy("key", "shard").agg(F.min("ordinal").alias("ordinal"), F.count(F.lit(1)).alias("n"))
    buckets = max(1, -(-entries.count() // BUCKET_KEYS))
    (
        runs.select(h1.alias("h1"), h2.alias("h2"), "shard", "ordinal", "n")
        .withColumn("bucket", F.pmod("h1", F.lit(buckets)))
        .groupBy("bucket")
        .applyInPandas(_build_bucket, _BUCKET)
        .write.parquet(f"{path}/index")
    )
    spark.createDataFrame([(buckets, tokenizer, end_id)], "buckets long, tokenizer string, end_id long").write.parquet(
        f"{path}/about"
    )


def _find(wanted: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    none = pd.DataFrame({"key": wanted["key"].iloc[:0], "shard": [], "ordinal": [], "n": []})
    if not len(index) or not len(wanted):
        return none
    row = index.iloc[0]
    h1, h2 = wanted["h1"].to_numpy(), wanted["h2"].to_numpy()
    sizes = np.frombuffer(row["sizes"], np.int64)
    bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=int(sizes.sum())).astype(bool)
    slots = find_slots(h1, h2, sizes, bits)
    prints = np.frombuffer(row["prints"], np.uint32)
    known = (slots >= 0) & (prints[slots] == _fingerprint(h1, h2))
    starts = np.frombuffer(row["run_starts"], np.int64)
    slots, keys = slots[known], wanted["key"][known]
    counts = starts[slots + 1] - starts[slots]
    at = np.repeat(starts[slots] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    return pd.DataFrame(
        {
            "key": keys.repeat(counts).reset_index(drop=True),
            "shard": np.frombuffer(row["shards"], np.int32)[at],
            "ordinal": np.frombuffer(row["ordinals"], np.int64)[at],
            "n": np.frombuffer(row["counts"], np.int64)[at],
        }
    )


def find_runs(spark: SparkSession, path: str, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, shard, ordinal, n): where the documents of each distinct key lie; absent keys have no row."""
    buckets = spark.read.parquet(f"{path}/about").first()["buckets"]
    wanted = keys.select(F.col(key).alias("key")).distinct()
    h1, h2 = _hashes("key")
    wanted = wanted.select("key", h1.alias("h1"), h2.alias("h2")).withColumn("bucket", F.pmod("h1", F.lit(buckets)))
    index = spark.read.schema(_BUCKET).parquet(f"{path}/index")
    kind = wanted.schema["key"].dataType.simpleString()
    return (
        wanted.groupBy("bucket")
        .cogroup(index.groupBy("bucket"))
        .applyInPandas(_find, f"key {kind}, shard int, ordinal long, n long")
    )


def _read_runs(path: str, with_ids: bool):
    """Opens each shard once and reads the documents of the runs, one at a time."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = _file_system(path)
        opened, source = None, None
        for batch in batches:
            rows = batch.to_pydict()
            out: dict[str, list] = {c: [] for c in ("key", "start", "n_tokens", "ids_crc32", "ids")}
            held = 0
            for i in range(batch.num_rows):
                if rows["file"][i] != opened:
                    opened = rows["file"][i]
                    source = fs.open_input_file(f"{folder}/shards/{opened}")
                    head, size = source.read_at(16, 0), source.size()
                    if head[:8] != MAGIC:
                        raise ValueError(f"{opened} is no token shard")
                    width = head[8]
                    n_docs = int(np.frombuffer(source.read_at(8, size - 8), "<u8")[0])
                    table = size - 8 - 8 * (n_docs + 1)
                ordinal, n = rows["ordinal"][i], rows["n"][i]
                places = np.frombuffer(source.read_at(8 * (n + 1), table + 8 * ordinal), "<u8").astype(np.int64)
                for a, b in zip(places[:-1].tolist(), places[1:].tolist(), strict=True):
                    ids = np.frombuffer(source.read_at((b - a) * width, 16 + a * width), f"<u{width}").astype("<u4")
                    out["key"].append(rows["key"][i])
                    out["start"].append(rows["start"][i] + a)
                    out["n_tokens"].append(b - a)
                    out["ids_crc32"].append(zlib.crc32(ids.tobytes()))
                    out["ids"].append(ids.tobytes() if with_ids else None)
                    held += (b - a) * 4 * with_ids + 64
                    if held > 8 << 20:
                        yield pa.record_batch({**out, "key": pa.array(out["key"], batch.schema.field("key").type)})
                        out, held = {c: [] for c in out}, 0
            if out["key"]:
                yield pa.record_batch({**out, "key": pa.array(out["key"], batch.schema.field("key").type)})

    def typed(batches):
        for b in read(batches):
            kinds = {"start": pa.int64(), "n_tokens": pa.int64(), "ids_crc32": pa.int64(), "ids": pa.binary()}
            yield pa.record_batch({c: b.column(c).cast(kinds[c]) if c in kinds else b.column(c) for c in b.schema.names})

    return typed


def read_documents(spark: SparkSession, path: str, keys: DataFrame, key: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """The documents of ``keys``, read through the index: key, start, n_tokens, ids_crc32, ids.

    ``start`` counts the ids of all documents before; ``ids`` are little-endian 32-bit (null without
    ``with_ids``). Runs are dealt out by shard, and each shard is opened once.
    """
    runs = find_runs(spark, path, keys, key)
    kind = runs.schema["key"].dataType.simpleString()
    files = spark.read.parquet(f"{path}/files").select("shard", "file", "start")
    located = runs.join(files, "shard").select("key", "shard", "file", "start", "ordinal", "n")
    found = (
        located.repartition("shard")
        .sortWithinPartitions("shard", "ordinal")
        .mapInArrow(_read_runs(path, with_ids), f"key {kind}, start long, n_tokens long, ids_crc32 long, ids binary")
    )
    return found.withColumnRenamed("key", key)
