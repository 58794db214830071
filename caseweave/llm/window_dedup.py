"""Repeated word windows, found exactly behind a distributed count-min prefilter.

A window is ``WINDOW`` consecutive words of one document. A word is removed if a window over it also starts in a document
with a smaller doc_id. Most windows of a corpus occur once, so they are told apart from the rest first:

1. *Chunks.* Documents are packed into chunks of about ``CHUNK_BYTES`` of text; a chunk is one stored, compressed row.
2. *Sketch.* A count-min sketch has ``DEPTH`` rows of ``CELLS_PER_WINDOW`` cells for each window of the table, so its error
   is the same at every size. No task holds it whole: the cells are cut into slices of about ``SLICE_CELLS`` windows.
   Every chunk makes its part of the sketch (the sorted cells of its windows, each counted up to two) and sends
   each slice its share, about two bytes a window. A slice merges the shares and answers each chunk with one bit per cell:
   whether the merged count is two or more. Merged counts are never too small, so a window that occurs twice is
   always marked; a window is a candidate if all its cells are.
3. *Exact pass.* The candidates alone are grouped by their hash of 96 bits, again by slices: a chunk sends each
   different candidate once, with the smallest doc_id that has it in the chunk, and is told which of them a smaller
   doc_id has elsewhere. A window that very many documents share costs a slice one entry per chunk.
4. *Removal.* Each chunk marks the words of its windows that are to go.

The sketch only decides what the exact pass looks at: a result never rests on an estimate. Hashes of equal windows are
equal; two different windows share 96 bits once in 10**29 pairs. Tasks hold one chunk or one slice. The number of
messages is chunks times slices; raise both sizes together for tables of many terabytes.

Defined cases: a null or empty text has no words and loses none, like one shorter than a window; windows that
repeat inside one document only stay; rows that share a doc_id do not remove each other's words; a null doc_id counts
as larger than every other, and null ones don't remove each other's words; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseweave.llm.common import small_batches, steps, stored, texts, union_all
from caseweave.llm.words import mix, whole, windows, word_hashes
from caseweave.session import scratch_path

WINDOW = 13
CHUNK_BYTES = 4 << 20
SLICE_CELLS = 1 << 21
DEPTH = 2
CELLS_PER_WINDOW = 8

#: Byte -> a number of its own inside a word, 0 between words (space and 9 to 13).
PLAIN_BYTES = np.arange(1, 257, dtype=np.uint16)
PLAIN_BYTES[[9, 10, 11, 12, 13, 32]] = 0
#: Chunks in one file, and in one Arrow batch: readers hold few of them at once.
_FILE_CHUNKS, _BATCH_CHUNKS = 16, 4
_LAST = np.iinfo(np.int64).max  # a null doc_id
_SALTS = np.array([0, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], np.uint64)


def _pack(a: np.ndarray) -> bytes:
    """An array as its size and its bytes by planes, compressed."""
    if not len(a):
        return bytes(8)
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T
    return len(a).to_bytes(8, "little") + pa.compress(np.ascontiguousarray(planes).tobytes(), "zstd", asbytes=True)


def _unpack(data: bytes, dtype) -> np.ndarray:
    n, width = int.from_bytes(data[:8], "little"), np.dtype(dtype).itemsize
    if not n:
        return np.zeros(0, dtype)
    raw = np.frombuffer(pa.decompress(data[8:], n * width, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(width, n).T).view(dtype).reshape(n)


def _heads(a: np.ndarray, *more: np.ndarray) -> np.ndarray:
    """Where sorted rows differ from the row before."""
    new = np.ones(len(a), bool)
    new[1:] = a[1:] != a[:-1]
    for b in more:
        new[1:] |= b[1:] != b[:-1]
    return new


# ---------------------------------------------------------------------------------------- chunks
def _chunked(window: int, chunk_bytes: int):
    """Rows of (chunk, ids, sizes, data, n_windows): the texts of some documents, compressed together."""

    def chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal number, held, size
            table = pa.Table.from_batches(held).combine_chunks()
            data, offsets = texts(table.column("text").combine_chunks())
            n_words = np.diff(word_hashes(data, offsets, PLAIN_BYTES)[1])
            ids = table.column("id").cast(pa.int64()).fill_null(_LAST).to_numpy()
            number, held, size = number + 1, [], 0
            return pa.record_batch(
                {
                    "chunk": np.array([number], np.int64),
                    "ids": pa.array([_pack(ids)], pa.binary()),
                    "sizes": pa.array([_pack(np.diff(offsets))], pa.binary()),
                    "data": pa.array([_pack(data)], pa.binary()),
                    "n_windows": np.array([np.maximum(n_words - window + 1, 0).sum()], np.int64),
                }
            )

        for batch in batches:
            for rows in steps(batch, "text", chunk_bytes):
                n = len(texts(rows.column("text"))[0])
                if held and size + n > chunk_bytes:
                    yield flush()
                held.append(rows)
                size += n
        if held:
            yield flush()

    return chunk


class _Windows:
    """A chunk's texts, and its windows: the document, the first word and two hashes of each."""

    def __init__(self, ids: bytes, sizes: bytes, data: bytes, window: int):
        self.ids = _unpack(ids, np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(_unpack(sizes, np.int64))])
        self.data = _unpack(data, np.uint8)
        hashes, self.starts = word_hashes(self.data, self.offsets, PLAIN_BYTES)
        runs = windows(hashes, window)
        self.at = np.flatnonzero(whole(self.starts, window, len(runs)))
        self.key = runs[self.at]
        self.words = hashes
        self.window = window

    def second(self, pick: np.ndarray) -> np.ndarray:
        """32 more bits of the picked windows, from other hashes of their words."""
        return (windows(mix(self.words ^ _SALTS[1]), self.window)[self.at[pick]] >> np.uint64(32)).astype(np.uint32)

    def owner(self, pick: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, self.at[pick], "right") - 1


class _Layout:
    """How many cells a sketch row has, and how they, and the hashes, are cut into slices."""

    def __init__(self, n_windows: int, slice_cells: int):
        self.bits = max(10, (CELLS_PER_WINDOW * max(1, n_windows) - 1).bit_length())
        self.slices = max(1, -(-n_windows // slice_cells))

    def cells(self, key: np.ndarray, row: int) -> np.ndarray:
        spread = key if row == 0 else mix(key ^ _SALTS[row + 1])
        return spread >> np.uint64(64 - self.bits)

    def bounds(self, bits: int) -> np.ndarray:
        """The first value of each slice of ``bits``-bit values, without that of the first."""
        return np.array([(i << bits) // self.slices for i in range(1, self.slices)], np.uint64)

    def cut(self, values: np.ndarray, bits: int) -> np.ndarray:
        """Where sorted values fall apart into slices."""
        return np.concatenate([[0], np.searchsorted(values, self.bounds(bits), "left"), [len(values)]]).astype(np.int64)


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield {c: batch.column(c)[i].as_py() for c in batch.schema.names}


_SHARE = "slice int, chunk long, step int, share binary"


def _messages(found: list[tuple[int, int, int, bytes]], last: str) -> pa.RecordBatch:
    return pa.record_batch(
        {
            "slice": pa.array([x[0] for x in found], pa.int32()),
            "chunk": pa.array([x[1] for x in found], pa.int64()),
            "step": pa.array([x[2] for x in found], pa.int32()),
            last: pa.array([x[3] for x in found], pa.binary()),
        }
    )


# ---------------------------------------------------------------------------------------- the sketch
def _sketch_shares(layout: _Layout, window: int):
    """Each chunk's part of the sketch, one share per sketch row and slice."""

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                key = _Windows(row["ids"], row["sizes"], row["data"], window).key
                out = []
                for step in range(DEPTH):
                    cells = np.sort(layout.cells(key, step))
                    if len(cells) > 2:  # a cell counts up to two
                        cells = cells[np.append([True, True], cells[2:] != cells[:-2])]
                    cut = layout.cut(cells, layout.bits)
                    for i in np.flatnonzero(np.diff(cut)).tolist():
                        part = cells[cut[i] : cut[i + 1]]
                        gaps = np.diff(part, prepend=np.uint64((i << layout.bits) // layout.slices)).astype(np.uint32)
                        out.append((i, row["chunk"], step, _pack(gaps)))
                yield _messages(out, "share")

    return share


def _sketch_answers(group: pa.Table) -> pa.Table:
    """Merges the shares of one slice of one sketch row; a bit per cell and chunk: counted twice or more."""
    parts = [np.cumsum(_unpack(x.as_py(), np.uint32).astype(np.uint64)) for x in group.column("share")]
    merged = np.sort(np.concatenate(parts))
    often = merged[1:][merged[1:] == merged[:-1]]
    often = often[_heads(often)]
    answers = []
    for part in parts:
        own = part[_heads(part)]
        at = np.minimum(np.searchsorted(often, own), max(0, len(often) - 1))
        answers.append(np.packbits(often[at] == own if len(often) else np.zeros(len(own), bool)).tobytes())
    return pa.table(
        {c: group.column(c) for c in ("slice", "chunk", "step")} | {"answer": pa.array(answers, pa.binary())}
    )


def _bits(values: np.ndarray, bits: int, layout: _Layout, answers: dict[int, bytes]) -> np.ndarray:
    """The answered bit of each of the distinct sorted values; ``answers``: slice -> bits of its values."""
    cut = layout.cut(values, bits)
    flags = np.zeros(len(values), bool)
    for i in np.flatnonzero(np.diff(cut)).tolist():
        n = int(cut[i + 1] - cut[i])
        flags[cut[i] : cut[i + 1]] = np.unpackbits(np.frombuffer(answers[i], np.uint8), count=n).astype(bool)
    return flags


def _candidates(w: _Windows, layout: _Layout, answers: dict[int, dict[int, bytes]]) -> np.ndarray:
    """The windows whose cells are all counted twice or more."""
    pick = np.ones(len(w.key), bool)
    for step in range(DEPTH):
        cells = layout.cells(w.key, step)
        order = np.argsort(cells)
        cells = cells[order]
        new = _heads(cells)
        pick[order] &= _bits(cells[new], layout.bits, layout, answers.get(step, {}))[np.cumsum(new) - 1]
    return np.flatnonzero(pick)


class _Exact:
    """A chunk's candidates grouped by hash: the first doc_id of each different one."""

    def __init__(self, w: _Windows, pick: np.ndarray):
        key, second, ids = w.key[pick], w.second(pick), w.ids[w.owner(pick)]
        order = np.lexsort((ids, second, key))
        key, second = key[order], second[order]
        new = _heads(key, second)
        self.pick, self.ids = pick[order], ids[order]
        self.group = np.cumsum(new) - 1
        self.key, self.second, self.first = key[new], second[new], self.ids[new]


def _answers_of(table: pa.Table) -> dict[int, dict[int, bytes]]:
    """step -> slice -> bits."""
    found: dict[int, dict[int, bytes]] = {}
    for step, part, bits in zip(*(table.column(c).to_pylist() for c in ("step", "slice", "answer")), strict=True):
        found.setdefault(step, {})[part] = bits
    return found


def _exact_shares(layout: _Layout, window: int):
    """Each chunk's different candidates with their first doc_id, one share per slice."""

    def share(chunks: pa.Table, told: pa.Table) -> pa.Table:
        out = []
        for row in chunks.to_pylist():
            w = _Windows(row["ids"], row["sizes"], row["data"], window)
            exact = _Exact(w, _candidates(w, layout, _answers_of(told)))
            cut = layout.cut(exact.key, 64)
            for i in np.flatnonzero(np.diff(cut)).tolist():
                part = slice(int(cut[i]), int(cut[i + 1]))
                ids, which = np.unique(exact.first[part], return_inverse=True)
                gaps = np.diff(exact.key[part], prepend=np.uint64((i << 64) // layout.slices))
                packed = [_pack(gaps), _pack(exact.second[part]), _pack(ids), _pack(which.astype(np.uint32))]
                head = np.array([len(x) for x in packed], np.int64).tobytes()
                out.append((i, row["chunk"], DEPTH, head + b"".join(packed)))
        return pa.Table.from_batches([_messages(out, "share")])

    return share


def _exact_answers(group: pa.Table) -> pa.Table:
    """A bit per different candidate and chunk: a smaller doc_id has it."""
    keys, seconds, firsts = [], [], []
    for x in group.column("share"):
        data = x.as_py()
        ends = 32 + np.cumsum(np.frombuffer(data[:32], np.int64))
        a, b, c, d = (data[i:j] for i, j in zip([32, *ends[:-1]], ends, strict=True))
        keys.append(np.cumsum(_unpack(a, np.uint64)))
        seconds.append(_unpack(b, np.uint32))
        firsts.append(_unpack(c, np.int64)[_unpack(d, np.uint32)])
    sizes = [len(k) for k in keys]
    key, second, first = np.concatenate(keys), np.concatenate(seconds), np.concatenate(firsts)
    del keys, seconds, firsts
    order = np.lexsort((first, second, key))
    key, second, ids = key[order], second[order], first[order]
    new = _heads(key, second)
    low = ids[new][np.cumsum(new) - 1]
    later = np.zeros(len(key), bool)
    later[order] = ids > low
    cut = np.concatenate([[0], np.cumsum(sizes)])
    answers = [np.packbits(later[a:b]).tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
    return pa.table(
        {c: group.column(c) for c in ("slice", "chunk", "step")} | {"answer": pa.array(answers, pa.binary())}
    )


# ---------------------------------------------------------------------------------------- removal
_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))


def _removed(layout: _Layout, window: int, with_text: bool):
    """The words to go of each document of a chunk, and what is left."""

    def remove(chunks: pa.Table, told: pa.Table) -> pa.Table:
        out = {c: [] for c in ("id", "n_words", "n_removed", "spans", "kept_sha256", "kept_text")}
        for row in chunks.to_pylist():
            w = _Windows(row["ids"], row["sizes"], row["data"], window)
            answers = _answers_of(told)
            exact = _Exact(w, _candidates(w, layout, answers))
            elsewhere = _bits(exact.key, 64, layout, answers.get(DEPTH, {}))
            goes = elsewhere[exact.group] | (exact.ids > exact.first[exact.group])
            at = w.at[exact.pick[goes]]
            edge = np.zeros(len(w.words) + 1, np.int32)
            np.add.at(edge, at, 1)
            np.add.at(edge, at + window, -1)
            gone = np.cumsum(edge[:-1]) > 0
            data = w.data.tobytes()
            for i, (a, b) in enumerate(zip(w.starts[:-1].tolist(), w.starts[1:].tolist(), strict=True)):
                words = data[w.offsets[i] : w.offsets[i + 1]].split()
                mine = gone[a:b]
                if mine.any():
                    words = [x for x, g in zip(words, mine.tolist(), strict=True) if not g]
                bounds = np.flatnonzero(np.diff(np.concatenate([[False], mine, [False]]).astype(np.int8)))
                kept = b" ".join(words)
                out["id"].append(None if w.ids[i] == _LAST else int(w.ids[i]))
                out["n_words"].append(b - a)
                out["n_removed"].append(int(mine.sum()))
                out["spans"].append([{"first": x, "last": y} for x, y in bounds.reshape(-1, 2).tolist()])
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                out["kept_text"].append(kept.decode("utf-8", "replace") if with_text else None)
        kinds = [pa.int64(), pa.int64(), pa.int64(), _SPANS, pa.string(), pa.string()]
        return pa.table({c: pa.array(v, kind) for (c, v), kind in zip(out.items(), kinds, strict=True)})

    return remove


def remove_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    chunk_bytes: int = CHUNK_BYTES,
    slice_cells: int = SLICE_CELLS,
    with_text: bool = True,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, spans (removed word ranges), kept_sha256, kept_text.

    ``kept_text`` is the words that stay, joined by one space (null without ``with_text``). ``doc_id`` must be
    an integer.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        raise ValueError(f"doc_id must be an integer, not {kind}")
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    schema, path = "chunk long, ids binary, sizes binary, data binary, n_windows long", scratch_path(spark, "chunks")
    with small_batches(spark):
        chunked = rows.mapInArrow(_chunked(window, chunk_bytes), schema)
        chunked.write.option("maxRecordsPerFile", _FILE_CHUNKS).parquet(path)
    chunks = spark.read.schema(schema).parquet(path)
    layout = _Layout(chunks.agg(F.sum("n_windows")).first()[0] or 0, slice_cells)
    payload = chunks.select("chunk", "ids", "sizes", "data")
    answer = "slice int, chunk long, step int, answer binary"
    sketched = payload.mapInArrow(_sketch_shares(layout, window), _SHARE)
    with small_batches(spark, _BATCH_CHUNKS):
        marked = stored(sketched.groupBy("step", "slice").applyInArrow(_sketch_answers, answer), "sketch")

    def with_answers(told: DataFrame, work, schema: str) -> DataFrame:
        return payload.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(work, schema)

    shares = with_answers(marked, _exact_shares(layout, window), _SHARE)
    exact = stored(shares.groupBy("slice").applyInArrow(_exact_answers, answer), "exact")
    done = with_answers(
        union_all([marked, exact]),
        _removed(layout, window, with_text),
        "id long, n_words long, n_removed long, spans array<struct<first: long, last: long>>, kept_sha256 string, kept_text string",
    )
    return done.select(F.col("id").cast(kind).alias("doc_id"), "n_words", "n_removed", "spans", "kept_sha256", "kept_text")
