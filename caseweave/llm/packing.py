"""Best-fit packing of documents into sequences, improved by swaps between underfull bins.

Lengths are whole numbers up to the capacity, so documents of one length are interchangeable. The plan
is made for a histogram of lengths, never of more rows than the capacity: best fit decreasing, then
exchanges between bins that are not full: the fuller one takes a length for nothing, for one or for two smaller
ones, or two lengths for one. Every exchange raises the sum of squared fills, so the search ends, and it ends only
when no two bins have an exchange left; possible sums are kept as bits, so that partners are found without trying
all pairs. A bin type stands for many equal bins. Best fit works on at most as many lengths as the capacity; the
search on the driver takes as long as there are different bins, which is short for common lengths and minutes for
millions of documents of lengths that best fit packs badly (the README has figures). Documents then take their
places by their rank among the documents of their length.

Defined cases: a null text is empty and holds the end id only; rows that share a doc_id are separate
documents; an empty table gives no rows; very long texts are cut into pieces, however many.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseweave.llm.common import ordered_starts, steps, stored, texts
from caseweave.llm.encoding import encoder, tokenizer_path

ENCODE_BYTES = 4 << 20
CAPACITY = 2048

Bin = tuple[int, ...]  # the lengths in a bin, descending


def _cut(tokenizer: str, end_id: int, capacity: int, with_ids: bool, special_as_text: bool):
    """Encodes documents and cuts the long ones; the first piece takes the remainder."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, special_as_text)
        for batch in batches:
            for rows in steps(batch, "text", ENCODE_BYTES):
                ids, starts = enc.encode_rows(*texts(rows.column("text")))
                ids = np.insert(ids, starts[1:], end_id).astype("<u4")
                starts = starts + np.arange(len(starts))
                sizes = np.diff(starts)
                n_pieces = -(-sizes // capacity)
                row = np.repeat(np.arange(len(sizes)), n_pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
                head = sizes - (n_pieces - 1) * capacity
                begin = np.where(piece == 0, 0, head[row] + (piece - 1) * capacity)
                length = np.where(piece == 0, head[row], capacity)
                a = starts[row] + begin
                cuts = [ids[i:j] for i, j in zip(a.tolist(), (a + length).tolist(), strict=True)]
                yield pa.record_batch(
                    {
                        "doc_id": rows.column("doc_id").take(pa.array(row)),
                        "piece": piece.astype(np.int32),
                        "start": begin,
                        "length": length,
                        "ids_crc32": np.array([zlib.crc32(x.tobytes()) for x in cuts], np.int64),
                        "ids": pa.array([x.astype(enc.dtype).tobytes() if with_ids else None for x in cuts], pa.binary()),
                    }
                )

    return cut


def best_fit(lengths: dict[int, int], capacity: int) -> Counter[Bin]:
    """Best fit decreasing over a histogram: bin -> how many such bins."""
    open_bins: dict[int, Counter[Bin]] = {}  # free space -> bins
    spaces: list[int] = []

    def put(free: int, bin_: Bin, n: int) -> None:
        if free not in open_bins:
            open_bins[free] = Counter()
            insort(spaces, free)
        open_bins[free][bin_] += n

    for length in sorted(lengths, reverse=True):
        left = lengths[length]
        while left:
            at = bisect_left(spaces, length)
            if at == len(spaces):  # no open bin has room: open new ones, filled with this length
                each = capacity // length
                n, rest = divmod(left, each)
                if n:
                    put(capacity - each * length, (length,) * each, n)
                if rest:
                    put(capacity - rest * length, (length,) * rest, 1)
                left = 0
                continue
            free = spaces[at]
            bins = open_bins[free]
            bin_, n = next(iter(bins.items()))
            take = min(n, left)
            if take == n:
                del bins[bin_]
                if not bins:
                    del open_bins[free], spaces[at]
            else:
                bins[bin_] -= take
            put(free - length, bin_ + (length,), take)
            left -= take
    return sum(open_bins.values(), Counter())


def _smear(bits: int, room: int) -> int:
    """The bits moved up by every step from 1 to ``room``."""
    out, width = bits << 1, 1
    while width < room:
        more = min(width, room - width)
        out |= out << more
        width += more
    return out


class _Sums:
    """A bin's lengths, and sums of two of them, as bits; what it could take as the fuller bin."""

    __slots__ = ("singles", "pairs", "takes", "takes_for_one")

    def __init__(self, bin_: Bin, capacity: int):
        counts = Counter(bin_)
        self.singles = sum(1 << x for x in counts)
        self.pairs = 0
        for x, n in counts.items():
            self.pairs |= (self.singles if n > 1 else self.singles ^ (1 << x)) << x
        room = capacity - sum(bin_)
        self.takes = _smear(1 | self.singles | self.pairs, room)  # one length, for nothing, one or two
        self.takes_for_one = _smear(self.singles, room)  # two lengths, for one

    def takes_from(self, other: "_Sums") -> bool:
        return bool(self.takes & other.singles or self.takes_for_one & other.pairs)


def _parts(bin_: Bin, total: int) -> Bin:
    """At most two lengths of the bin with this sum."""
    if total == 0:
        return ()
    if total in bin_:
        return (total,)
    return next((x, total - x) for i, x in enumerate(bin_) if total - x in bin_[i + 1 :])


def _exchange(a: Bin, b: Bin, capacity: int) -> tuple[Bin, Bin] | None:
    """The exchange that fills ``a`` (the fuller bin) most from ``b``: a move, one for one, two for one or one for two."""
    own, other = _Sums(a, capacity), _Sums(b, capacity)
    if not own.takes_from(other):
        return None
    give = 1 | own.singles | own.pairs
    for gain in range(capacity - sum(a), 0, -1):
        if hit := (give << gain) & other.singles:
            get = (hit.bit_length() - 1,)
            out = _parts(a, get[0] - gain)
            break
        if hit := (own.singles << gain) & other.pairs:
            total = hit.bit_length() - 1
            get = next((x, total - x) for i, x in enumerate(b) if total - x in b[i + 1 :])
            out = (total - gain,)
            break
    left, right = list(a), list(b)
    for x in out:
        left.remove(x)
        right.append(x)
    for y in get:
        right.remove(y)
        left.append(y)
    return tuple(sorted(left, reverse=True)), tuple(sorted(right, reverse=True))


class _Underfull:
    """The bin types that are not full, by fill; each fill has the bits of its types together.

    A type that leaves does not clear its bits; they are made anew when a search meets bits without a type.
    """

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.counts: Counter[Bin] = Counter()
        self.fills: list[int] = []
        self.types: dict[int, dict[Bin, _Sums]] = {}
        self.bits: dict[int, list[int]] = {}

    def add(self, bin_: Bin, n: int) -> None:
        self.counts[bin_] += n
        if self.counts[bin_] > n:
            return
        fill = sum(bin_)
        if fill not in self.types:
            insort(self.fills, fill)
            self.types[fill], self.bits[fill] = {}, [0, 0, 0, 0]
        sums = self.types[fill][bin_] = _Sums(bin_, self.capacity)
        self._mark(fill, sums)

    def remove(self, bin_: Bin, n: int) -> None:
        self.counts[bin_] -= n
        if self.counts[bin_] > 0:
            return
        fill = sum(bin_)
        del self.counts[bin_], self.types[fill][bin_]
        if not self.types[fill]:
            del self.types[fill], self.bits[fill], self.fills[bisect_left(self.fills, fill)]

    def _mark(self, fill: int, sums: _Sums) -> None:
        self.bits[fill] = [
            x | y for x, y in zip(self.bits[fill], (sums.singles, sums.pairs, sums.takes, sums.takes_for_one), strict=True)
        ]

    def _first(self, fill: int, bin_: Bin, fits) -> Bin | None:
        for other, sums in self.types[fill].items():
            if fits(sums) and (other != bin_ or self.counts[bin_] > 1):
                return other
        self.bits[fill] = [0, 0, 0, 0]
        for sums in self.types[fill].values():
            self._mark(fill, sums)
        return None

    def partners(self, bin_: Bin) -> tuple[Bin, Bin] | None:
        """(fuller, emptier) with an exchange, one of them this bin: the fullest that takes, or the emptiest that gives."""
        fill = sum(bin_)
        own = self.types[fill][bin_]
        at = bisect_left(self.fills, fill)
        for other in reversed(self.fills[at:]):
            _, _, takes, takes_for_one = self.bits[other]
            if takes & own.singles or takes_for_one & own.pairs:
                if found := self._first(other, bin_, lambda sums: sums.takes_from(own)):
                    return found, bin_
        for other in self.fills[: at + 1]:
            singles, pairs, _, _ = self.bits[other]
            if own.takes & singles or own.takes_for_one & pairs:
                if found := self._first(other, bin_, own.takes_from):
                    return bin_, found
        return None


def improve(bins: Counter[Bin], capacity: int) -> Counter[Bin]:
    """Exchanges between bins that are not full, until no pair of them has one.

    A bin type is compared when it is new, or when a second bin of it comes; the emptiest goes first.
    """
    done: Counter[Bin] = Counter()
    work = _Underfull(capacity)
    waiting: list[tuple[int, Bin]] = []

    def put(bin_: Bin, n: int) -> None:
        if sum(bin_) == capacity:
            done[bin_] += n
        elif bin_:
            if work.counts[bin_] < 2:
                heappush(waiting, (sum(bin_), bin_))
            work.add(bin_, n)

    for bin_, n in bins.items():
        put(bin_, n)
    while waiting:
        bin_ = waiting[0][1]
        found = work.partners(bin_) if bin_ in work.counts else None
        if found is None:  # gone, or without an exchange with any other type
            heappop(waiting)
            continue
        a, b = found
        n = work.counts[a] // 2 if a == b else min(work.counts[a], work.counts[b])
        new = _exchange(a, b, capacity)
        work.remove(a, 2 * n if a == b else n)
        if a != b:
            work.remove(b, n)
        for x in new:
            put(x, n)
    return done + work.counts


def plan(lengths: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Places as (length, first rank, last rank + 1, sequence of the first rank, offset)."""
    used: Counter[int] = Counter()
    places, sequence = [], 0
    for bin_, n in sorted(improve(best_fit(lengths, capacity), capacity).items(), reverse=True):
        offset = 0
        for length in bin_:
            places.append((length, used[length], used[length] + n, sequence, offset))
            used[length] += n
            offset += length
        sequence += n
    return places


def _seat(places: list[tuple[int, int, int, int, int]]):
    """Looks up each piece's place by its length and its rank within that length."""
    table = np.array(sorted(places), np.int64).reshape(-1, 5)

    def seat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = table[:, 0] * (1 << 46) + table[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            at = np.searchsorted(keys, length * (1 << 46) + rank, "right") - 1
            columns = {c: batch.column(c) for c in batch.schema.names if c != "rank"}
            columns["sequence_id"] = table[at, 3] + rank - table[at, 1]
            columns["offset"] = table[at, 4]
            yield pa.record_batch(columns)

    return seat


def pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    end_id: int = 0,
    capacity: int = CAPACITY,
    with_ids: bool = True,
    special_as_text: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset.

    ``ids`` are little-endian, 16 bits wide if the vocabulary allows it and else 32; null without
    ``with_ids``. They stay where they were written while places are found, and are joined last.
    ``sequences`` puts them together. The checksum is that of 32-bit ids in any case. With ``special_as_text``
    the tokenizer's special strings in a text are ordinary text.
    """
    spark = docs.sparkSession
    tokenizer = tokenizer or tokenizer_path("byte_bpe_50k.json")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    pieces = stored(
        docs.select("doc_id", F.col("text").cast("string").alias("text"))
        .mapInArrow(_cut(tokenizer, end_id, capacity, with_ids, special_as_text), f"{schema}, ids binary")
        .withColumn("row", F.monotonically_increasing_id()),
        "pieces",
    )
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        empty = F.lit(0).cast("long")
        return pieces.drop("row").withColumns({"sequence_id": empty, "offset": empty})
    light = pieces.drop("ids").withColumn("one", F.lit(1))
    ranked = ordered_starts(light, ["length"], ["doc_id", "piece"], {"rank": "one"}).drop("one")
    placed = ranked.mapInArrow(_seat(plan(counts, capacity)), f"{schema}, row long, sequence_id long, offset long")
    if with_ids:
        placed = placed.join(pieces.select("row", "ids"), "row")
    else:
        placed = placed.withColumn("ids", F.lit(None).cast("binary"))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences: sequence_id, n_tokens, ids. A sequence has at most ``capacity`` ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"), F.concat_ws("", F.transform(parts, lambda p: F.hex(p["ids"]))).alias("hex")
    ).select("sequence_id", "n_tokens", F.unhex("hex").alias("ids"))
