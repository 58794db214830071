"""Repeated passages by sparse suffix arrays.

Only suffixes that start at content-selected positions are kept: in every window of ``MIN_WORDS`` words, the run of
``GRAM`` words with the smallest hash. Equal windows select the same place, so two texts that share a passage of
``MIN_WORDS`` words share a selected suffix start in it. The suffixes are sorted over the cluster by their first words and
then by text, and neighbours are compared; a suffix whose neighbours start otherwise, or lie in the same text, is
dropped. Around the suffixes that remain, matches are extended left and right: all windows of ``MIN_WORDS`` words over the
suffix start are sorted and compared in the same way, and overlapping matches grow into one span. So a word is in a span
exactly if some window of ``MIN_WORDS`` words around it occurs in another text (as 64-bit hashes of it).

The sort is dealt out by ranges of (words, text, place): a passage that very many texts share is spread over tasks, and
what lies on both sides of a range bound is settled from two summary rows per range. Equal texts take part once.

Words are runs of letters, digits and non-ASCII characters, A-Z as a-z; places are word numbers.

Defined cases: a null, empty or shorter text has no spans; a passage that repeats only inside one text is none; equal
texts of at least ``MIN_WORDS`` words are one span over the whole text; rows that share a doc_id are told apart by text;
a null doc_id comes last when the first text of a passage is chosen.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseweave.llm.common import steps, stored, texts
from caseweave.llm.words import whole, windows, word_hashes

MIN_WORDS = 50
GRAM = 11
#: Bytes of suffix places up to which they are sent to every task; beyond it the texts are dealt out by key.
BROADCAST_BYTES = 32 << 20
_PLACE_BITS = 26


def select_places(grams: np.ndarray, valid: np.ndarray, size: int) -> np.ndarray:
    """Places of the smallest of each ``size`` consecutive gram hashes, for windows that start where ``valid``."""
    if not len(valid) or not valid.any():
        return np.zeros(0, np.int64)
    mask = np.uint64((1 << _PLACE_BITS) - 1)
    low = (grams & ~mask) | (np.arange(len(grams)).astype(np.uint64) & mask)
    span = 1
    while 2 * span <= size:
        low = np.minimum(low[: len(low) - span], low[span:])
        span *= 2
    rest = size - span
    if rest:
        low = np.minimum(low[: len(low) - rest], low[rest:])
    at = np.flatnonzero(valid)
    places = (low[at] & mask).astype(np.int64)
    if len(grams) > 1 << _PLACE_BITS:  # the place's high bits, from the window's start
        places += (at >> _PLACE_BITS) << _PLACE_BITS
        places[places < at] += 1 << _PLACE_BITS
    return np.unique(places)


def _suffixes(min_words: int, gram: int):
    """For each row: key, text key, n_words, and the selected suffixes unless the task met the text before."""

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            for rows in steps(batch, "text"):
                hashes, starts = word_hashes(*texts(rows.column("text")))
                grams = windows(hashes, gram)
                valid = whole(starts, min_words, max(0, len(hashes) - min_words + 1))
                places = select_places(grams, valid, min_words - gram + 1)
                cut = np.searchsorted(places, starts)
                keys, at = [], []
                for i, h in enumerate(rows.column("h").to_pylist()):
                    own = places[cut[i] : cut[i + 1]]
                    new = h is not None and h not in seen and len(own) > 0
                    if new:
                        seen.add(h)
                    keys.append(grams[own].view(np.int64) if new else None)
                    at.append((own - starts[i]).astype(np.int32) if new else None)
                if len(seen) > 1_000_000:
                    seen.clear()
                yield pa.record_batch(
                    {
                        "key": rows.column("key"),
                        "h": rows.column("h"),
                        "n_words": np.diff(starts),
                        "grams": pa.array(keys, pa.list_(pa.int64())),
                        "places": pa.array(at, pa.list_(pa.int32())),
                    }
                )

    return select


def _around(min_words: int, gram: int):
    """All windows of ``min_words`` words that hold one of a text's places."""

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for rows in steps(batch, "text"):
                hashes, starts = word_hashes(*texts(rows.column("text")))
                runs = windows(hashes, min_words)
                valid = whole(starts, min_words, len(runs))
                wanted = np.zeros(len(hashes) + 1, np.int64)
                ids = rows.column("text_id").to_numpy()
                for i, places in enumerate(rows.column("places")):
                    if int(ids[i]) in seen:
                        continue
                    seen.add(int(ids[i]))
                    at = places.values.to_numpy() + starts[i]
                    np.add.at(wanted, np.maximum(at - (min_words - gram), starts[i]), 1)
                    np.add.at(wanted, at + 1, -1)
                at = np.flatnonzero(valid & (np.cumsum(wanted)[: len(runs)] > 0)) if len(runs) else np.zeros(0, np.int64)
                owner = np.searchsorted(starts, at, "right") - 1
                for i in range(0, len(at), 1 << 18):
                    part = slice(i, i + (1 << 18))
                    yield pa.record_batch(
                        {"k": runs[at[part]].view(np.int64), "t": ids[owner[part]], "place": (at - starts[owner])[part].astype(np.int32)}
                    )
            if len(seen) > 1_000_000:
                seen.clear()

    return extend


_COMPARED = "k long, t long, place int, first_t long, shared boolean"


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compares neighbours of a range sorted by (k, t, place).

    A row is kept if its ``k`` has more than one ``t`` here, or touches a bound of the range; for the two groups
    at the bounds there are summary rows (place -1; t and first_t: smallest and largest t).
    """

    def rows(k, t, place, first_t, shared):
        return pa.record_batch(
            {"k": k, "t": t, "place": place.astype(np.int32), "first_t": first_t, "shared": shared}
        )

    def summary(k: int, low: int, high: int):
        one = lambda x: np.array([x], np.int64)
        return rows(one(k), one(low), np.array([-1]), one(high), np.array([False]))

    open_k = low = high = None  # the group that the last batch ended in
    held: list = []  # its rows, while all have one t
    at_bound = True  # that group is the range's first
    for batch in batches:
        if not batch.num_rows:
            continue
        k, t, place = (batch.column(c).to_numpy() for c in ("k", "t", "place"))
        cut = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
        cut = np.append(cut, len(k))
        if open_k is not None and k[0] == open_k:
            end = int(cut[1])
            if low != int(t[end - 1]) or low != high:
                for hk, ht, hp in held:
                    yield rows(hk, ht, hp, np.full(len(hk), low), np.full(len(hk), True))
                held = []
                yield rows(k[:end], t[:end], place[:end], np.full(end, low), np.full(end, True))
            else:
                held.append((k[:end], t[:end], place[:end]))
            high = int(t[end - 1])
            cut = cut[1:]
            if len(cut) == 1:
                continue
        if open_k is not None:
            if at_bound:
                yield summary(open_k, low, high)
                for hk, ht, hp in held:
                    yield rows(hk, ht, hp, np.full(len(hk), low), np.full(len(hk), False))
                at_bound = False
            held = []
        # whole groups of this batch, the last one stays open
        sizes = np.diff(cut)
        first, last = t[cut[:-1]], t[cut[1:] - 1]
        many = first != last
        begin = int(cut[0])
        if open_k is None and len(sizes) > 1:  # the range's first group ends here
            n = int(sizes[0])
            yield summary(int(k[begin]), int(first[0]), int(last[0]))
            yield rows(k[begin : begin + n], t[begin : begin + n], place[begin : begin + n], np.full(n, first[0]), np.full(n, bool(many[0])))
            at_bound = False
            many[0] = False
        inner = np.append(many[:-1], False)
        pick = np.repeat(inner, sizes)
        if pick.any():
            mine = slice(begin, len(k))
            yield rows(k[mine][pick], t[mine][pick], place[mine][pick], np.repeat(first, sizes)[pick], np.full(int(pick.sum()), True))
        begin = int(cut[-2])
        open_k, low, high = int(k[begin]), int(first[-1]), int(last[-1])
        tail = (k[begin:], t[begin:], place[begin:])
        if first[-1] != last[-1]:
            n = len(tail[0])
            yield rows(*tail, np.full(n, low), np.full(n, True))
            held = []
        else:
            held = [tail]
    if open_k is not None:
        yield summary(open_k, low, high)
        for hk, ht, hp in held:
            yield rows(hk, ht, hp, np.full(len(hk), low), np.full(len(hk), False))


def shared_rows(sorted_by: DataFrame, name: str) -> DataFrame:
    """The rows of (k, t, place) whose ``k`` occurs with more than one ``t``, with the smallest such t."""
    order = ["k", "t", "place"]
    compared = stored(
        sorted_by.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_neighbours, _COMPARED), name
    )
    bounds = compared.where("place < 0").groupBy("k").agg(F.min("t").alias("low"), F.max("first_t").alias("high"))
    return (
        compared.where("place >= 0")
        .join(F.broadcast(bounds), "k", "left")  # two rows per range at most
        .where(F.col("shared") | (F.col("low") < F.col("high")))
        .select("k", "t", "place", F.least("first_t", "low").alias("first_t"))
    )


def _spans(min_words: int):
    """Joins overlapping windows, sorted by (t, place), to spans with the first texts of their windows."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # t, first, last, first texts
        for batch in batches:
            if not batch.num_rows:
                continue
            t, place, head = (batch.column(c).to_numpy() for c in ("t", "place", "first_t"))
            # rows that only repeat their neighbour's first text are needed at the ends of spans alone
            same = (t[1:] == t[:-1]) & (place[1:] <= place[:-1].astype(np.int64) + min_words)
            begin = np.flatnonzero(np.append(True, ~same))
            end = np.append(begin[1:], len(t))
            change = np.flatnonzero(np.append(True, ~same | (head[1:] != head[:-1])))
            cut = np.searchsorted(change, np.append(begin, len(t)))
            out = []
            for i, (a, b) in enumerate(zip(begin.tolist(), end.tolist(), strict=True)):
                span = [int(t[a]), int(place[a]), int(place[b - 1]) + min_words, set(head[change[cut[i] : cut[i + 1]]].tolist())]
                if held is not None and held[0] == span[0] and span[1] <= held[2]:
                    held = [held[0], held[1], max(held[2], span[2]), held[3] | span[3]]
                else:
                    if held is not None:
                        out.append(held)
                    held = span
            if out:
                yield _span_rows(out)
        if held is not None:
            yield _span_rows([held])

    return join


def _span_rows(spans: list) -> pa.RecordBatch:
    return pa.record_batch(
        {
            "t": np.array([s[0] for s in spans], np.int64),
            "first": np.array([s[1] for s in spans], np.int64),
            "last": np.array([s[2] for s in spans], np.int64),
            "heads": pa.array([sorted(s[3]) for s in spans], pa.list_(pa.int64())),
        }
    )


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS, gram: int = GRAM) -> DataFrame:
    """One row per document and span: doc_id, first, last, n_copies, linked, is_first.

    ``first`` and ``last`` (exclusive) are word numbers; ``n_copies`` counts the documents of the same text;
    ``linked`` lists, for the windows of the span, the smallest doc_id of the first text that holds each (of another
    text, or of this one if it has copies); ``is_first`` marks the document that holds all of them first.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    keyed = docs.select(F.col("doc_id").alias("key"), F.col("text").cast("string").alias("text"))
    keyed = keyed.withColumn("h", F.unhex(F.md5("text")))
    signed = stored(
        keyed.mapInArrow(
            _suffixes(min_words, gram), f"key {kind}, h binary, n_words long, grams array<long>, places array<int>"
        ),
        "suffixes",
    )
    classes = signed.where(F.col("n_words") >= min_words).groupBy("h").agg(
        F.min("key").alias("low"), F.count(F.lit(1)).alias("n"), F.first("n_words").alias("n_words")
    )
    classes = stored(
        classes.orderBy(F.col("low").asc_nulls_last(), "h").withColumn("t", F.monotonically_increasing_id()), "classes"
    )
    sparse = (
        signed.where("grams is not null")
        .select("h", F.arrays_zip("grams", "places").alias("s"))
        .join(classes.select("h", "t"), "h")
        .select("t", F.explode("s").alias("s"))
        .select(F.col("s.grams").alias("k"), "t", F.col("s.places").alias("place"))
    )
    sparse = stored(sparse, "sparse")
    kept = shared_rows(sparse, "compared").groupBy("t").agg(F.collect_set("place").alias("places"))
    kept = stored(
        kept.join(classes, "t").select("h", F.col("low"), F.col("t").alias("text_id"), "places"), "kept"
    )
    size = kept.agg(F.sum(F.size("places") * 8 + 64)).first()[0] or 0
    around = (F.broadcast(kept) if size <= BROADCAST_BYTES else kept).alias("kept")
    chosen = keyed.alias("docs").join(
        around, (F.col("docs.h") == F.col("kept.h")) & F.col("docs.key").eqNullSafe(F.col("kept.low"))
    )
    dense = stored(
        chosen.select("text", "text_id", "places").mapInArrow(_around(min_words, gram), "k long, t long, place int"), "windows"
    )
    shared = shared_rows(dense, "matches").select("t", "place", "first_t")
    spans = (
        shared.repartition("t").sortWithinPartitions("t", "place")
        .mapInArrow(_spans(min_words), "t long, first long, last long, heads array<long>")
    )
    spans = stored(spans, "spans")
    named = (
        spans.select("t", "first", "last", F.explode("heads").alias("head"))
        .join(classes.select(F.col("t").alias("head"), F.col("low").alias("head_id")), "head")
        .groupBy("t", "first", "last")
        .agg(
            F.array_sort(F.collect_set(F.when(F.col("head") != F.col("t"), F.col("head_id")))).alias("linked"),
        )
    )
    # equal texts: one span over the whole text, with all that its parts link to
    copied = classes.where("n > 1").select(F.col("t").alias("copied_t"), "low", "n_words")
    by_text = named.join(copied, F.col("t") == F.col("copied_t"), "left")
    single = by_text.where("copied_t is null").select("t", "first", "last", "linked")
    full = (
        copied.join(named, F.col("t") == F.col("copied_t"), "left")
        .groupBy("copied_t", "low", "n_words")
        .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("linked")))).alias("linked"))
        .select(F.col("copied_t").alias("t"), F.lit(0).cast("long").alias("first"), F.col("n_words").alias("last"), "linked")
    )
    passages = single.unionByName(full).join(classes.select("t", "h", "low", "n"), "t")
    members = signed.select("key", F.col("h").alias("doc_h"))
    rows = members.join(passages, F.col("doc_h") == F.col("h"))
    own = F.array(F.col("low"))
    linked = F.when(F.col("n") > 1, F.array_sort(F.array_union("linked", F.filter(own, lambda x: x.isNotNull())))).otherwise(F.col("linked"))
    return rows.select(
        F.col("key").alias("doc_id"),
        "first",
        "last",
        F.col("n").alias("n_copies"),
        linked.alias("linked"),
        ((F.size("linked") == 0) & F.col("key").eqNullSafe(F.col("low"))).alias("is_first"),
    )
