"""Ranked lexical search over a length-stratified index.

A document's score depends on its length only through its normaliser ``m``, a whole number, so documents of equal ``m``
form a *stratum*. Inside a stratum the postings of a term are grouped by term frequency: all documents of a group
have one impact, which is computed once per frequency. The largest impact of each term bounds what a stratum can give a
query; a query visits strata in the order of their bounds and stops when the next bound is below its ``top``-th score.

The index is cut into segments of about ``SEGMENT_DOCS`` documents, dealt out by a hash of the row, so that a common
length or a common word fills no task. A row of the index is one stratum of one segment; a task searches one segment
for all queries and reports at most ``top`` documents a query, of which the best are kept. The counts that scores rest on
(documents, terms, document frequencies) are taken over all documents first.

Queries are sent to the tasks in blocks of ``QUERY_BYTES``, one pass over the index each. If the queries' words are
known when the index is built and have at most ``VOCABULARY_BYTES``, other words get no postings: they count in lengths
and can't be asked for.

Score: the sum over the query's terms, once each, of ``w * ((10**9 * tf) div (1000 * tf + 20 * m))`` in whole numbers, with
``w = floor(1000 * ln((2 * N + 2) / (2 * df + 1)))``, negative for a term that more than half of the documents hold, and
``m = 50 + (50 * n * N) div L``.

Defined cases: null and empty texts have no terms; such documents are not counted in N, such queries find nothing.
Rows that share a doc_id are separate documents; equal scores go by doc_id, null last, and rows that tie there too in any
order. Rows that share an item_id are one query with the terms of all, a null item_id is one of its own. Without
documents or queries there are no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseweave.llm.common import stored, union_all
from caseweave.llm.words import WORD_BYTES

TOP = 50
SEGMENT_DOCS = 1 << 13
#: Tasks that segments are dealt out to, one each as long as there are no more segments.
SEGMENT_TASKS = 8192
QUERY_BYTES = 4 << 20
VOCABULARY_BYTES = 16 << 20

_TABLE = bytes(int(b) or 32 for b in WORD_BYTES)


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


@dataclass
class Index:
    """``strata``: segment, m, keys, ranks, postings (term, tf, docs: places in ``keys``); counts over all documents."""

    strata: DataFrame
    frequencies: DataFrame
    n_docs: int
    n_terms: int
    segments: int
    key: str


# ---------------------------------------------------------------------------------------- building
def _vectors(vocabulary):
    """For each document: key, n (its terms with repeats), its terms and their frequencies."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if vocabulary is None else vocabulary.value.__contains__
        for batch in batches:
            n, ends, names, counts = [], [0], [], []
            for value in batch.column("text"):
                found = words(value.as_py())
                tf = Counter(found if known is None else filter(known, found))
                n.append(len(found))
                names += tf
                counts += tf.values()
                ends.append(len(names))
            at = pa.array(ends, pa.int32())
            yield pa.record_batch(
                {
                    "key": batch.column("key"),
                    "n": np.array(n, np.int64),
                    "terms": pa.ListArray.from_arrays(at, pa.array(names, pa.binary()).cast(pa.string())),
                    "tfs": pa.ListArray.from_arrays(at, pa.array(counts, pa.int32())),
                }
            )

    return count


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    """The offsets and the joined elements of a list column."""
    joined = column.combine_chunks()
    return np.concatenate([[0], np.cumsum(joined.value_lengths().to_numpy())]).astype(np.int64), joined.flatten()


def _build_segment(docs: pa.Table) -> pa.Table:
    """The strata of one segment."""
    docs = docs.take(pc.sort_indices(docs, [("key", "ascending")], null_placement="at_end"))
    m = docs.column("m").to_numpy()
    by_m = np.argsort(m, kind="stable")  # documents of one stratum by key
    levels, first = np.unique(m[by_m], return_index=True)
    first = np.append(first, len(m))
    place = np.empty(len(m), np.int64)
    place[by_m] = np.arange(len(m)) - np.repeat(first[:-1], np.diff(first))

    starts, terms = _flat(docs.column("terms"))
    _, tfs = _flat(docs.column("tfs"))
    coded = terms.dictionary_encode()
    term, tf = coded.indices.to_numpy().astype(np.int64), tfs.to_numpy().astype(np.int64)
    doc = np.repeat(np.arange(len(m)), np.diff(starts))
    order = np.lexsort((place[doc], tf, term, m[doc]))
    term, tf, doc = term[order], tf[order], doc[order]
    level = m[doc]
    new = np.ones(len(term), bool)
    new[1:] = (level[1:] != level[:-1]) | (term[1:] != term[:-1]) | (tf[1:] != tf[:-1])
    run = np.flatnonzero(new)
    groups = pa.StructArray.from_arrays(
        [
            coded.dictionary.take(pa.array(term[run])),
            pa.array(tf[run], pa.int32()),
            pa.ListArray.from_arrays(pa.array(np.append(run, len(term)), pa.int32()), pa.array(place[doc], pa.int32())),
        ],
        ["term", "tf", "docs"],
    )
    runs = np.searchsorted(level[run], np.append(levels, np.iinfo(np.int64).max))
    bounds = pa.array(first, pa.int32())
    return pa.table(
        {
            "segment": np.full(len(levels), docs.column("segment")[0].as_py(), np.int64),
            "m": levels,
            "keys": pa.ListArray.from_arrays(bounds, docs.column("key").combine_chunks().take(pa.array(by_m))),
            "ranks": pa.ListArray.from_arrays(bounds, pa.array(by_m, pa.int32())),
            "postings": pa.ListArray.from_arrays(pa.array(runs, pa.int32()), groups),
        }
    )


def _by_segment(rows: DataFrame, segments: int):
    return rows.repartition(min(segments, SEGMENT_TASKS), "segment").groupBy("segment")


def build_index(
    docs: DataFrame, vocabulary: DataFrame | None = None, key: str = "doc_id", segment_docs: int = SEGMENT_DOCS
) -> Index:
    """Index the texts of ``docs``; with ``vocabulary`` (a column ``term``) only those terms can be asked for."""
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()
    known = None
    if vocabulary is not None:
        vocabulary = stored(vocabulary.select("term").distinct(), "vocabulary")
        if (vocabulary.agg(F.sum(F.octet_length("term") + 40)).first()[0] or 0) <= VOCABULARY_BYTES:
            known = spark.sparkContext.broadcast({r["term"].encode() for r in vocabulary.collect()})
    texts = docs.select(F.col(key).alias("key"), F.col("text").cast("string").alias("text"))
    vectors = texts.mapInArrow(_vectors(known), f"key {kind}, n long, terms array<string>, tfs array<int>")
    vectors = stored(vectors.withColumn("row", F.monotonically_increasing_id()), "vectors")
    n_docs, n_terms = vectors.where("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    segments = max(1, -(-n_docs // segment_docs))
    normaliser = F.expr(f"50 + (50 * n * {n_docs}L) div {max(1, n_terms or 0)}L")
    placed = vectors.where(F.size("terms") > 0).select(
        F.pmod(F.xxhash64("row"), F.lit(segments)).cast("long").alias("segment"), normaliser.cast("long").alias("m"), "key", "terms", "tfs"
    )
    strata = _by_segment(placed, segments).applyInArrow(
        _build_segment,
        f"segment long, m long, keys array<{kind}>, ranks array<int>, postings array<struct<term: string, tf: int, docs: array<int>>>",
    )
    frequencies = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return Index(stored(strata, "strata"), stored(frequencies, "frequencies"), n_docs, n_terms or 0, segments, key)


# ---------------------------------------------------------------------------------------- searching
def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [sorted(set(words(x.as_py()))) for x in batch.column("text")]
        yield pa.record_batch(
            {
                "item": batch.column("item").take(pa.array(np.repeat(np.arange(len(found)), list(map(len, found))))),
                "term": pa.array([t for own in found for t in own], pa.binary()).cast(pa.string()),
            }
        )


def query_terms(items: DataFrame, key: str = "item_id") -> DataFrame:
    """(item, term): the different terms of each query."""
    kind = items.schema[key].dataType.simpleString()
    texts = items.select(F.col(key).alias("item"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_item_terms, f"item {kind}, term string").distinct()


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class _Queries:
    """A block of queries: terms as numbers, their weights, and where each query's terms start."""

    def __init__(self, rows: list[tuple[object, str, int]], n_docs: int):
        self.terms = {t: i for i, t in enumerate(sorted({t for _, t, _ in rows}))}
        own: dict[object, list[tuple[int, int]]] = {}
        for item, term, df in rows:
            own.setdefault(item, []).append((self.terms[term], weight(df, n_docs)))
        self.items = list(own)
        self.starts = np.cumsum([0, *map(len, own.values())])
        flat = np.array([x for pairs in own.values() for x in pairs], np.int64).reshape(-1, 2)
        self.term, self.weight = flat[:, 0].copy(), flat[:, 1].copy()


class _Stratum:
    """Postings of one stratum by term, with the impact of each document."""

    def __init__(self, m: int, n_docs: int, groups: pa.StructArray, terms: dict[str, int]):
        term = np.array([terms.get(t, -1) for t in groups.field("term").to_pylist()], np.int64)
        tf = groups.field("tf").to_numpy().astype(np.int64)
        frequency, which = np.unique(tf, return_inverse=True)
        impact = ((10**9 * frequency) // (1000 * frequency + 20 * m))[which]  # once per frequency
        docs = groups.field("docs")
        size, doc = docs.value_lengths().to_numpy().astype(np.int64), docs.flatten().to_numpy()
        # groups come by term and frequency; terms are put in the order of the queries' numbers
        begin = np.cumsum(size) - size
        first = np.flatnonzero(np.append(True, term[1:] != term[:-1])) if len(term) else np.zeros(0, np.int64)
        last = np.append(first[1:], len(term))[: len(first)] - 1
        keep = term[first] >= 0
        first, last = first[keep], last[keep]
        order = np.argsort(term[first])
        first, last = first[order], last[order]
        self.n_docs, self.doc, self.impact = n_docs, doc, np.repeat(impact, size)
        self.term, self.most = term[first], impact[last]  # impacts rise with frequency
        self.begin, self.end = begin[first], begin[last] + size[last]

    def places(self, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the terms are here, and where."""
        if not len(self.term):
            return np.zeros(len(term), bool), np.zeros(len(term), np.int64)
        at = np.minimum(np.searchsorted(self.term, term), len(self.term) - 1)
        return self.term[at] == term, at

    def bounds(self, q: _Queries) -> np.ndarray:
        """For each query no less than the best score in here."""
        here, at = self.places(q.term)
        most = np.maximum(q.weight * self.most[at], 0) * here if len(self.term) else np.zeros(len(here), np.int64)
        return np.add.reduceat(most, q.starts[:-1]) if len(most) else most

    def scores(self, term: np.ndarray, weights: np.ndarray) -> np.ndarray:
        here, at = self.places(term)
        at, weights = at[here], weights[here]
        size = self.end[at] - self.begin[at]
        index = np.repeat(self.begin[at] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        out = np.zeros(self.n_docs, np.int64)
        np.add.at(out, self.doc[index], np.repeat(weights, size) * self.impact[index])
        return out


def _search_segment(queries, top: int):
    """The best ``top`` documents of a segment for each query."""

    def search(table: pa.Table) -> pa.Table:
        q: _Queries = queries.value
        key_at, keys = _flat(table.column("keys"))
        rank = _flat(table.column("ranks"))[1].to_numpy()
        group_at, groups = _flat(table.column("postings"))
        strata = [
            _Stratum(m, int(key_at[i + 1] - key_at[i]), groups.slice(group_at[i], group_at[i + 1] - group_at[i]), q.terms)
            for i, m in enumerate(table.column("m").to_pylist())
        ]
        bounds = np.array([s.bounds(q) for s in strata])
        item_of, found, scored = [], [], []
        for i in range(len(q.items)):
            mine = slice(q.starts[i], q.starts[i + 1])
            best, at = np.zeros(0, np.int64), np.zeros(0, np.int64)
            for s in np.argsort(-bounds[:, i], kind="stable").tolist():
                least = int(best[-1]) if len(best) == top else 1
                if bounds[s, i] < least:
                    break
                scores = strata[s].scores(q.term[mine], q.weight[mine])
                hit = np.flatnonzero(scores >= least)
                best, at = np.append(best, scores[hit]), np.append(at, hit + key_at[s])
                order = np.lexsort((rank[at], -best))[:top]
                best, at = best[order], at[order]
            item_of += [i] * len(at)
            found.append(at)
            scored.append(best)
        at = np.concatenate(found) if found else np.zeros(0, np.int64)
        return pa.table(
            {
                "item_no": pa.array(item_of, pa.int32()),
                "key": keys.take(pa.array(at)),
                "score": np.concatenate(scored) if scored else np.zeros(0, np.int64),
            }
        )

    return search


def _blocks(asked: DataFrame, query_bytes: int) -> Iterator[tuple[list, int]]:
    """The rows (item, term, df) in blocks of whole queries, one after another, and how many blocks there are."""
    total = asked.agg(F.sum(F.octet_length("term") + 80)).first()[0] or 0
    n = max(1, -(-total // query_bytes))
    for i in range(n if total else 0):
        rows = asked if n == 1 else asked.where(F.pmod(F.xxhash64("item"), F.lit(n)) == i)
        yield [tuple(r) for r in rows.select("item", "term", "df").collect()], n


def search(index: Index, items: DataFrame, top: int = TOP, key: str = "item_id", query_bytes: int = QUERY_BYTES) -> DataFrame:
    """One row per query and found document: item_id, rank, doc_id, score; the ``top`` best with a score above 0."""
    asked = query_terms(items, key)
    spark = asked.sparkSession
    item_kind = asked.schema["item"].dataType.simpleString()
    doc_kind = index.strata.schema["keys"].dataType.elementType.simpleString()
    asked = stored(asked.join(index.frequencies, "term"), "asked")  # a term that no document has adds nothing
    ranking = Window.partitionBy("item_no").orderBy(F.col("score").desc(), F.col("key").asc_nulls_last())
    parts = []
    for rows, n_blocks in _blocks(asked, query_bytes):
        if not rows:
            continue
        queries = _Queries(rows, index.n_docs)
        sent = spark.sparkContext.broadcast(queries)
        found = _by_segment(index.strata, index.segments).applyInArrow(_search_segment(sent, top), f"item_no int, key {doc_kind}, score long")
        best = found.withColumn("rank", F.row_number().over(ranking)).where(F.col("rank") <= top)
        named = spark.createDataFrame(list(enumerate(queries.items)), f"item_no int, item {item_kind}")
        part = best.join(F.broadcast(named), "item_no").select(  # a block of queries has bounded size
            F.col("item").alias(key), "rank", F.col("key").alias(index.key), "score"
        )
        if n_blocks > 1:  # one block's queries are held at a time
            part = stored(part, "found")
            sent.destroy()
        parts.append(part)
    if not parts:
        return spark.createDataFrame([], f"`{key}` {item_kind}, rank int, `{index.key}` {doc_kind}, score long")
    return union_all(parts)


def search_all(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """Rank ``docs`` for every row of ``items``: an index of the terms that are asked for, then a search."""
    return search(build_index(docs, query_terms(items)), items, top)
