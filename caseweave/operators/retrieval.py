"""Exact retrieval of the most similar past cases by cosine similarity.

Every query is compared with every indexed vector, but no pair of them ever becomes a row:
similarities exist only as a matrix inside a task, which returns the best ``k`` per query.

* An index whose measured size is below a limit (the normal case: an index is a sample of a
  fixed number of past cases) is broadcast.  Messages are then read, scored and passed on in one
  map-only stage.
* A larger index is cut into cells around pivots, each with the largest angle between the pivot and
  a member, and cells into blocks of bounded size; queries are cut by their nearest pivot.  No member
  of a cell is nearer to a query than the angle to the pivot less the cell's own, so a cell is
  skipped for a query if that bound cannot reach its ``k``-th score so far.  Cells are visited in
  rounds, the nearest first.  Consecutive blocks travel together as a part: a task gets a part of the
  queries and a part of the index, each vector once, and compares what the queries are to visit.

Similarities are rounded to nine decimals before they are ranked, and ties go to the smaller id,
so the result depends neither on the order of summation nor on the block layout.  Indexed rows that
share an id and a score come in any order.  Zero vectors have no similarity and are never
retrieved.  Ids may be of any type that can be ordered.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseweave import fixed
from caseweave.functions import vectors as V
from caseweave.operators.lookup import lookup_join
from caseweave.operators.sampling import sample_exact
from caseweave.session import store_stage

MAX_BROADCAST_BYTES = 64 << 20
BLOCK_BYTES = 32 << 20
SCORE_DECIMALS = 9
_CELLS = 4 << 20  # similarities held at a time by one task
#: Pivots are sent to every task; beyond this, cells are larger and cut into more blocks.
PIVOT_BYTES = 8 << 20
PIVOTS_PER_BLOCK = 4
#: Cells that a query visits after those that its first ``k`` cases come from, by round; then all that are left.
ROUND_CELLS = (8,)
#: The index and the queries are sent to tasks in so many parts, and in more if a part would have more than
#: ``PART_BYTES`` as doubles (or one block).  What is sent grows with the number of parts.
INDEX_PARTS, QUERY_PARTS = 8, 4
PART_BYTES = 64 << 20
#: A task that is to compare so much of a part or more compares all of it at once.
DENSE_SHARE = 0.25
ANGLE_SLACK = 1e-6  # larger than the error of an angle between nearly equal vectors


# ----------------------------------------------------------------------------------------------
# index
# ----------------------------------------------------------------------------------------------
def add_norm(df: DataFrame, vector: str = "embedding") -> DataFrame:
    return df.withColumn("norm", V.norm(F.col(vector)))


def sample_index(
    embedded: DataFrame,
    key: str,
    n: int = fixed.INDEX_SAMPLE_SIZE,
    seed: int = fixed.INDEX_SEED,
    vector: str = "embedding",
) -> DataFrame:
    """Retrieval index: a sample of past cases with their vectors and norms."""
    return add_norm(sample_exact(embedded, n, seed, key), vector)


def build_index(
    cases: DataFrame,
    embed: Callable[[DataFrame], DataFrame],
    key: str,
    n: int = fixed.INDEX_SAMPLE_SIZE,
    seed: int = fixed.INDEX_SEED,
) -> DataFrame:
    """Retrieval index from texts: draw the sample, then embed only that."""
    return add_norm(embed(sample_exact(cases, n, seed, key)))


def partial_index(
    cases: DataFrame,
    vectors: DataFrame,
    key: str,
    n_done: int,
    n: int = fixed.INDEX_SAMPLE_SIZE,
    seed: int = fixed.INDEX_SEED,
) -> DataFrame:
    """Index from an interrupted build: the first ``n_done`` cases of the sample, with vectors."""
    return add_norm(sample_exact(cases, min(n_done, n), seed, key).join(vectors, key))


# ----------------------------------------------------------------------------------------------
# scoring kernel (numpy; runs inside tasks)
# ----------------------------------------------------------------------------------------------
def _make_kernel():
    """Functions used inside tasks, as closures so that they travel with the task."""

    cells, decimals = _CELLS, SCORE_DECIMALS

    def unit_rows(vectors):
        """(n, d) unit vectors and a mask of rows that have one, from an Arrow list array."""
        valid = vectors.is_valid().to_numpy(zero_copy_only=False)
        width = len(vectors[int(np.argmax(valid))]) if valid.any() else 0
        rows = np.zeros((len(vectors), width))
        values = vectors.flatten().to_numpy(zero_copy_only=False)
        rows[valid] = values.reshape(int(valid.sum()), width)
        norms = np.sqrt(np.einsum("ij,ij->i", rows, rows))
        usable = valid & (norms > 0) & np.isfinite(norms)  # a NaN or infinite vector is like none
        rows[usable] /= norms[usable, None]
        return rows, usable

    def own_places(query_ids, index_ids):
        """Where each query's id is in the ascending ``index_ids``: first and last place + 1."""
        unique = pc.unique(index_ids)
        code = pc.index_in(query_ids, value_set=unique)
        known = code.is_valid().to_numpy(zero_copy_only=False)
        code = code.fill_null(0).to_numpy(zero_copy_only=False)
        runs = pc.index_in(index_ids, value_set=unique).to_numpy(zero_copy_only=False)
        if not len(runs):
            return np.zeros(len(code), np.int64), np.zeros(len(code), np.int64)
        first = np.searchsorted(runs, code, "left")
        return first, np.where(known, np.searchsorted(runs, code, "right"), first)

    def best(queries, usable, query_ids, index, index_ids, k, exclude_self, wanted=None, cell=None):
        """Positions (n, k) and similarities of the best k; -inf marks an empty place.

        ``index_ids`` is ascending, so the first maximum is the one with the smallest id.
        A query without an id excludes nothing.  ``wanted`` (n, cells) and the index rows' ``cell``
        leave out the cells that a query is not to visit.
        """
        n, m = len(queries), len(index)
        k = min(k, m)
        places = np.zeros((n, k), dtype=np.int64)
        scores = np.full((n, k), -np.inf)
        if m == 0 or k == 0 or queries.shape[1] == 0:
            return places, scores
        if exclude_self:
            own_first, own_last = own_places(query_ids, index_ids)
        step = max(1, cells // m)
        for start in range(0, n, step):
            part = slice(start, start + step)
            sims = np.round(queries[part] @ index.T, decimals)
            sims[~usable[part]] = -np.inf
            if wanted is not None and not wanted[part].all():
                sims[~wanted[part][:, cell]] = -np.inf
            rows = np.arange(len(sims))
            if exclude_self:
                first, last = own_first[part].copy(), own_last[part]
                same = last > first
                while same.any():  # once, unless the index repeats an id
                    sims[rows[same], first[same]] = -np.inf
                    first = first + 1
                    same &= last > first
            if k <= 16:
                for place in range(k):
                    column = sims.argmax(axis=1)
                    places[part, place] = column
                    scores[part, place] = sims[rows, column]
                    sims[rows, column] = -np.inf
            else:
                order = np.argsort(-sims, axis=1, kind="stable")[:, :k]
                places[part] = order
                scores[part] = np.take_along_axis(sims, order, axis=1)
        return places, scores

    return unit_rows, best


# ----------------------------------------------------------------------------------------------
# small index: broadcast
# ----------------------------------------------------------------------------------------------
@dataclass
class BroadcastIndex:
    """Index held by every executor.  Build it once and use it for many batches of messages."""

    ids_and_vectors: object  # pyspark Broadcast of (ids, unit vectors, payload)
    payload: T.StructType  # case columns returned with each neighbour
    id_name: str
    id_type: T.DataType

    @property
    def result_type(self) -> T.ArrayType:
        return T.ArrayType(
            T.StructType(
                [
                    T.StructField(self.id_name, self.id_type),
                    *self.payload.fields,
                    T.StructField("similarity", T.DoubleType()),
                ]
            )
        )


def _id(df: DataFrame, key: str) -> Column:
    """An id column in its own type; whole numbers of any width are one type."""
    integral = isinstance(df.schema[key].dataType, T.IntegralType)
    return F.col(key).cast("bigint") if integral else F.col(key)


def _index_columns(index: DataFrame, key: str, vector: str, payload: list[str]) -> DataFrame:
    """Key, vector (in its stored precision) and payload of the rows that can be compared."""
    return index.select(_id(index, key).alias(key), vector, *payload).where(
        F.col(key).isNotNull() & _has_direction(F.col(vector))
    )


def _has_direction(vector: Column) -> Column:
    """Whether a vector can be compared: its norm is finite and not zero (NaN sorts above infinity)."""
    norm = V.norm(vector)
    return (norm > 0) & (norm < F.lit(float("inf")))


def index_bytes(index: DataFrame, key: str, vector: str, payload: list[str]) -> int:
    """Measured size of the index columns as tasks will hold them; one aggregate job."""
    row = F.size(vector) * F.lit(8) + F.lit(16)
    for name in payload:
        row = row + F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0))
    total = index.agg(F.coalesce(F.sum(row.cast("bigint")), F.lit(0)).alias("total"))
    return total.first()["total"]


def broadcast_index(
    index: DataFrame,
    key: str,
    vector: str = "embedding",
    payload: dict[str, str] | None = None,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> BroadcastIndex | None:
    """The index as a broadcast, or None if it is larger than ``max_bytes``.

    ``payload`` maps output names to index columns that are returned with each neighbour.
    """
    payload = payload or {}
    columns = _index_columns(index, key, vector, list(dict.fromkeys(payload.values())))
    if index_bytes(columns, key, vector, list(payload.values())) > max_bytes:
        return None
    table = columns.toArrow().sort_by(key).combine_chunks()
    fields = [T.StructField(out, columns.schema[name].dataType) for out, name in payload.items()]
    unit_rows, _ = _make_kernel()
    vectors = table.column(vector)
    vectors = vectors.chunk(0) if vectors.num_chunks else pa.array([], vectors.type)
    value = (
        table.column(key).combine_chunks(),
        unit_rows(vectors)[0],
        {out: table.column(name).combine_chunks() for out, name in payload.items()},
    )
    session = index.sparkSession
    return BroadcastIndex(
        session.sparkContext.broadcast(value), T.StructType(fields), key, columns.schema[key].dataType
    )


def neighbours(
    index: BroadcastIndex,
    vector: Column,
    query_id: Column,
    k: int = fixed.RETRIEVED_PER_MESSAGE,
    exclude_self: bool = False,
) -> Column:
    """Best ``k`` cases per row as an array of structs, most similar first.

    Only the vector and the id go to Python; other columns of the row stay in the JVM.
    """
    shared, id_name, names = index.ids_and_vectors, index.id_name, index.payload.names
    unit_rows, best = _make_kernel()

    @F.arrow_udf(returnType=index.result_type)
    def score(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        index_ids, index_rows, columns = shared.value
        for vectors, ids in batches:
            rows, usable = unit_rows(vectors)
            places, scores = best(rows, usable, ids, index_rows, index_ids, k, exclude_self)
            found = np.isfinite(scores)
            offsets = np.concatenate([[0], np.cumsum(found.sum(axis=1))]).astype(np.int32)
            taken = pa.array(places[found])
            values = [index_ids.take(taken)]
            values += [columns[name].take(taken) for name in names]
            values.append(pa.array(scores[found]))
            cases = pa.StructArray.from_arrays(values, names=[id_name, *names, "similarity"])
            yield pa.ListArray.from_arrays(pa.array(offsets), cases)

    # declared non-deterministic so that the optimizer never evaluates it a second time, for
    # example to filter empty arrays before they are exploded
    return score.asNondeterministic()(vector, query_id.try_cast(index.id_type))


# ----------------------------------------------------------------------------------------------
# large index: blocks
# ----------------------------------------------------------------------------------------------
@dataclass
class _Cells:
    """Cells of the index around pivots: unit vectors, the angle of the farthest member, members.

    ``parts``: the first and the last cell of each part of the index.
    """

    pivots: np.ndarray
    reach: np.ndarray
    size: np.ndarray
    parts: list[tuple[int, int]]


def _choose_pivots(index: DataFrame, n_rows: int, dims: int, block_bytes: int) -> np.ndarray:
    """Some index vectors, drawn by a hash of their row number; one if the index is one block."""
    unit_rows, _ = _make_kernel()
    blocks = math.ceil(n_rows * dims * 8 / block_bytes)
    n = 1 if blocks <= 1 else min(PIVOTS_PER_BLOCK * blocks, n_rows, max(1, PIVOT_BYTES // (8 * dims)))
    drawn = index.orderBy(F.xxhash64("case_row"), "case_row").limit(n).select("vector").toArrow()
    return unit_rows(drawn.column("vector").combine_chunks())[0]


def _nearest_pivot(pivots):
    """Adds to each row the pivot nearest to its vector, and the similarity to it."""
    unit_rows, _ = _make_kernel()
    cells = _CELLS

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, _ = unit_rows(batch.column("vector"))
            cell, near = np.zeros(len(rows), np.int32), np.zeros(len(rows))
            step = max(1, cells // len(pivots.value))
            for start in range(0, len(rows), step):
                part = slice(start, start + step)
                sims = rows[part] @ pivots.value.T
                cell[part] = sims.argmax(axis=1)
                near[part] = sims.max(axis=1)
            columns = {c: batch.column(c) for c in batch.schema.names}
            yield pa.record_batch({**columns, "cell": cell, "near": near})

    return assign


def _in_blocks(
    df: DataFrame, row: str, names: tuple[str, str], dims: int, block_bytes: int, n_parts: int
) -> tuple[DataFrame, DataFrame, list, int, list[tuple[int, int]]]:
    """``df`` with a block and a part number; the blocks of each cell; members and reach of each cell; how many blocks
    there are; the first and the last cell of each part.

    A cell that is larger than a block is cut by a hash of the row number, so blocks have bounded size.
    """
    block, part = names
    counted = df.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("near").alias("near")).collect()
    part_bytes = max(block_bytes, min(PART_BYTES, sum(r["n"] for r in counted) * dims * 8 / n_parts))
    part_rows = max(1, int(part_bytes / (8 * dims)))
    table, first, before, cells = [], 0, 0, {}
    for r in sorted(counted, key=lambda r: r["cell"]):
        n = math.ceil(r["n"] * dims * 8 / block_bytes)
        table.append((r["cell"], first, n, before, r["n"]))
        for at in range(before // part_rows, (before + (n - 1) * r["n"] // n) // part_rows + 1):
            cells[at] = (cells.get(at, (r["cell"],))[0], r["cell"])
        first, before = first + n, before + r["n"]
    ranges = [cells.get(i, (0, -1)) for i in range(max(cells, default=-1) + 1)]
    # one row per pivot, and pivots have a bounded size
    table = df.sparkSession.createDataFrame(table, "cell int, first int, n long, before long, n_rows long")

    def cut(rows: DataFrame, piece: Column) -> DataFrame:
        at = F.expr(f"cast((before + (piece * n_rows) div n) div {part_rows} as int)")
        numbers = {block: (F.col("first") + F.col("piece")).cast("int"), part: at}
        return rows.withColumn("piece", piece).withColumns(numbers).drop("piece", "first", "n", "before", "n_rows")

    placed = cut(df.join(F.broadcast(table), "cell"), F.pmod(F.xxhash64(row), F.col("n"))).drop("near")
    table = cut(table, F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    return placed, table, counted, first, ranges


def _plan_round(cells, k: int, round_no: int):
    """For each query the cells to visit in a round: the next ones by their bound that can still matter.

    ``visits`` has a row for each part of the index that holds some: its number, and a bit for each of its cells.
    """
    unit_rows, _ = _make_kernel()
    held, slack, sizes = _CELLS, ANGLE_SLACK, ROUND_CELLS

    def by_part(want, parts):
        """Arrow lists of (ip, cells) from a row of flags per query."""
        rows, numbers, words, widths = [], [], [], []
        for i, (first, last) in enumerate(parts):
            flags = want[:, first : last + 1]
            row = np.flatnonzero(flags.any(axis=1))
            width = -(-flags.shape[1] // 64)
            packed = np.zeros((len(row), 8 * width), np.uint8)
            bits = np.packbits(flags[row], axis=1, bitorder="little")
            packed[:, : bits.shape[1]] = bits
            rows.append(row)
            numbers.append(np.full(len(row), i, np.int32))
            words.append(packed.view(np.int64).ravel())
            widths.append(np.full(len(row), width, np.int32))
        row = np.concatenate(rows)
        ends = np.concatenate([[0], np.cumsum(np.concatenate(widths))]).astype(np.int32)
        cells = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(words)))
        visits = pa.StructArray.from_arrays([pa.array(np.concatenate(numbers)), cells], names=["ip", "cells"])
        ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(want)))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), visits.take(pa.array(np.argsort(row, kind="stable"))))

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = cells.value
        for batch in batches:
            rows, _ = unit_rows(batch.column("vector"))
            least = batch.column("least").fill_null(-np.inf).to_numpy(zero_copy_only=False)
            step = max(1, held // len(index.pivots))
            for start in range(0, len(rows), step):
                part = slice(start, start + step)
                angle = np.arccos(np.clip(rows[part] @ index.pivots.T, -1.0, 1.0)) - index.reach - slack
                bound = np.cos(np.clip(angle, 0.0, np.pi))
                order = np.argsort(-bound, axis=1, kind="stable")
                # the first round takes cells until they hold k cases and the query itself
                enough = np.cumsum(index.size[order], axis=1) > k
                begin = np.where(enough.any(axis=1), enough.argmax(axis=1) + 1, order.shape[1])
                end = begin if round_no == 0 else begin + sum(sizes[:round_no])
                if round_no > len(sizes):
                    end = np.full(len(order), order.shape[1])
                begin = 0 * begin if round_no == 0 else begin + sum(sizes[: round_no - 1])
                place = np.arange(order.shape[1])
                matters = np.take_along_axis(bound, order, axis=1) >= least[part, None] - 1e-9
                visit = (place >= begin[:, None]) & (place < end[:, None]) & matters
                want = np.zeros(order.shape, bool)
                np.put_along_axis(want, order, visit, axis=1)
                want[:, index.size == 0] = False
                own = batch.slice(start, len(order))
                columns = {c: own.column(c) for c in batch.schema.names if c != "least"}
                yield pa.record_batch({**columns, "visits": by_part(want, index.parts)})

    return plan


def _score_parts(cells, k: int, exclude_self: bool):
    """The best ``k`` cases of one part of the index for each query of one part of the queries."""
    unit_rows, best = _make_kernel()
    dense = DENSE_SHARE

    def in_cells(queries, usable, ids, cases, index_ids, wanted, cell):
        """Cell by cell: the query, the case and the similarity of the best ``k`` of each query."""
        members = np.split(np.argsort(cell, kind="stable"), np.cumsum(np.bincount(cell, minlength=wanted.shape[1]))[:-1])
        row, place, score = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        for i, own in enumerate(members):
            asking = np.flatnonzero(wanted[:, i]) if len(own) else own
            if not len(asking):
                continue
            some, own_ids = ids.take(pa.array(asking)), index_ids.take(pa.array(own))
            places, scores = best(queries[asking], usable[asking], some, cases[own], own_ids, k, exclude_self)
            found = np.isfinite(scores)
            row.append(asking[np.nonzero(found)[0]])
            place.append(own[places[found]])
            score.append(scores[found])
        row, place, score = np.concatenate(row), np.concatenate(place), np.concatenate(score)
        order = np.lexsort((place, -score, row))
        row, place, score = row[order], place[order], score[order]
        keep = np.arange(len(row)) - np.searchsorted(row, row, "left") < k
        return row[keep], place[keep], score[keep]

    def score(left_table: pa.Table, right_table: pa.Table) -> pa.Table:
        right_table = right_table.sort_by([("index_id", "ascending"), ("case_row", "ascending")])
        index_ids = right_table.column("index_id").combine_chunks()
        ids = left_table.column("query_id").combine_chunks()
        queries, usable = unit_rows(left_table.column("vector").combine_chunks())
        cases, _ = unit_rows(right_table.column("vector").combine_chunks())
        row, place, scores = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        if len(queries) and len(cases):
            cell = right_table.column("cell").to_numpy() - cells.value.parts[left_table.column("ip")[0].as_py()][0]
            words = left_table.column("cells").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            bits = np.ascontiguousarray(words).view(np.uint8).reshape(len(queries), -1)
            wanted = np.unpackbits(bits, axis=1, bitorder="little").astype(bool)
            size = np.bincount(cell, minlength=wanted.shape[1])
            if (wanted.sum(axis=0) * size).sum() >= dense * len(queries) * len(cases):
                places, all_scores = best(queries, usable, ids, cases, index_ids, k, exclude_self, wanted, cell)
                found = np.isfinite(all_scores)
                row, place, scores = np.nonzero(found)[0], places[found], all_scores[found]
            else:
                row, place, scores = in_cells(queries, usable, ids, cases, index_ids, wanted, cell)
        return pa.table(
            {
                "row": left_table.column("row").take(pa.array(row)),
                "query_id": ids.take(pa.array(row)),
                "case_row": right_table.column("case_row").take(pa.array(place)),
                "index_id": index_ids.take(pa.array(place)),
                "similarity": pa.array(scores, pa.float64()),
            }
        )

    return score


def _block_pairs(left: DataFrame, blocks: DataFrame, parts: list[tuple[int, int]]) -> int:
    """How many pairs of a block of queries and a block of the index are compared."""
    first = left.sparkSession.createDataFrame([(i, a) for i, (a, _) in enumerate(parts)], "ip int, first int")
    words = left.select("qb", "ip", F.posexplode("cells").alias("at", "word")).distinct()
    bits = words.withColumn("bit", F.explode(F.sequence(F.lit(0), F.lit(63))))
    bits = bits.where(F.expr("shiftright(word, bit) & 1 = 1")).join(first, "ip")
    cells = bits.select("qb", "ip", (F.col("first") + 64 * F.col("at") + F.col("bit")).alias("cell")).distinct()
    return cells.join(blocks, ["cell", "ip"]).select("qb", "ib").distinct().count()


def _blocked_top_k(
    queries: DataFrame, index: DataFrame, k: int, exclude_self: bool, block_bytes: int, shipped: dict | None = None
) -> DataFrame:
    """(row, query_id, rank, case_row, index_id, similarity): the best ``k`` per query row.

    ``queries`` (row, query_id, vector) and ``index`` (case_row, index_id, vector) are stored
    tables with unique row numbers; ids may repeat, and a query's id may be NULL.

    Sizes follow from memory: a task holds one part of the queries, one part of the index
    and a bounded slice of their similarities.  ``shipped`` takes down how many block pairs there are
    (``all``), how many are compared and how many vectors are sent in each round (``rounds``, ``sent``).
    """
    spark = queries.sparkSession
    query_type, index_type = (df.schema[c].dataType for df, c in ((queries, "query_id"), (index, "index_id")))
    found = (
        f"row bigint, query_id {index_type.simpleString()}, case_row bigint, index_id {index_type.simpleString()},"
        " similarity double"
    )
    dims, n_rows = index.agg(F.max(F.size("vector")), F.count(F.lit(1))).first()
    ids = queries.select("row", F.col("query_id").alias("own_id"))
    if not n_rows or not k:
        empty = spark.createDataFrame([], f"{found}, rank int")
        return empty.withColumn("query_id", F.lit(None).cast(query_type))

    pivots = spark.sparkContext.broadcast(_choose_pivots(index, n_rows, dims, block_bytes))

    def placed(df: DataFrame, name: str) -> DataFrame:
        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
        return store_stage(df.mapInArrow(_nearest_pivot(pivots), f"{kinds}, cell int, near double"), name)

    cases, blocks, counted, n_cases, parts = _in_blocks(
        placed(index, "cells"), "case_row", ("ib", "ip"), dims, block_bytes, INDEX_PARTS
    )
    own = queries.select("row", F.col("query_id").try_cast(index_type).alias("query_id"), "vector")
    asked, _, _, n_asked, _ = _in_blocks(placed(own, "queries"), "row", ("qb", "qp"), dims, block_bytes, QUERY_PARTS)
    size, near = np.zeros(len(pivots.value), np.int64), np.ones(len(pivots.value))
    for r in counted:
        size[r["cell"]], near[r["cell"]] = r["n"], r["near"]
    reach = np.arccos(np.clip(near, -1.0, 1.0)) + ANGLE_SLACK
    reach[size == 0] = -2 * np.pi  # an empty cell is the last to be visited
    cells = spark.sparkContext.broadcast(_Cells(pivots.value, reach, size, parts))

    asked = asked.select("row", "query_id", "vector", "qb", "qp")
    order = W.partitionBy("row").orderBy(F.col("similarity").desc(), "index_id", "case_row")
    best = None
    for round_no in range(len(ROUND_CELLS) + 2):
        if best is None:
            waiting = asked.withColumn("least", F.lit(None).cast("double"))
        else:
            full = best.groupBy("row").agg(F.min("similarity").alias("least"), F.count(F.lit(1)).alias("n"))
            waiting = asked.join(full.where(F.col("n") == k).select("row", "least"), "row", "left")
        planned = waiting.mapInArrow(
            _plan_round(cells, k, round_no),
            f"row bigint, query_id {index_type.simpleString()}, vector {own.schema['vector'].dataType.simpleString()},"
            " qb int, qp int, visits array<struct<ip: int, cells: array<bigint>>>",
        ).where(F.size("visits") > 0)
        planned = store_stage(planned, "planned")
        if planned.isEmpty():
            continue  # a later round has other cells
        left = planned.select("row", "query_id", "vector", "qb", "qp", F.inline("visits"))
        # at most one row per part of the queries and part of the index
        pairs = store_stage(planned.select("qp", F.explode("visits.ip").alias("ip")).distinct(), "pairs")
        if shipped is not None:
            shipped.setdefault("rounds", []).append(_block_pairs(left, blocks, parts))
            shipped["all"] = n_cases * n_asked
        right = cases.select("case_row", "index_id", "vector", "cell", "ip").join(F.broadcast(pairs), "ip")
        if shipped is not None:
            shipped.setdefault("sent", []).append(left.count() + right.count())
        partial = (
            left.drop("qb").groupBy("qp", "ip")
            .cogroup(right.groupBy("qp", "ip"))
            .applyInArrow(_score_parts(cells, k, exclude_self), found)
        )
        merged = partial if best is None else best.unionByName(partial)
        ranked = merged.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        best = store_stage(ranked.drop("rank"), "best")
        if len(pivots.value) == 1:
            break
    if best is None:
        best = spark.createDataFrame([], found)
    ranked = best.withColumn("rank", F.row_number().over(order))
    if query_type == index_type:
        return ranked
    # the query's own id, in its own type
    return ranked.drop("query_id").join(ids, "row").withColumnRenamed("own_id", "query_id")


def _numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` stored with a row number of its own in ``name``; ids need not be unique."""
    return store_stage(df.withColumn(name, F.monotonically_increasing_id()), "rows")


# ----------------------------------------------------------------------------------------------
# public operators
# ----------------------------------------------------------------------------------------------
def top_k_similar(
    queries: DataFrame,
    index: DataFrame,
    query_key: str,
    index_key: str,
    k: int = fixed.RETRIEVED_PER_MESSAGE,
    exclude_self: bool = False,
    query_vector: str = "embedding",
    index_vector: str = "embedding",
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``(query_id, rank, index_id, similarity)``: the best ``k`` indexed vectors per query."""
    small = broadcast_index(index, index_key, index_vector, max_bytes=max_broadcast_bytes)
    if small is not None:
        found = neighbours(small, F.col(query_vector), F.col(query_key), k, exclude_self)
        return (
            queries.select(_id(queries, query_key).alias("query_id"), found.alias("found"))
            .select("query_id", F.posexplode("found").alias("position", "case"))
            .select(
                "query_id",
                (F.col("position") + 1).alias("rank"),
                F.col(f"case.{index_key}").alias("index_id"),
                F.col("case.similarity").alias("similarity"),
            )
        )
    blocked = _blocked_top_k(
        _numbered(_query_columns(queries, query_key, query_vector), "row"),
        _numbered(
            _index_columns(index, index_key, index_vector, []).toDF("index_id", "vector"), "case_row"
        ),
        k,
        exclude_self,
        block_bytes,
    )
    return blocked.select("query_id", "rank", "index_id", "similarity")


def _query_columns(queries: DataFrame, key: str, vector: str) -> DataFrame:
    return queries.select(
        _id(queries, key).alias("query_id"), F.col(vector).alias("vector")
    ).where(_has_direction(F.col("vector")))


CASE_COLUMNS = {
    "past_customer_msg": "customer_msg_clean",
    "past_brand_reply": "brand_reply_clean",
}


def retrieve_similar(
    messages: DataFrame,
    index: DataFrame | BroadcastIndex,
    key: str = "message_id",
    k: int = fixed.RETRIEVED_PER_MESSAGE,
    exclude_self: bool = False,
    vector: str = "embedding",
    cases: dict[str, str] = CASE_COLUMNS,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Messages with ``retrieved``, the best ``k`` past cases, most similar first.

    Messages without a usable vector, or an empty index, give an empty array.  Ids may repeat or be
    NULL; every row gets its own cases, the same whether the index is broadcast or read in blocks.
    """
    small = index
    if isinstance(index, DataFrame):
        small = broadcast_index(index, key, vector, cases, max_broadcast_bytes)
    if small is not None:
        found = neighbours(small, F.col(vector), F.col(key), k, exclude_self)
        shown = F.transform(
            F.col("_found"),
            lambda case: F.struct(
                *[case[name].alias(name) for name in [*cases, "similarity"]]
            ),
        )
        return messages.withColumn("_found", found).withColumn("retrieved", shown).drop("_found")

    numbered = _numbered(messages, "_row")
    rows = numbered.select(
        F.col("_row").alias("row"),
        _id(numbered, key).alias("query_id"),
        F.col(vector).alias("vector"),
    ).where(_has_direction(F.col("vector")))
    names = list(dict.fromkeys(cases.values()))
    indexed = _numbered(_index_columns(index, key, vector, names), "case_row")
    best = _blocked_top_k(
        rows,
        indexed.select("case_row", F.col(key).alias("index_id"), F.col(vector).alias("vector")),
        k,
        exclude_self,
        block_bytes,
    )
    details = indexed.select(
        F.col("case_row").alias("_case"), *[F.col(c).alias(out) for out, c in cases.items()]
    )
    # one case may be the nearest one of very many messages
    described = lookup_join(best, details, "case_row", "_case", spread_by="row")
    per_message = described.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("rank", *cases, "similarity"))).alias("ranked")
    ).withColumnRenamed("row", "_match")  # at most k rows per message
    retrieved = F.transform(
        F.coalesce(F.col("ranked"), F.array()),
        lambda case: F.struct(*[case[name].alias(name) for name in [*cases, "similarity"]]),
    )
    joined = numbered.join(per_message, numbered["_row"] == per_message["_match"], "left")
    return joined.withColumn("retrieved", retrieved).drop("_match", "_row", "ranked")


def top_similarity(retrieved: Column) -> Column:
    """Best similarity of the retrieved cases, 0.0 if there are none."""
    return F.coalesce(F.array_max(F.transform(retrieved, lambda case: case["similarity"])),
                      F.lit(0.0))
