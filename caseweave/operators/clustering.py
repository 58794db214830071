"""Clusters of message vectors and their typical members.

k-means with several starts that advance together: one job over the points serves all starts, as their centres are
one tensor and each task returns the sums of its points for every start and cluster. Sums are of whole numbers
(coordinates times a power of two), so centres do not depend on how the points are dealt out.

A start is drawn as in k-means||: some rounds in which every point is a candidate with a probability that grows with its
squared distance from the candidates so far, then the candidates, weighted by the points next to them, are
reduced to the centres. A point's chance comes from a hash of its key, so a draw is repeated exactly anywhere.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from caseweave import fixed
from caseweave.functions.vectors import euclidean

BROADCAST_BYTES = 16 << 20  # of centres that are joined with all points
PARTITION_BYTES = 4 << 20  # of points; a task's share of one iteration
INIT_ROUNDS = 2
#: Candidates a round draws for each centre, on average.
OVERSAMPLING = 2
DECIMALS = 9  # of squared distances, before they are compared
TOLERANCE = 1e-4
_PRIME = (1 << 32) + 15
_CELLS = 1 << 21  # distances held at a time by one task


@dataclass
class Clusters:
    """The best of all starts: its centres, the sum of squared distances, and how many steps all starts took."""

    centres: np.ndarray
    cost: float
    steps: int

    def clusterCenters(self) -> list[np.ndarray]:
        return list(self.centres)


def point_hash(key: Column) -> Column:
    """A whole number below 2**32 for each key."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint")


def draw_factors(seed: int, start: int, round_no: int) -> tuple[int, int]:
    """``(h * a + b) mod p / p`` is the chance of a point with hash ``h`` in a round of a start."""
    a = 1 + (seed * 7919 + start * 104_729 + round_no * 1_299_709) % ((1 << 30) - 1)
    return a, (seed * 15_485_863 + start * 32_452_843 + round_no * 49_979_687) % (1 << 30)


# ---------------------------------------------------------------------------------------- inside tasks
def _kernel():
    """Functions used inside tasks, as closures so that they travel with the task."""

    decimals, held, prime = DECIMALS, _CELLS, _PRIME

    def points(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        column = batch.column("vector")
        rows = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)
        return batch.column("key").to_numpy(zero_copy_only=False), batch.column("hash").to_numpy(), rows

    def squared(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
        """(points, centres), rounded, so that equal distances are equal whatever the order of summation."""
        far = (rows**2).sum(1)[:, None] - 2 * rows @ centres.T + (centres**2).sum(1)[None, :]
        return np.round(np.maximum(far, 0.0), decimals)

    def nearest(rows: np.ndarray, centres: np.ndarray, sizes: list[int]) -> Iterator[tuple]:
        """(rows, start, the nearest centre of each row, its squared distance), in bounded steps."""
        ends = np.cumsum([0, *sizes])
        step = max(1, held // max(1, len(centres)))
        for i in range(0, len(rows), step):
            part = rows[i : i + step]
            far = squared(part, centres)
            for start in range(len(sizes)):
                own = far[:, ends[start] : ends[start + 1]]
                at = own.argmin(axis=1)
                yield slice(i, i + len(part)), start, at, own[np.arange(len(part)), at]

    def chance(hashes: np.ndarray, factors: tuple[int, int]) -> np.ndarray:
        a, b = factors
        return (hashes * a + b) % prime / prime

    return points, nearest, chance


def _sums(shared, scale: float):
    """Of a task's points: for each start and cluster their number, whole-number sums and squared distances."""
    points, nearest, _ = _kernel()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, sizes = shared.value
        ends = np.cumsum([0, *sizes])
        total = np.zeros((len(centres), centres.shape[1]), np.int64)
        count, cost = np.zeros(len(centres), np.int64), np.zeros(len(centres), np.float64)
        for batch in batches:
            if not batch.num_rows:
                continue
            _, _, rows = points(batch)
            whole = np.rint(rows * scale).astype(np.int64)
            for part, start, at, far in nearest(rows, centres, sizes):
                cell = at + ends[start]
                order = np.argsort(cell, kind="stable")
                found, first = np.unique(cell[order], return_index=True)
                total[found] += np.add.reduceat(whole[part][order], first, axis=0)
                count += np.bincount(cell, minlength=len(centres))
                cost += np.bincount(cell, far, len(centres))
        seen = np.flatnonzero(count)
        start = np.searchsorted(ends, seen, "right") - 1
        yield pa.record_batch(
            {
                "start": start.astype(np.int32),
                "cluster": (seen - ends[start]).astype(np.int32),
                "n": count[seen],
                "cost": cost[seen],
                "sums": pa.ListArray.from_arrays(
                    np.arange(len(seen) + 1, dtype=np.int32) * centres.shape[1], total[seen].ravel()
                ),
            }
        )

    return add


def _merge_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[int, int], list] = {}
    for batch in batches:
        sums = batch.column("sums").flatten().to_numpy().reshape(batch.num_rows, -1) if batch.num_rows else None
        columns = [batch.column(c).to_pylist() for c in ("start", "cluster", "n", "cost")]
        for i, (start, cluster, n, cost) in enumerate(zip(*columns, strict=True)):
            own = held.setdefault((start, cluster), [0, 0.0, 0])
            held[start, cluster] = [own[0] + n, own[1] + cost, own[2] + sums[i]]
    rows = sorted(held.items())
    yield pa.record_batch(
        {
            "start": pa.array([k[0] for k, _ in rows], pa.int32()),
            "cluster": pa.array([k[1] for k, _ in rows], pa.int32()),
            "n": pa.array([v[0] for _, v in rows], pa.int64()),
            "cost": pa.array([v[1] for _, v in rows], pa.float64()),
            "sums": pa.array([v[2] for _, v in rows], pa.list_(pa.int64())),
        }
    )


_SUMS = "start int, cluster int, n bigint, cost double, sums array<bigint>"


def _drawn(shared, factors: list[tuple[int, int]], spread: list[float] | None):
    """Candidates of a round: start, chance, key, vector. In the first round, without ``spread``, the least chance."""
    points, nearest, chance = _kernel()

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, sizes = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            _, hashes, rows = points(batch)
            found: list[tuple[int, np.ndarray, np.ndarray]] = []
            if spread is None:
                for start, own in enumerate(factors):
                    u = chance(hashes, own)
                    at = np.flatnonzero(u == u.min())  # keys settle ties
                    found.append((start, at, u[at]))
            else:
                for part, start, _, far in nearest(rows, centres, sizes):
                    u = chance(hashes[part], factors[start])
                    at = np.flatnonzero(u * spread[start] < far)
                    found.append((start, at + part.start, u[at]))
            at = np.concatenate([x for _, x, _ in found]) if found else np.zeros(0, np.int64)
            yield pa.record_batch(
                {
                    "start": np.concatenate([np.full(len(x), s, np.int32) for s, x, _ in found]),
                    "chance": np.concatenate([u for _, _, u in found]),
                    "key": batch.column("key").take(pa.array(at)),
                    "vector": batch.column("vector").take(pa.array(at)),
                }
            )

    return draw


# ---------------------------------------------------------------------------------------- on the driver
def _one_job(points: DataFrame, centres: np.ndarray, sizes: list[int], scale: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(numbers, sums, costs) of all clusters of all starts, merged in two steps; what is collected is bounded."""
    sent = points.sparkSession.sparkContext.broadcast((centres, sizes))
    parts = points.mapInArrow(_sums(sent, scale), _SUMS)
    groups = math.isqrt(points.rdd.getNumPartitions())
    if groups > 4:  # else the driver merges the few parts
        parts = parts.repartition(groups).mapInArrow(_merge_sums, _SUMS)
    (merged,) = _merge_sums(parts.toArrow().to_batches())
    sent.destroy()
    ends = np.cumsum([0, *sizes])
    at = ends[merged.column("start").to_numpy()] + merged.column("cluster").to_numpy()
    number, cost = np.zeros(len(centres), np.int64), np.zeros(len(centres))
    sums = np.zeros(centres.shape, np.int64)
    number[at], cost[at] = merged.column("n").to_numpy(), merged.column("cost").to_numpy()
    if len(at):
        sums[at] = merged.column("sums").flatten().to_numpy().reshape(len(at), -1)
    return number, sums, cost


def _reduced(candidates: np.ndarray, weight: np.ndarray, k: int) -> np.ndarray:
    """``k`` of the weighted candidates: the heaviest, then always the one whose weight times squared distance is largest."""
    k = min(k, len(candidates))
    chosen = [int(weight.argmax())]
    while len(chosen) < k:
        far = ((candidates[:, None, :] - candidates[chosen][None, :, :]) ** 2).sum(2).min(1)
        score = weight * np.round(far, DECIMALS)
        if not score.max() > 0:  # all others are copies of the chosen
            break
        chosen.append(int(score.argmax()))
    return candidates[chosen]


def first_centres(points: DataFrame, k: int, seed: int, n_starts: int, scale: float, rounds: int = INIT_ROUNDS) -> list[np.ndarray]:
    """Centres to begin with, for each start. Every round is two jobs for all starts together."""
    kind = points.schema["key"].dataType.simpleString()
    schema = f"start int, chance double, key {kind}, vector {points.schema['vector'].dataType.simpleString()}"
    context = points.sparkSession.sparkContext
    factors = [draw_factors(seed, s, 0) for s in range(n_starts)]
    drawn = points.mapInArrow(_drawn(context.broadcast((None, None)), factors, None), schema)
    first = drawn.groupBy("start").agg(F.min_by("vector", F.struct("chance", "key")).alias("vector")).orderBy("start")
    candidates = [np.array([r["vector"]], np.float64) for r in first.collect()]
    if not candidates:
        return []

    def flat() -> tuple[np.ndarray, list[int]]:
        return np.concatenate(candidates), [len(c) for c in candidates]

    for round_no in range(1, rounds + 1):
        centres, sizes = flat()
        _, _, cost = _one_job(points, centres, sizes, scale)
        ends = np.cumsum([0, *sizes])
        total = [float(cost[a:b].sum()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        spread = [t / (OVERSAMPLING * k) for t in total]
        factors = [draw_factors(seed, s, round_no) for s in range(n_starts)]
        # 2k rows a start on average, whatever the number of points
        found = points.mapInArrow(_drawn(context.broadcast((centres, sizes)), factors, spread), schema)
        rows = found.orderBy("start", "chance", "key").select("start", "vector").collect()
        for start in range(n_starts):
            new = [r["vector"] for r in rows if r["start"] == start]
            if new:
                candidates[start] = np.concatenate([candidates[start], np.array(new, np.float64)])
    centres, sizes = flat()
    number, _, _ = _one_job(points, centres, sizes, scale)
    ends = np.cumsum([0, *sizes])
    return [_reduced(centres[a:b], number[a:b], k) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def run_clustering(
    df: DataFrame,
    n_clusters: int = fixed.N_CLUSTERS,
    seed: int = fixed.DISCOVERY_SEED,
    n_starts: int = fixed.N_CLUSTER_STARTS,
    vector: str = "embedding",
    out: str = "cluster",
    max_iter: int = fixed.MAX_CLUSTER_ITERATIONS,
    key: str | None = None,
    tolerance: float = TOLERANCE,
) -> tuple[DataFrame, Clusters]:
    """k-means, the best of ``n_starts`` starts; rows with their cluster, and the clusters.

    A start stops when none of its centres moves by more than ``tolerance``.  ``key`` identifies a
    point for the draws (the vector itself by default).  Rows without a vector of finite numbers get no
    cluster; with fewer different points than ``n_clusters`` there are fewer clusters.
    """
    spark = df.sparkSession
    identity = F.col(key) if key else F.xxhash64(vector)
    finite = F.forall(vector, lambda x: F.abs(x) < float("inf"))  # NaN is larger than infinity
    usable = df.where(F.col(vector).isNotNull() & finite)
    points = usable.select(
        identity.alias("key"), point_hash(identity).alias("hash"), F.col(vector).cast("array<double>").alias("vector")
    )
    widest = F.max(F.array_max(F.transform(vector, lambda x: F.abs(x.cast("double"))))).alias("widest")
    n, dims, largest = usable.agg(F.count(F.lit(1)), F.max(F.size(vector)), widest).first()
    if not n:
        return df.withColumn(out, F.lit(None).cast("int")), Clusters(np.zeros((0, 0)), 0.0, 0)
    # sums of all points stay below 2**62
    scale = 2.0 ** (61 - math.ceil(math.log2(n + 1)) - math.ceil(math.log2(max(largest, 1e-30))))
    # every iteration is a job over all partitions; a small table needs few of them
    points = points.coalesce(max(1, math.ceil(n * (8 * dims + 32) / PARTITION_BYTES)))
    points = points.persist(StorageLevel.MEMORY_AND_DISK)  # read by every iteration
    try:
        centres = first_centres(points, n_clusters, seed, n_starts, scale)
        costs, active, steps = [math.inf] * n_starts, list(range(n_starts)), 0
        while active and steps < max_iter:
            sizes = [len(centres[s]) for s in active]
            number, sums, _ = _one_job(points, np.concatenate([centres[s] for s in active]), sizes, scale)
            steps += 1
            ends, still = np.cumsum([0, *sizes]), []
            for i, s in enumerate(active):
                own = slice(ends[i], ends[i + 1])
                some = number[own] > 0  # an empty cluster keeps its centre
                moved = centres[s].copy()
                moved[some] = sums[own][some] / scale / number[own][some, None]
                if math.sqrt(((moved - centres[s]) ** 2).sum(1).max()) > tolerance:
                    still.append(s)
                centres[s] = moved
            active = still
        sizes = [len(c) for c in centres]
        _, _, cost = _one_job(points, np.concatenate(centres), sizes, scale)
        ends = np.cumsum([0, *sizes])
        costs = [round(float(cost[a:b].sum()), 6) for a, b in zip(ends[:-1], ends[1:], strict=True)]
    finally:
        points.unpersist()
    best = int(np.argmin(costs))
    model = Clusters(centres[best], costs[best], steps)
    return df.withColumn(out, _assigned(spark.sparkContext.broadcast(model.centres), F.col(vector))), model


def _assigned(centres, vector: Column) -> Column:
    """The nearest centre of each vector; the smallest number of equally near ones, null without a vector."""
    _, nearest, _ = _kernel()

    @F.arrow_udf("int")
    def assign(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for vectors in batches:
            valid = vectors.is_valid().to_numpy(zero_copy_only=False).copy()
            cluster = np.zeros(len(vectors), np.int32)
            if valid.any():
                rows = vectors.flatten().to_numpy(zero_copy_only=False).reshape(int(valid.sum()), -1)
                finite = np.isfinite(rows).all(axis=1)
                valid[valid] = finite
                if finite.any():
                    own = [at for _, _, at, _ in nearest(rows[finite], centres.value, [len(centres.value)])]
                    cluster[valid] = np.concatenate(own)
            yield pa.array(cluster, pa.int32(), mask=~valid)

    return assign.asNondeterministic()(vector.cast("array<double>"))


def model_centres(df: DataFrame, model: Clusters) -> DataFrame:
    """``(cluster, centre)`` of a fitted model, one row per cluster."""
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.centres)]
    return df.sparkSession.createDataFrame(rows, "cluster int, centre array<double>")


def mean_centres(df: DataFrame, cluster: str, vector: str = "embedding") -> DataFrame:
    """``(cluster, centre)`` as the mean vector per group; sums are merged map-side."""
    point = array_to_vector(F.col(vector).cast("array<double>"))
    return df.groupBy(F.col(cluster).alias("cluster")).agg(
        vector_to_array(Summarizer.mean(point)).alias("centre")
    )


def nearest_per_cluster(
    df: DataFrame,
    centres: DataFrame,
    cluster: str,
    key: str,
    n: int = fixed.EXAMPLES_PER_CLUSTER,
    vector: str = "embedding",
) -> DataFrame:
    """The ``n`` rows closest to the centre of their cluster, with distance and rank.

    The bytes of the centres (those of a model, or a stored table) are measured; small ones are
    broadcast, so the vectors are not shuffled.  Only keys and distances are ranked, and at most ``n`` per
    cluster leave a map task.
    """
    renamed = centres.select(F.col("cluster").alias("_cluster"), "centre")
    size = renamed.agg(F.sum(F.size("centre") * F.lit(8).cast("bigint") + 32)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        renamed = F.broadcast(renamed)
    distances = df.join(renamed, F.col(cluster) == F.col("_cluster")).select(
        F.col(cluster).alias("cluster"),
        F.col(key),
        F.round(euclidean(F.col(vector), F.col("centre")), 9).alias("distance"),
    )
    order = W.partitionBy("cluster").orderBy("distance", key)
    return distances.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def cluster_sizes(assigned: DataFrame, cluster: str = "cluster") -> DataFrame:
    return assigned.groupBy(F.col(cluster).alias("cluster")).agg(F.count(F.lit(1)).alias("n_rows"))
