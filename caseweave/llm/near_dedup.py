"""Near-duplicates by improved consistent weighted sampling over TF-IDF shingles.

A text is its weighted set of shingles (``SHINGLE`` words; a shorter text is one shingle): a shingle weighs its count
times an inverse document frequency, ``ln(1 + 1 / (share + SMOOTHING))``, with the share of the documents that hold it.
Shares of ``FREQUENT`` and more are counted exactly; below it all shingles weigh the same, as hardly any do otherwise. A
document's weights therefore do not depend on the size of the table, and the frequent shingles, which every task gets, are
at most ``1 / FREQUENT`` times as many as an average document has. They are found in two passes: counts in ``DF_BUCKETS``
hash buckets leave few buckets that can hold one, at any size, unless documents have very many shingles; those in the
buckets that are left are counted one by one. The smoothing keeps a large group of near copies from making its own shingles weightless, which
would part the copies.

Consistent weighted sampling draws ``BANDS * ROWS`` samples (shingle, level) per text: two texts agree on a sample
with a probability equal to their weighted Jaccard similarity. Texts that agree on a whole band are candidates.
Equal texts are one class from the start and take part once. Within a bucket of a band, texts are first compared with
the bucket's leader and not all with all, which links most of a large group. Where candidates still fall into several
components, they are put in blocks of ``BLOCK`` texts and ``BLOCK_SHINGLES`` shingles, by component, and pairs of blocks that share a bucket are
compared in one task each, unless both hold one and the same component. A task skips pairs that are linked already and
reports only links that join components. So no candidate pair that would join two components is left out, and no
group is listed pair by pair. Each comparison computes the exact weighted Jaccard similarity of the two whole texts.
Components are found by repeated hooking to the smallest neighbour.

Defined cases: a null text is a class of its own row's id; texts without words are classes of equal texts only;
rows that share a doc_id are told apart by their text; classes are named by their smallest doc_id (null ids last).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseweave.llm.common import fresh, numbered, ordered_starts, steps, stored, texts
from caseweave.llm.words import mix, whole, windows, word_hashes

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 12, 3
DF_BUCKETS = 1 << 20
FREQUENT = 0.01
SMOOTHING = 0.5
_DRAWS = 1 << 16
#: Texts of a block that one task compares with another block, and their shingles but for the last text's.
BLOCK, BLOCK_SHINGLES = 256, 1 << 20
#: Bytes of a list of text keys up to which it is sent to every task.
BROADCAST_BYTES = 32 << 20


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes ascending, counts, first index of each text and one more) of the texts' shingle sets."""
    hashes, starts = word_hashes(data, offsets)
    n = np.diff(starts)
    wide = windows(hashes, SHINGLE)
    keep = whole(starts, SHINGLE, len(wide))
    text_of = np.repeat(np.arange(len(n)), n)
    grams, owner = wide[keep], text_of[: len(wide)][keep]
    brief = np.flatnonzero((n > 0) & (n < SHINGLE))
    if len(brief):
        extra = []
        for i in brief:
            h = np.uint64(n[i])
            for x in hashes[starts[i] : starts[i + 1]]:
                h = mix(np.array([h ^ x]))[0]
            extra.append(h)
        grams, owner = np.concatenate([grams, np.array(extra, np.uint64)]), np.concatenate([owner, brief])
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    counts = np.diff(np.append(first, len(grams)))
    return grams[first], counts, np.searchsorted(owner[first], np.arange(len(n) + 1))


def _bucket(grams: np.ndarray) -> np.ndarray:
    return (grams % np.uint64(DF_BUCKETS)).astype(np.int64)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(DF_BUCKETS, np.int64)
    for batch in batches:
        for rows in steps(batch, "text"):
            grams, _, starts = shingle_sets(*texts(rows.column("text")))
            owner = np.repeat(np.arange(rows.num_rows), np.diff(starts))
            once = np.unique(owner * DF_BUCKETS + _bucket(grams)) % DF_BUCKETS
            counts += np.bincount(once, minlength=DF_BUCKETS)
    used = np.flatnonzero(counts)
    yield pa.record_batch({"bucket": used.astype(np.int32), "df": counts[used]})


def _members(buckets):
    """How many of a task's documents hold each shingle of the given buckets (a broadcast bit per bucket)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def merged(parts) -> tuple[np.ndarray, np.ndarray]:
            grams, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(grams, kind="stable")
            grams, counts = grams[order], counts[order]
            first = np.flatnonzero(np.append(True, grams[1:] != grams[:-1])) if len(grams) else np.zeros(0, np.int64)
            return grams[first], np.add.reduceat(counts, first) if len(first) else counts

        def rows() -> pa.RecordBatch:
            return pa.record_batch({"gram": held[0].view(np.int64), "df": held[1]})

        for batch in batches:
            parts = [held]
            for texts_ in steps(batch, "text"):
                grams, _, _ = shingle_sets(*texts(texts_.column("text")))
                own = np.sort(grams[buckets.value[_bucket(grams)]])
                parts.append((own, np.ones(len(own), np.int64)))
            held = merged(parts)
            if len(held[0]) > 1 << 20:
                yield rows()
                held = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        yield rows()

    return count


def frequent_shingles(texts_: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """The number of documents, and the shingles that ``FREQUENT`` or more of them hold (ascending) with their counts."""
    spark = texts_.sparkSession
    n = texts_.count()
    tables = stored(texts_.mapInArrow(_frequencies, "bucket int, df long"), "frequencies")
    df = np.zeros(DF_BUCKETS, np.int64)  # of fixed size
    for r in tables.groupBy("bucket").agg(F.sum("df").alias("df")).toArrow().to_batches():
        df[r.column("bucket").to_numpy()] = r.column("df").to_numpy()
    # a bucket's count is no less than that of any of its shingles
    least = max(2, int(np.ceil(FREQUENT * n)))
    wanted = df >= least
    if not wanted.any():
        return n, np.zeros(0, np.uint64), np.zeros(0, np.int64)
    sent = spark.sparkContext.broadcast(wanted)
    counted = stored(texts_.mapInArrow(_members(sent), "gram long, df long"), "members")
    often = counted.groupBy("gram").agg(F.sum("df").alias("df")).where(F.col("df") >= least).toArrow()
    grams, counts = often.column("gram").to_numpy().view(np.uint64), often.column("df").to_numpy()
    order = np.argsort(grams)
    return n, grams[order], counts[order]


class Weights:
    """Log weights of shingles: those of the frequent ones, and one for all others."""

    def __init__(self, n: int, grams: np.ndarray, df: np.ndarray):
        self.grams = grams
        share = np.append(df / max(1, n), 0.0)  # the last is that of all other shingles
        # rounded, so that machines whose logarithms differ in the last bit agree
        self.idf = np.round(np.log1p(1 / (share + SMOOTHING)), 6)
        self.log_idf = np.round(np.log(self.idf), 6)

    def _at(self, grams: np.ndarray) -> np.ndarray:
        if not len(self.grams):
            return np.zeros(len(grams), np.int64)
        at = np.searchsorted(self.grams, grams)
        at[at == len(self.grams)] = 0
        return np.where(self.grams[at] == grams, at, len(self.grams))

    def log(self, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self.log_idf[self._at(grams)] + np.round(np.log(counts), 6)

    def plain(self, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self.idf[self._at(grams)] * counts


class Sampler:
    """Improved consistent weighted sampling with tabled draws."""

    def __init__(self, samples: int = BANDS * ROWS, seed: int = 20):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.step = np.round(rng.gamma(2, 1, _DRAWS), 6) + 1e-6
        self.log_c = np.round(np.log(rng.gamma(2, 1, _DRAWS)), 6)
        self.shift = np.round(rng.random(_DRAWS), 6)
        self.keys = rng.integers(1, 1 << 63, samples, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def draw(self, grams: np.ndarray, log_weight: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """(texts with a shingle, samples): the sampled (shingle, level) of each, as one hash."""
        full = np.flatnonzero(np.diff(starts))
        begin = starts[full]
        sizes = np.diff(np.append(begin, len(grams)))
        out = np.zeros((len(full), len(self.keys)), np.uint64)
        for k, key in enumerate(self.keys):
            at = ((grams * key) >> np.uint64(48)).astype(np.int64)
            step, shift = self.step[at], self.shift[at]
            level = np.floor(log_weight / step + shift)
            rank = self.log_c[at] - step * (level - shift + 1)
            least = np.minimum.reduceat(rank, begin)
            ties = np.flatnonzero(rank == np.repeat(least, sizes))
            pick = ties[np.searchsorted(ties, begin)]
            out[:, k] = mix(grams[pick] ^ mix(level[pick].astype(np.int64).astype(np.uint64) + np.uint64(k << 32)))
        return out


def _signatures(weights, key: str):
    """For each row: key, text key, shingles and band hashes. A text that a task meets again isn't sampled again."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler, w, seen = Sampler(), weights.value, {}
        for batch in batches:
            names = batch.column("h").to_pylist()
            first, fresh_rows = {}, []
            for i, h in enumerate(names):
                if h is not None and h not in seen and h not in first:
                    first[h] = i
                    fresh_rows.append(i)
            new = batch.select(["h", "text"]).take(pa.array(fresh_rows, pa.int64()))
            for rows in steps(new, "text"):
                grams, counts, starts = shingle_sets(*texts(rows.column("text")))
                drawn = sampler.draw(grams, w.log(grams, counts), starts) if len(grams) else np.zeros((0, BANDS * ROWS), np.uint64)
                bands = np.zeros((len(drawn), BANDS), np.uint64)
                for r in range(ROWS):
                    bands = mix(bands + drawn[:, r::ROWS])
                full = iter(bands)
                for h, size in zip(rows.column("h").to_pylist(), np.diff(starts), strict=True):
                    seen[h] = (int(size), next(full).tobytes() if size else None)
            yield pa.record_batch(
                {
                    "key": batch.column(key),
                    "h": batch.column("h"),
                    "n_shingles": pa.array([0 if h is None else seen[h][0] for h in names], pa.int64()),
                    "bands": pa.array([None if h is None else seen[h][1] for h in names], pa.binary()),
                }
            )
            if len(seen) > 100_000:
                seen = {}

    return sign


def _sets(weights):
    """Text key and weighted set, as bytes, of the wanted texts; each text once per task."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, seen = weights.value, set()
        for batch in batches:
            rows = [i for i, h in enumerate(batch.column("h").to_pylist()) if not (h in seen or seen.add(h))]
            for part in steps(batch.take(pa.array(rows, pa.int64())), "text"):
                grams, counts, starts = shingle_sets(*texts(part.column("text")))
                plain = w.plain(grams, counts).astype(np.float32)
                cut = list(zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True))
                yield pa.record_batch(
                    {
                        "h": part.column("h"),
                        "grams": pa.array([grams[a:b].tobytes() for a, b in cut], pa.binary()),
                        "weights": pa.array([plain[a:b].tobytes() for a, b in cut], pa.binary()),
                    }
                )

    return read


def weighted_jaccard(grams_a: np.ndarray, a: np.ndarray, grams_b: np.ndarray, b: np.ndarray) -> float:
    """Sum of smaller weights over sum of larger weights; the hashes ascend."""
    at = np.searchsorted(grams_b, grams_a)
    at[at == len(grams_b)] = 0
    both = grams_b[at] == grams_a if len(grams_b) else np.zeros(len(grams_a), bool)
    shared = float(np.minimum(a[both], b[at[both]]).sum(dtype=np.float64))
    total = float(a.sum(dtype=np.float64) + b.sum(dtype=np.float64)) - shared
    return shared / total if total else 0.0


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [batch.column(c) for c in ("a", "b", "grams_a", "weights_a", "grams_b", "weights_b")]
        sims = []
        for i in range(batch.num_rows):
            ga, wa, gb, wb = (c[i].as_py() for c in columns[2:])
            sims.append(
                weighted_jaccard(np.frombuffer(ga, np.uint64), np.frombuffer(wa, np.float32), np.frombuffer(gb, np.uint64), np.frombuffer(wb, np.float32))
            )
        yield pa.record_batch({"a": columns[0], "b": columns[1], "similarity": np.array(sims, np.float64)})


def _weighted_sets(texts_of: DataFrame, keyed: DataFrame, weights) -> DataFrame:
    """(h, grams, weights) of the wanted text keys, each text once."""
    needed = stored(texts_of.select("h").distinct(), "wanted")
    wanted = F.broadcast(needed) if needed.count() * 40 <= BROADCAST_BYTES else needed
    sets = keyed.join(wanted, "h", "left_semi").mapInArrow(_sets(weights), "h binary, grams binary, weights binary")
    # a text that several tasks met has equal rows; one is enough. Stored, so that a join with a pivot that has
    # very many partners reads a plain table, which can be split
    return stored(sets.dropDuplicates(["h"]), "sets")


def _verify(pairs: DataFrame, keyed: DataFrame, weights) -> DataFrame:
    """The pairs (a, b) of text keys with their similarity, from the whole texts."""
    sets = _weighted_sets(pairs.select(F.explode(F.array("a", "b")).alias("h")), keyed, weights)
    side = lambda s: sets.select(F.col("h").alias(s), F.col("grams").alias(f"grams_{s}"), F.col("weights").alias(f"weights_{s}"))
    return (
        pairs.join(side("a"), "a")
        .join(side("b"), "b")
        .mapInArrow(_compare, "a binary, b binary, similarity double")
    )


def _compare_blocks(threshold: float):
    """Compares the texts of two blocks, sorted by (family, i, j), and reports links that join components."""

    def links(rows: list[dict]) -> Iterator[tuple[bytes, bytes]]:
        parent: dict[bytes, bytes] = {}

        def root(x: bytes) -> bytes:
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        left = [r for r in rows if r["block"] == rows[0]["i"]]
        right = [r for r in rows if r["block"] == rows[0]["j"]]
        if not left or not right:
            return
        bands = [np.array([np.frombuffer(r["bands"], np.uint64) for r in side]) for side in (left, right)]
        total = [np.array([np.frombuffer(r["weights"], np.float32).sum(dtype=np.float64) for r in side]) for side in (left, right)]
        for a, row in enumerate(left):
            # a text cannot be more alike than the ratio of the smaller to the larger weight
            near = np.minimum(total[0][a], total[1]) >= threshold * np.maximum(total[0][a], total[1]) * (1 - 1e-9)
            shared = (bands[0][a] == bands[1]).any(axis=1) & near
            grams, weights = np.frombuffer(row["grams"], np.uint64), np.frombuffer(row["weights"], np.float32)
            for b in np.flatnonzero(shared).tolist():
                other = right[b]
                ra, rb = root(row["root"]), root(other["root"])
                if ra == rb:
                    continue
                if weighted_jaccard(grams, weights, np.frombuffer(other["grams"], np.uint64), np.frombuffer(other["weights"], np.float32)) >= threshold:
                    parent[ra] = rb
                    yield row["h"], other["h"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def report() -> pa.RecordBatch:
            found = list(links(held)) if held else []
            return pa.record_batch(
                {"a": pa.array([x for x, _ in found], pa.binary()), "b": pa.array([x for _, x in found], pa.binary())}
            )

        for batch in batches:
            for i in range(batch.num_rows):  # at most two blocks are held
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                if held and any(row[c] != held[0][c] for c in ("family", "i", "j")):
                    yield report()
                    held = []
                held.append(row)
        yield report()

    return compare


def components(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """(h, root): the smallest key that each node of ``edges`` (a, b) reaches; a table per round."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = stored(both, "edges")
    roots = stored(
        both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("h"), F.least("a", "b").alias("root")), "roots"
    )
    while True:
        # each root learns the smallest root next to its tree, then pointers are followed twice
        near = (
            both.join(roots.select(F.col("h").alias("a"), F.col("root").alias("root_a")), "a")
            .join(roots.select(F.col("h").alias("b"), F.col("root").alias("root_b")), "b")
            .where("root_b < root_a")
            .groupBy(F.col("root_a").alias("h"))
            .agg(F.min("root_b").alias("next"))
        )
        near = stored(near, "hooks")
        if near.isEmpty():
            return roots
        hop = near.select(F.col("h").alias("root"), "next")
        hop2 = near.select(F.col("h").alias("next"), F.col("next").alias("next2"))
        moved = roots.join(hop, "root", "left").join(hop2, "next", "left")
        roots = stored(moved.select("h", F.coalesce("next2", "next", "root").alias("root")), "roots")


def _linked(members: DataFrame, classes: DataFrame, keyed: DataFrame, weights, threshold: float) -> DataFrame:
    """Components of the texts in ``members`` (bucket, h): (h, root), for texts with a link."""
    leaders = members.groupBy("bucket").agg(F.min("h").alias("leader"))
    pairs = members.join(leaders, "bucket").where("h <> leader").select(F.col("leader").alias("a"), F.col("h").alias("b"))
    pairs = stored(pairs.distinct(), "pairs")
    links = stored(_verify(pairs, keyed, weights).where(F.col("similarity") >= threshold).select("a", "b"), "links")
    roots = components(links)

    # candidates that are connected by buckets, but not yet by links
    families = components(pairs).withColumnRenamed("root", "family")
    state = families.join(roots, "h", "left").withColumn("root", F.coalesce("root", "h"))
    mixed = state.groupBy("family").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    state = state.join(mixed.select("family"), "family", "left_semi").join(classes.select("h", "n_shingles"), "h")
    state = stored(state.withColumn("one", F.lit(1)), "state")
    if state.isEmpty():
        return roots
    placed = ordered_starts(state, ["family"], ["root", "h"], {"place": "one", "shingles": "n_shingles"})
    # the number rises where either count passes a whole block, so a block exceeds neither
    block = F.floor(F.col("place") / BLOCK) + F.floor(F.col("shingles") / BLOCK_SHINGLES)
    placed = stored(placed.select("family", "h", "root", block.cast("long").alias("block")), "placed")
    spread = stored(members.join(placed, "h").select("bucket", "family", "block").distinct(), "spread")
    met = (
        spread.withColumnRenamed("block", "i")
        .join(spread.select("bucket", F.col("block").alias("j")), "bucket")
        .where("i <= j")
        .select("family", "i", "j")
        .distinct()
    )
    blocks = placed.groupBy("family", "block").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    side = lambda s: blocks.select("family", F.col("block").alias(s), F.col("low").alias(f"low_{s}"), F.col("high").alias(f"high_{s}"))
    met = (
        met.join(side("i"), ["family", "i"])
        .join(side("j"), ["family", "j"])
        .where("not (low_i = high_i and low_j = high_j and low_i = low_j)")
        .select("family", "i", "j")
    )
    sets = _weighted_sets(placed, keyed, weights).join(classes.select("h", "bands"), "h")
    met = stored(met, "met")
    shown = met.select("family", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("block"))
    more = (
        shown.join(placed, ["family", "block"])
        .join(sets, "h")
        .select("family", "i", "j", "block", "h", "root", "bands", "grams", "weights")
        .repartition("family", "i", "j")
        .sortWithinPartitions("family", "i", "j")
        .mapInArrow(_compare_blocks(threshold), "a binary, b binary")
    )
    more = stored(more, "more")
    return components(links.unionByName(more)) if not more.isEmpty() else roots


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, key: str = "doc_id") -> DataFrame:
    """One row per document: key, class_id (the smallest key of its class), class_size (documents)."""
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()
    keyed = docs.select(F.col(key).alias("key"), F.col("text").cast("string").alias("text"))
    keyed = keyed.withColumn("h", F.unhex(F.md5("text")))

    weights = spark.sparkContext.broadcast(Weights(*frequent_shingles(keyed.select("text"))))

    signed = stored(
        keyed.mapInArrow(_signatures(weights, "key"), f"key {kind}, h binary, n_shingles long, bands binary"), "signatures"
    )
    classes = stored(
        signed.where("h is not null").groupBy("h").agg(F.min("key").alias("low"), F.count(F.lit(1)).alias("n"), F.first("bands").alias("bands"), F.first("n_shingles").alias("n_shingles")),
        "classes",
    )
    numbers = F.sequence(F.lit(0), F.lit(BANDS - 1))
    banded = classes.where("bands is not null").select("h", "bands", F.explode(numbers).alias("band"))
    bucket = F.xxhash64("band", F.substring(F.col("bands"), 8 * F.col("band") + 1, F.lit(8))).alias("bucket")
    members = banded.select(bucket, "h")
    shared = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    members = stored(members.join(shared, "bucket", "left_semi"), "members")
    roots = _linked(members, classes, keyed.select("h", "text"), weights, threshold)

    rooted = classes.join(roots, "h", "left").select("h", "low", "n", F.coalesce("root", "h").alias("root"))
    groups = rooted.groupBy("root").agg(F.min("low").alias("class_id"), F.sum("n").alias("class_size"))
    named = stored(rooted.join(groups, "root").select("h", "class_id", "class_size"), "groups")
    out = signed.select("key", "h").join(named, "h", "left")
    return out.select(
        F.col("key").alias(key),
        F.when(F.col("h").isNull(), F.col("key")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"),
    )


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents with one of each class: the one with the smallest doc_id; all their columns."""
    (row,) = fresh(docs, "row_key")
    rows = numbered(docs, row)
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col(row))
    classes = near_duplicates(rows, threshold, key=row)
    groups = stored(classes.where("class_size > 1").join(rows.select(row, "doc_id"), row), "groups")
    first = groups.groupBy("class_id").agg(F.min(order)[row].alias(row))
    dropped = stored(groups.select(row).join(first, row, "left_anti"), "dropped")
    if dropped.count() * 300 <= BROADCAST_BYTES:
        dropped = F.broadcast(dropped)
    return rows.join(dropped, row, "left_anti").select(*docs.columns)
