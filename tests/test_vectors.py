from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseweave.functions import vectors as V
from caseweave.operators import clustering as C
from caseweave.operators import retrieval as R
from caseweave.operators.clustering import (
    cluster_sizes, mean_centres, model_centres, nearest_per_cluster, run_clustering,
)
from caseweave.operators.embedding import (
    embed, embed_with, fit_embedder, load_embedder, save_embedder, word_feature,
)
from caseweave.operators.retrieval import (
    add_norm, broadcast_index, build_index, partial_index, retrieve_similar, sample_index,
    top_k_similar, top_similarity,
)
from caseweave.operators.sampling import sample_exact

BLOCKED = {"max_broadcast_bytes": 0, "block_bytes": 2000}
TEXTS = "message_id long, customer_msg_clean string, brand_reply_clean string, embedding array<float>"


def vectors(n=60, d=8, seed=3):
    rng = np.random.default_rng(seed)
    rows = rng.normal(size=(n, d)).astype("float32")
    rows[10] = rows[20] = rows[30]  # equal vectors: ties by id
    rows[40] = 0  # zero vector
    return rows


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, f"m{i}", f"r{i}", [float(x) for x in v]) for i, v in enumerate(rows)], TEXTS
    )


def brute_force(rows, k, exclude_self):
    rows = rows.astype("float64")
    norms = np.linalg.norm(rows, axis=1)
    best = {}
    for q in range(len(rows)):
        if norms[q] == 0:
            best[q] = []
            continue
        scored = [
            (-round(float(rows[q] @ rows[i] / norms[q] / norms[i]), 9), i)
            for i in range(len(rows))
            if norms[i] > 0 and not (exclude_self and i == q)
        ]
        best[q] = sorted(scored)[:k]
    return best


@pytest.mark.parametrize("limits", [{}, BLOCKED])
@pytest.mark.parametrize("k, exclude_self", [(3, False), (3, True), (20, True), (100, False)])
def test_top_k_is_exact(spark, limits, k, exclude_self):
    rows = vectors()
    df = frame(spark, rows)
    got = top_k_similar(df, df, "message_id", "message_id", k, exclude_self, **limits).collect()
    want = brute_force(rows, k, exclude_self)
    by_query = {q: [] for q in want}
    for r in sorted(got, key=lambda r: r.rank):
        by_query[r.query_id].append((-r.similarity, r.index_id))
    for q, expected in want.items():
        assert [i for _, i in by_query[q]] == [i for _, i in expected]
        assert np.allclose([s for s, _ in by_query[q]], [s for s, _ in expected], atol=2e-9)


def test_smaller_k_is_a_prefix(spark):
    df = frame(spark, vectors())
    few = top_k_similar(df, df, "message_id", "message_id", 3).collect()
    more = top_k_similar(df, df, "message_id", "message_id", 4).collect()
    assert {tuple(r) for r in few} <= {tuple(r) for r in more}


@pytest.mark.parametrize("limits", [{}, BLOCKED])
def test_retrieved_cases(spark, limits):
    df = frame(spark, vectors())
    got = {
        r.message_id: r
        for r in retrieve_similar(df, df, exclude_self=True, **limits)
        .withColumn("best", top_similarity(F.col("retrieved"))).collect()
    }
    assert len(got) == 60
    assert got[40].retrieved == [] and got[40].best == 0.0
    assert [c.past_customer_msg for c in got[10].retrieved[:2]] == ["m20", "m30"]
    assert got[10].retrieved[0].past_brand_reply == "r20" and got[10].best == 1.0
    assert all(len(r.retrieved) == 3 for i, r in got.items() if i != 40)


def test_self_match_by_default(spark):
    df = frame(spark, vectors())
    got = retrieve_similar(df, df).where("message_id = 5").first().retrieved
    assert got[0].past_customer_msg == "m5" and got[0].similarity == 1.0


@pytest.mark.parametrize("limits", [{}, BLOCKED])
def test_empty_index_and_missing_vectors(spark, limits):
    df = frame(spark, vectors())
    none = retrieve_similar(df, df.where("false"), **limits)
    assert none.where("size(retrieved) > 0").count() == 0 and none.count() == 60
    holes = df.withColumn("embedding", F.when(F.col("message_id") % 2 == 0, F.col("embedding")))
    got = retrieve_similar(holes, df, **limits)
    assert got.where("size(retrieved) = 3").count() == 29  # 30 even ids, one zero vector


@pytest.mark.parametrize("limits", [{}, BLOCKED])
def test_repeated_and_missing_ids_and_odd_vectors(spark, limits):
    nan, inf = float("nan"), float("inf")
    index = spark.createDataFrame(
        [(0, "m0", "r0", [1.0, 0.0]), (1, "m1", "r1", [0.9, 0.1]), (4, "m4", "r4", [nan, 1.0]), (-1, "m-", "r-", [0.2, 1.0]),
         (5, "m5", "r5", [0.0, 1.0]), (6, "m6", "r6", [inf, 1.0]), (7, "m7", "r7", None), (None, "mx", "rx", [1.0, 0.0])], TEXTS,
    )
    messages = spark.createDataFrame(
        [(100, "a", [1.0, 0.0]), (100, "b", [0.0, 1.0]), (None, "c", [1.0, 0.0]), (None, "d", None), (0, "e", [1.0, 0.0]),
         (200, "f", [nan, 0.0]), (200, "g", [inf, 0.0])], "message_id long, message string, embedding array<float>",
    )
    got = retrieve_similar(messages, index, k=2, exclude_self=True, **limits).collect()
    found = {r.message: [c.past_brand_reply for c in r.retrieved] for r in got}
    assert found == {
        "a": ["r0", "r1"], "b": ["r5", "r-"], "c": ["r0", "r1"], "d": [], "e": ["r1", "r-"], "f": [], "g": [],
    }
    top = top_k_similar(messages, index, "message_id", "message_id", 2, True, **limits)
    assert top.count() == 8 and top.where("query_id is null").count() == 2


def clustered(n, n_centres, dims=16, seed=3, spread=0.05):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n_centres, dims))
    return (centres[rng.integers(0, n_centres, n)] + spread * rng.normal(size=(n, dims))).astype("float32")


def blocked(spark, rows, queries, k, block_bytes, exclude_self=False):
    """Ranked ids per query, and the shipped block pairs of each round."""
    def stored(values, names):
        table = [(i, i, [float(x) for x in v]) for i, v in enumerate(values)]
        return spark.createDataFrame(table, f"{names[0]} long, {names[1]} long, vector array<float>")

    shipped = {}
    found = R._blocked_top_k(
        stored(queries, ("row", "query_id")), stored(rows, ("case_row", "index_id")), k, exclude_self, block_bytes, shipped
    )
    got = defaultdict(list)
    for r in found.orderBy("row", "rank").collect():
        assert r["rank"] == len(got[r["row"]]) + 1
        got[r["row"]].append((r["index_id"], r["similarity"]))
    return got, shipped


@pytest.mark.parametrize("exclude_self", [False, True])
def test_pruned_blocks_give_all_neighbours(spark, exclude_self):
    """On clusters most pairs of blocks are never compared; on random vectors none can be left out. Same rows."""
    rng = np.random.default_rng(0)
    for rows, prunes in ((clustered(1200, 24), True), (rng.normal(size=(600, 16)).astype("float32"), False)):
        rows[7] = rows[3]
        queries = rows[:400]
        got, shipped = blocked(spark, rows, queries, 4, 16 * 8 * 60, exclude_self)
        unit = rows.astype("float64") / np.linalg.norm(rows.astype("float64"), axis=1)[:, None]
        sims = np.round(unit[:400] @ unit.T, 9)
        if exclude_self:
            sims[np.arange(400), np.arange(400)] = -np.inf
        for i in range(400):
            order = np.lexsort((np.arange(len(rows)), -sims[i]))[:4]
            assert np.allclose([s for _, s in got[i]], sims[i][order], atol=2e-9)
            if np.min(np.abs(np.diff(np.sort(sims[i])[::-1][:5]))) > 1e-8:
                assert [x for x, _ in got[i]] == order.tolist()
        if prunes:
            assert sum(shipped["rounds"]) < 0.2 * shipped["all"]
        assert len(shipped["rounds"]) <= 3


def test_vectors_are_sent_by_part_and_not_by_block(spark):
    """Small blocks are many; a vector is still sent once for each part of the other side only."""
    rows = np.random.default_rng(1).normal(size=(900, 16)).astype("float32")
    got, shipped = blocked(spark, rows, rows[:300], 3, 16 * 8 * 10)
    assert len(got) == 300 and shipped["all"] > 90 * 30
    for sent in shipped["sent"]:
        assert sent <= 300 * (R.INDEX_PARTS + 1) + 900 * (R.QUERY_PARTS + 1)
    unit = rows.astype("float64") / np.linalg.norm(rows.astype("float64"), axis=1)[:, None]
    best = np.sort(np.round(unit[:300] @ unit.T, 9), axis=1)[:, :-4:-1]
    assert np.allclose([[s for _, s in got[i]] for i in range(300)], best, atol=2e-9)


def test_one_cell_larger_than_a_block_is_cut(spark):
    rows = clustered(500, 1, spread=1e-4)
    got, _ = blocked(spark, rows, rows[:50], 3, 16 * 8 * 40)
    assert len(got) == 50 and all(len(v) == 3 for v in got.values())


@pytest.mark.parametrize("limits", [{}, BLOCKED])
def test_ids_of_other_types(spark, limits):
    rows = [(f"m{i:02d}", f"t{i}", f"r{i}", [float(np.cos(i)), float(np.sin(i))]) for i in range(40)]
    index = spark.createDataFrame(rows, TEXTS.replace("message_id long", "message_id string"))
    top = top_k_similar(index, index, "message_id", "message_id", 2, True, **limits).where("rank = 1")
    assert dict(top.schema["query_id"].jsonValue())["type"] == top.schema["index_id"].jsonValue()["type"] == "string"
    angles = lambda i: min((j for j in range(40) if j != i), key=lambda j: (-round(np.cos(i - j), 6), j))
    assert {r.query_id: r.index_id for r in top.collect()} == {f"m{i:02d}": f"m{angles(i):02d}" for i in range(40)}
    # queries whose ids are of another type: numbers that name no case, and one that does
    numbers = spark.createDataFrame([(5, [1.0, 0.0]), (None, [0.0, 1.0])], "message_id int, embedding array<float>")
    found = top_k_similar(numbers, index.withColumn("message_id", F.substring("message_id", 3, 2)).where("message_id < '9'"), "message_id", "message_id", 1, True, **limits)
    assert sorted(str(r.query_id) for r in found.collect()) == ["5", "None"]


def test_index_size_is_checked(spark):
    df = frame(spark, vectors())
    assert broadcast_index(df, "message_id", max_bytes=100) is None
    assert broadcast_index(df, "message_id", max_bytes=100_000) is not None


def test_scoring_stays_in_one_stage(spark, plan_of):
    df = frame(spark, vectors())
    index = broadcast_index(df, "message_id", payload={"past_brand_reply": "brand_reply_clean",
                                                       "past_customer_msg": "customer_msg_clean"})
    plan = plan_of(retrieve_similar(df, index))
    assert plan.count("ArrowEvalPython") == 1
    assert "Exchange" not in plan and "Join" not in plan


def test_expressions(spark):
    row = spark.range(1).select(
        F.expr("array(3f, 4f)").alias("a"), F.expr("array(0f, 0f)").alias("z"),
        F.expr("array(4f, 3f)").alias("b"),
    ).select(
        V.norm(F.col("a")).alias("norm"), V.cosine(F.col("a"), F.col("b")).alias("cos"),
        V.cosine(F.col("a"), F.col("z")).alias("zero"),
        V.euclidean(F.col("a"), F.col("b")).alias("dist"),
    ).first()
    assert row.norm == 5.0 and abs(row.cos - 0.96) < 1e-12
    assert row.zero is None and abs(row.dist - 2**0.5) < 1e-12


def test_indexes(spark):
    df = frame(spark, vectors())
    index = sample_index(df, "message_id", n=20)
    assert index.count() == 20 and "norm" in index.columns
    part = partial_index(
        df.drop("embedding"), df.select("message_id", "embedding"), "message_id", 8, n=20
    )
    first = [r.message_id for r in sample_exact(df, 8, 7, "message_id").collect()]
    assert sorted(r.message_id for r in part.collect()) == sorted(first)


def test_native_embedder(spark):
    texts = ["battery drains fast", "battery drains very fast", "refund my money", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "message_id long, t string")
    model = fit_embedder(df, "t", 1 << 12)
    vecs = embed(df, "t", model)
    assert vecs.columns == ["message_id", "t", "embedding"]
    got = {r.message_id: r.norm for r in add_norm(vecs).collect()}
    assert abs(got[0] - 1) < 1e-6 and got[3] == got[4] == 0.0
    index = build_index(df, lambda d: embed(d, "t", model), "message_id", n=10)
    best = top_k_similar(vecs, index, "message_id", "message_id", 1, exclude_self=True)
    assert {(r.query_id, r.index_id) for r in best.where("similarity > 0.4").collect()} == {
        (0, 1), (1, 0),
    }


def test_user_embedder(spark):
    def load():
        def model(texts):
            assert len(texts) <= 2
            return [[len(t), 1.0] for t in texts]

        return model

    df = spark.createDataFrame([(i, "x" * i) for i in range(5)], "i long, t string")
    got = embed_with(df, "t", load, batch_size=2).orderBy("i").collect()
    assert [list(r.embedding) for r in got] == [[i, 1.0] for i in range(5)]


def test_embedders_of_parts_add_up(spark, tmp_path):
    texts = [f"word{i % 7} word{i % 3} Battery\u00a0{i}" for i in range(40)] + ["", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "message_id long, t string")
    whole = fit_embedder(df, "t", 64)
    assert whole == fit_embedder(df.where("message_id < 13"), "t", 64) + fit_embedder(df.where("message_id >= 13"), "t", 64)
    save_embedder(spark, whole, str(tmp_path / "model"))
    assert load_embedder(spark, str(tmp_path / "model")) == whole
    # values by hand
    words = [[w for w in (t or "").lower().replace("\u00a0", " ").split(" ") if w] for t in texts]
    found = [{word_feature(w, 64) for w in ws} for ws in words]
    for r in embed(df, "t", whole).collect():
        values = np.zeros(64)
        for w in words[r.message_id]:
            feature = word_feature(w, 64)
            values[feature] += np.log((len(texts) + 1) / (sum(feature in f for f in found) + 1))
        norm = np.linalg.norm(values)
        assert np.allclose(r.embedding, values / norm if norm else values, atol=1e-6)
    with pytest.raises(ValueError, match="features"):
        whole + fit_embedder(df, "t", 32)
    assert fit_embedder(df.limit(0), "t", 4).n_docs == 0


def brute_kmeans(rows, keys, k, seed, starts):
    """All starts, one after another, in plain numpy."""
    import hashlib

    hashes = np.array([int(hashlib.md5(str(x).encode()).hexdigest()[:8], 16) for x in keys])
    far = lambda c: np.round(((rows[:, None, :] - c[None]) ** 2).sum(2), 9)
    best = None
    for s in range(starts):
        chance = lambda r: (hashes * C.draw_factors(seed, s, r)[0] + C.draw_factors(seed, s, r)[1]) % C._PRIME / C._PRIME
        order = lambda r, at: [i for i in sorted(at, key=lambda i: (chance(r)[i], keys[i]))]
        drawn = order(0, range(len(rows)))[:1]
        for r in (1, 2):
            d = far(rows[drawn]).min(1)
            drawn = drawn + order(r, np.flatnonzero(chance(r) * (d.sum() / (2 * k)) < d))
        weight = np.bincount(far(rows[drawn]).argmin(1), minlength=len(drawn))
        centres = C._reduced(rows[drawn], weight, k)
        while True:
            at = far(centres).argmin(1)
            moved = np.array([rows[at == j].mean(0) if (at == j).any() else c for j, c in enumerate(centres)])
            if np.allclose(moved, centres, atol=1e-12):
                break
            centres = moved
        cost = round(float(far(centres).min(1).sum()), 6)
        if best is None or cost < best[0]:
            best = cost, centres
    return best


@pytest.mark.parametrize("partitions", [1, 6])
def test_all_starts_together_equal_one_after_another(spark, partitions):
    rows = clustered(150, 6, dims=3, spread=0.4).astype("float64")
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rows)], "k long, embedding array<double>")
    assigned, model = run_clustering(df.repartition(partitions), 4, seed=5, n_starts=6, key="k", tolerance=0.0)
    cost, centres = brute_kmeans(rows, list(range(150)), 4, 5, 6)
    assert np.allclose(model.centres, centres) and abs(model.cost - cost) < 1e-5
    own = {r.k: r.cluster for r in assigned.collect()}
    nearest = np.linalg.norm(rows[:, None] - centres[None], axis=2).argmin(1)
    assert [own[i] for i in range(150)] == nearest.tolist()


def test_starts_share_their_jobs(spark, monkeypatch):
    """Ten starts take the jobs of the longest of them, not the sum of all."""
    df = frame(spark, clustered(200, 8))
    jobs = []
    real = C._one_job
    monkeypatch.setattr(C, "_one_job", lambda *a: jobs.append(1) or real(*a))
    _, model = run_clustering(df, 8, n_starts=10, key="message_id")
    assert len(jobs) == model.steps + C.INIT_ROUNDS + 2


def test_points_that_cannot_be_clustered(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [nan, 1.0]), (5, [5.0, 0.0])], "i long, embedding array<float>")
    assigned, model = run_clustering(df, 4, n_starts=2, key="i")
    got = {r.i: r.cluster for r in assigned.collect()}
    assert len(model.centres) == 2 and got[1] == got[2] != got[5] and got[3] is got[4] is None
    none, model = run_clustering(df.where("i = 3"), 2)
    assert none.first().cluster is None and len(model.centres) == 0


def test_clusters(spark, plan_of):
    rng = np.random.default_rng(1)
    centres = np.array([[0, 0], [10, 0], [0, 10]])
    rows = np.vstack([c + rng.normal(size=(20, 2)) for c in centres]).astype("float32")
    df = frame(spark, rows)
    assigned, model = run_clustering(df, n_clusters=3, n_starts=3)
    assert sorted(r.n_rows for r in cluster_sizes(assigned).collect()) == [20, 20, 20]
    found = {
        frozenset(r.message_id // 20 for r in assigned.where(f"cluster = {c}").collect())
        for c in range(3)
    }
    assert found == {frozenset([0]), frozenset([1]), frozenset([2])}
    for centre_table in (model_centres(df, model), mean_centres(assigned, "cluster")):
        near = nearest_per_cluster(assigned, centre_table, "cluster", "message_id", 4)
        assert "WindowGroupLimit" in plan_of(near)
        for c in range(3):
            members = [r.message_id for r in assigned.where(f"cluster = {c}").collect()]
            centre = rows[members].astype("float64").mean(axis=0)
            order = sorted(members, key=lambda i: np.linalg.norm(rows[i] - centre))[:4]
            got = near.where(f"cluster = {c}").orderBy("rank").collect()
            assert [r.message_id for r in got] == order
