"""One key may hold a third of all rows, and results must not depend on partitioning."""

import pytest
from pyspark.sql import functions as F

from caseweave import schemas
from caseweave.operators.classify import classify_batch
from caseweave.operators.clustering import mean_centres, nearest_per_cluster
from caseweave.operators.labelling import golden_candidates
from caseweave.operators.lookup import lookup_join
from caseweave.operators.pairs import keep_first
from caseweave.operators.providers import rule_batch_provider
from caseweave.operators.retrieval import retrieve_similar, top_k_similar
from caseweave.plans.prepare import clean_pairs

N = 3000


def hot_texts(spark):
    text = F.when(F.col("id") % 3 == 0, F.lit("the same battery message again and again and again"))
    return spark.range(N).select(
        F.col("id").alias("message_id"),
        text.otherwise(F.concat(F.lit("refund number "), F.col("id") % 700)).alias(
            "customer_msg_clean"
        ),
        F.lit("r").alias("brand_reply_clean"),
    )


def partial_limit(plan):
    return "WindowGroupLimit" in plan and "Partial" in plan


def test_hot_text(spark, plan_of):
    kept = keep_first(hot_texts(spark), ["customer_msg_clean"], [F.col("message_id")])
    assert partial_limit(plan_of(kept))
    assert kept.count() == 701
    assert kept.where("customer_msg_clean like 'the same%'").first().message_id == 0


def test_hot_cluster(spark, plan_of):
    df = spark.range(N).select(
        F.col("id").alias("vec_id"),
        F.array((F.col("id") % 11).cast("float"), F.lit(1.0).cast("float")).alias("embedding"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).cast("int").alias("label"),
    )
    near = nearest_per_cluster(df, mean_centres(df, "label"), "label", "vec_id", 8)
    assert partial_limit(plan_of(near))
    counts = {r.cluster: r["count"] for r in near.groupBy("cluster").count().collect()}
    assert set(counts.values()) == {8} and len(counts) == 50


@pytest.mark.parametrize("limits", [{}, {"max_broadcast_bytes": 0, "block_bytes": 4000}])
def test_one_case_is_nearest_to_all(spark, limits):
    cases = spark.createDataFrame(
        [(i, f"c{i}", f"r{i}", [1.0, float(i)]) for i in range(20)],
        "message_id long, customer_msg_clean string, brand_reply_clean string,"
        "embedding array<float>",
    )
    messages = spark.range(1000, 2000).select(
        F.col("id").alias("message_id"), F.expr("array(1f, 0f)").alias("embedding")
    )
    got = retrieve_similar(messages, cases, k=2, **limits)
    assert got.count() == 1000
    assert got.where("retrieved[0].past_brand_reply = 'r0'").count() == 1000


def test_partitioning_does_not_matter(spark):
    df = hot_texts(spark).cache()

    def one(d):
        return golden_candidates(d, per_bucket=9)

    def two(d):
        return classify_batch(
            d, "message_id", "customer_msg_clean", rule_batch_provider(), n_buckets=5
        )

    def three(d):
        vectors = d.withColumn(
            "embedding", F.transform(F.sequence(F.lit(1), F.lit(4)),
                                     lambda i: F.sin(i * F.col("message_id")).cast("float"))
        ).where("message_id < 400")
        return top_k_similar(vectors, vectors, "message_id", "message_id")

    for operator in (one, two, three):
        a, b = operator(df.repartition(1)), operator(df.repartition(13, "customer_msg_clean"))
        assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0
        assert a.count() == b.count() > 0


def test_pairs_do_not_depend_on_file_order(spark):
    rows = [(i, "u", True, f"t{i % 4}", f"customer text {i % 40}", None, None) for i in range(80)]
    rows += [(i % 80, "u", i % 2 == 0, f"s{i}", f"other text {i}", None, None) for i in range(60)]
    rows += [(200 + i, "B", False, "t", f"reply {i}", None, i % 90) for i in range(300)]
    forward = spark.createDataFrame(rows, schemas.TWEETS)
    backward = spark.createDataFrame(rows[::-1], schemas.TWEETS).repartition(5)
    a, b = clean_pairs(forward, "B"), clean_pairs(backward, "B")
    assert a.count() == b.count() > 0 and a.exceptAll(b).count() == 0


def test_lookup_without_any_key(spark):
    facts = spark.range(10).select("id", F.lit(None).cast("long").alias("k"))
    dims = spark.range(5).select(F.col("id").alias("d"))
    assert lookup_join(facts, dims, "k", "d", "id").count() == 0
    assert lookup_join(facts, dims, "k", "d", "id", how="left").count() == 10
    assert lookup_join(facts.where("false"), dims, "k", "d", "id", how="left").count() == 0


def test_no_replies_at_all(spark):
    tweets = spark.createDataFrame([(1, "u", True, "t", "hello there", None, None)], schemas.TWEETS)
    assert clean_pairs(tweets, "B").count() == 0
