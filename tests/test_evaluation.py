"""Metrics against the published figures, rebuilt from their count tables."""

import pytest
from pyspark.sql import functions as F

from caseweave import fixed, schemas
from caseweave.operators import metrics as M
from caseweave.operators.providers import function_provider, rule_provider
from caseweave.plans.discover import discover_intents
from caseweave.plans.evaluate import (
    attach_scores, evaluation_results, judge_replies, pair_labels, pair_scores,
)
from caseweave.plans.handle import handle_messages

SHORT = ["acc", "amb", "bil", "how", "bug", "bat", "per"]
PIPELINE = [
    [3, 1, 0, 0, 0, 0, 0], [3, 11, 0, 0, 0, 1, 0], [0, 0, 1, 0, 0, 0, 0], [0, 1, 0, 6, 0, 0, 0],
    [0, 0, 0, 0, 8, 0, 0], [0, 0, 0, 0, 0, 7, 0], [0, 0, 0, 0, 2, 0, 6],
]
KEYWORD = [
    [2, 0, 1, 0, 0, 1, 0], [3, 5, 0, 3, 2, 1, 1], [0, 0, 1, 0, 0, 0, 0], [1, 1, 1, 4, 0, 0, 0],
    [0, 0, 1, 2, 4, 0, 1], [1, 0, 0, 0, 0, 6, 0], [0, 1, 0, 0, 4, 0, 3],
]
DECISIONS = {  # true, predicted: pipeline, keyword
    ("auto", "auto"): (27, 24), ("auto", "escalate"): (3, 6),
    ("escalate", "auto"): (0, 8), ("escalate", "escalate"): (20, 12),
}
RUBRIC = {
    "helpfulness": [6, 13, 4, 22, 5], "tone_match": [1, 7, 3, 20, 19],
    "grounding": [2, 0, 10, 8, 30],
}


def spread(counts):
    return [value for value, n in counts for _ in range(n)]


def results(spark):
    pipeline = spread([((t, p), PIPELINE[i][j]) for i, t in enumerate(SHORT)
                       for j, p in enumerate(SHORT)])
    keyword = spread([((t, p), KEYWORD[i][j]) for i, t in enumerate(SHORT)
                      for j, p in enumerate(SHORT)])
    full = spread([(k, n[0]) for k, n in DECISIONS.items()])
    simple = spread([(k, n[1]) for k, n in DECISIONS.items()])
    rows = [
        (i, *pipeline[i], keyword[i][1], *full[i], simple[i][1]) for i in range(50)
    ]
    assert [p[0] for p in pipeline] == [k[0] for k in keyword]
    df = spark.createDataFrame(
        rows, "message_id long, true_intent string, pipeline_intent string, simple_intent string,"
        " true_escalate string, pipeline_escalate string, simple_escalate string",
    )
    majority = M.majority_labels(df, ["true_intent", "true_escalate"]).first().majority
    return df.withColumns(
        {"trivial_intent": F.lit(majority.true_intent),
         "trivial_escalate": F.lit(majority.true_escalate)}
    )


def test_published_accuracy(spark):
    got = {
        r.model: (r.n_rows, round(r.intent_accuracy, 4), round(r.escalate_accuracy, 4))
        for r in M.accuracy(results(spark)).collect()
    }
    assert got == {
        "trivial": (50, 0.30, 0.60), "simple": (50, 0.50, 0.72), "pipeline": (50, 0.84, 0.94),
    }


def test_published_confusion(spark):
    pairs = M.confusion(results(spark), "true_intent", "pipeline_intent")
    got = {(r.truth, r.predicted): r.n_rows for r in pairs.collect()}
    assert got == {
        (t, p): PIPELINE[i][j]
        for i, t in enumerate(SHORT) for j, p in enumerate(SHORT) if PIPELINE[i][j]
    }
    matrix = {r.truth: list(r)[1:] for r in M.confusion_matrix(pairs, SHORT).collect()}
    assert matrix == {t: PIPELINE[i] for i, t in enumerate(SHORT)}


def test_published_rubric_means(spark):
    columns = {d: spread(list(zip(range(1, 6), n))) for d, n in RUBRIC.items()}
    rows = [(i, *[columns[d][i] for d in RUBRIC]) for i in range(50)]
    df = spark.createDataFrame(rows, "id long, helpfulness int, tone_match int, grounding int")
    got = {r.dimension: round(r.mean_score, 2) for r in M.mean_scores(df).collect()}
    assert got == {"helpfulness": 3.14, "tone_match": 3.98, "grounding": 4.28}


def test_agreement(spark):
    df = spark.createDataFrame(
        [(5, 5, 4, 3, 5, 1), (2, 3, 4, 4, None, 3), (1, 3, None, None, 5, 4)],
        "judge_helpfulness int, my_helpfulness int, judge_tone_match int, my_tone_match int,"
        "judge_grounding int, my_grounding int",
    )
    got = {
        r.dimension: (r.n_rows, round(r.exact_match, 3), round(r.within_one, 3))
        for r in M.rater_agreement(df).collect()
    }
    assert got == {
        "helpfulness": (3, 0.333, 0.667), "tone_match": (3, 0.333, 0.667),
        "grounding": (3, 0.0, 0.333),
    }
    spreads = M.score_distribution(df)
    counts = {(r.rater, r.dimension, r.score): r.n_rows for r in spreads.collect()}
    assert counts[("judge", "grounding", 5)] == 2 and counts[("my", "tone_match", None)] == 1
    ranges = {(r.rater, r.dimension): (r.min_score, r.max_score)
              for r in M.score_ranges(spreads).collect()}
    assert ranges[("judge", "helpfulness")] == (1, 5)


def test_majority_ties_and_nulls(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,), (None,), (None,)],
                               "v string")
    assert M.majority_value(df, "v").first().v == "a"
    assert M.majority_labels(df, ["v"]).first().majority.v == "a"


def test_missing_equals_nothing(spark):
    df = spark.createDataFrame(
        [("a", "a"), (None, "a"), (None, None), ("a", None)], "simple_intent string, t string"
    )
    row = M.accuracy(df, ["simple"], {"intent": "t"}).first()
    assert (row.n_rows, row.intent_accuracy) == (4, 0.25)


def labelled(spark, n=200):
    rows = [
        (i, f"message {i} my battery drains since the last update came", f"reply {i}",
         "post_update_battery_drain" if i % 4 else "billing_refund",
         "auto" if i % 4 else "escalate", [float(i % 7), float(i % 5), 1.0])
        for i in range(n)
    ]
    return spark.createDataFrame(
        rows, "message_id long, customer_msg_clean string, brand_reply_clean string,"
        "true_intent string, escalate_or_auto string, embedding array<float>",
    )


def handler(df, **options):
    def handle(rows):
        return handle_messages(
            rows, df, rule_provider("message"), keep=["true_intent", "true_escalate"], **options
        )

    return handle


def test_evaluation(spark):
    df = labelled(spark)
    got = evaluation_results(df, handler(df))
    assert got.schema.names == schemas.EVAL_RESULTS.names
    rows = got.collect()
    assert len(rows) == 50 and {r.trivial_intent for r in rows} == {"post_update_battery_drain"}
    assert {r.trivial_escalate for r in rows} == {"auto"}
    assert {(r.pipeline_intent, r.simple_escalate) for r in rows} == {
        ("post_update_battery_drain", "auto")
    }
    assert {round(r.pipeline_top_similarity, 6) for r in rows} == {1.0}
    whole = M.accuracy(evaluation_results(df, handler(df), n=None))
    assert {r.model: r.intent_accuracy for r in whole.collect()} == {
        "trivial": 0.75, "simple": 0.75, "pipeline": 0.75,
    }


def test_handle_messages(spark, plan_of):
    df = labelled(spark)
    messages = df.withColumnRenamed("customer_msg_clean", "message")
    got = handle_messages(messages, df, exclude_self=True)
    assert got.schema.names == schemas.MESSAGE_RESULT.names
    plan = plan_of(got)
    assert plan.count("ArrowEvalPython") == 1 and "Exchange" not in plan and "Join" not in plan
    rows = {r.message_id: r for r in got.collect()}
    assert len(rows) == 200
    # 0 and 35 have the same vector; the smallest other id is the precedent
    assert rows[0].drafted_reply == "reply 35" and rows[35].drafted_reply == "reply 0"
    assert {r.decision for r in rows.values()} == {"auto"}
    blocked = handle_messages(messages, df, exclude_self=True, max_broadcast_bytes=0)
    assert {tuple(r) for r in blocked.collect()} == {tuple(r) for r in rows.values()}
    alone = handle_messages(messages, df.limit(0), exclude_self=True)
    row = alone.where("message_id = 3").first()
    assert (row.decision, row.top_similarity, row.drafted_reply) == ("escalate", 0.0, "")


def test_judging(spark):
    def load():
        return lambda prompts: [
            '{"helpfulness": 4, "tone_match": 3, "grounding": 5, "justification": "ok"}'
            if 'Drafted reply: "reply 1' in p else "no" for p in prompts
        ]

    df = spark.createDataFrame(
        [(i, f"m{i}", f"reply {i}") for i in range(4)],
        "message_id long, message string, pipeline_reply string",
    )
    judged = judge_replies(df, function_provider(load))
    rows = {r.message_id: r for r in judged.collect()}
    assert tuple(rows[1])[3:] == (4, 3, 5, "ok")
    assert tuple(rows[2])[3:] == (3, 3, 3, fixed.NEUTRAL_JUSTIFICATION)
    attached = attach_scores(df, judged.where("message_id <> 3"))
    assert attached.count() == 4 and attached.where("grounding is null").count() == 1


def test_rater_and_label_pairs(spark):
    judged = spark.createDataFrame(
        [(i, f"m{i}", "r", 5, 4, 3) for i in range(40)],
        "message_id long, message string, pipeline_reply string, helpfulness int, tone_match int,"
        "grounding int",
    )
    paired = pair_scores(judged, judged)
    assert paired.schema.names == schemas.JUDGE_AGREEMENT.names and paired.count() == 15
    assert {r.exact_match for r in M.rater_agreement(paired).collect()} == {1.0}
    golden = labelled(spark, 40)
    mine = golden.withColumn("true_intent", F.lit("billing_refund"))
    spot = pair_labels(golden, mine, n=None)
    assert spot.schema.names == schemas.SPOT_CHECK.names
    rates = M.label_agreement(spot).first()
    assert (rates.n_rows, rates.intent_agreement, rates.escalate_agreement) == (40, 0.25, 1.0)
    assert M.disagreements(spot).count() == 30
    assert pair_labels(golden, mine).count() == 20


def test_discovery(spark):
    rows = [(i, f"battery drains {i}" if i % 2 else f"refund my money {i}") for i in range(60)]
    df = spark.createDataFrame(rows, "brand_tweet_id long, customer_msg_clean string")
    found = discover_intents(df, n=50, n_clusters=2, n_starts=2, n_examples=3)
    assert found.assigned.count() == 50
    assert sum(r.n_rows for r in found.sizes.collect()) == 50
    examples = found.examples.collect()
    assert len(examples) == 6
    for c in (0, 1):
        kinds = {r.customer_msg_clean.split()[0] for r in examples if r.cluster == c}
        assert len(kinds) == 1


@pytest.mark.parametrize("model", ["trivial"])
def test_empty_results(spark, model):
    row = M.accuracy(results(spark).where("false"), [model]).first()
    assert row.n_rows == 0 and row.intent_accuracy is None
