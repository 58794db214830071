import pytest
from pyspark.sql import functions as F

from caseweave import fixed
from caseweave.functions import prompts as P
from caseweave.functions import responses as R
from caseweave.functions.decision import decide_escalation, two_decimals
from caseweave.functions.keywords import add_keyword_intent, rule_decision
from caseweave.operators.classify import classify, classify_batch, message_batches
from caseweave.operators.labelling import bucket_members
from caseweave.operators.providers import (
    function_provider, nearest_example_provider, rule_batch_provider, rule_provider,
)

LONG = " please look into it as soon as you can"
MESSAGES = [
    ("my Battery is draining since the update" + LONG, "post_update_battery_drain"),
    ("Battery low refund now", fixed.AMBIGUOUS),  # short wins over a hit
    ("I was charged for the app that is crashing" + LONG, "post_update_performance_issue"),
    ("how do I turn this thing around the corner quickly", "how_to_question"),
    ("nothing in here has any of the known words at all", fixed.AMBIGUOUS),
    ("I lost my photos and want a refund of it all", "account_access_data_loss"),
    ("a b c d e f glitch", fixed.AMBIGUOUS),  # seven words
    ("a b c d e f g glitch", "known_widespread_bug"),  # eight words
    ("", fixed.AMBIGUOUS),
]


def frame(spark, texts):
    return spark.createDataFrame(
        [(i, t) for i, t in enumerate(texts)], "message_id long, customer_msg_clean string"
    )


def python_rules(text):
    if len(text.split()) <= 7:
        return fixed.AMBIGUOUS
    hits = [
        i for i, words in fixed.KEYWORD_RULES.items() if any(w in text.lower() for w in words)
    ]
    return hits[0] if hits else fixed.AMBIGUOUS


def test_keyword_intent(spark):
    df = frame(spark, [m for m, _ in MESSAGES])
    got = add_keyword_intent(df, "customer_msg_clean").orderBy("message_id").collect()
    assert [r.intent for r in got] == [i for _, i in MESSAGES]
    assert [r.intent for r in got] == [python_rules(m) for m, _ in MESSAGES]


def test_text_is_lowered_once(spark, plan_of):
    plan = plan_of(add_keyword_intent(frame(spark, ["x"]), "customer_msg_clean"))
    assert plan.count("lower(") == 1 and "Contains(" in plan


def test_buckets_include_the_classifier(spark):
    df = frame(spark, [m for m, _ in MESSAGES])
    members = {(r.message_id, r.bucket) for r in bucket_members(df).collect()}
    for i, (text, intent) in enumerate(MESSAGES):
        hits = {b for m, b in members if m == i}
        short = len(text.split()) <= 7
        assert (fixed.AMBIGUOUS in hits) == short
        assert intent in hits or intent == fixed.AMBIGUOUS
    assert {"billing_refund", "account_access_data_loss"} <= {b for m, b in members if m == 5}


def test_rule_decision(spark):
    got = spark.createDataFrame([(i,) for i in fixed.INTENTS], "i string").select(
        "i", rule_decision(F.col("i")).alias("d")
    )
    assert {r.i for r in got.collect() if r.d == "escalate"} == set(fixed.ALWAYS_ESCALATE_INTENTS)


@pytest.mark.parametrize(
    "intent, confidence, similarity, decision, part",
    [
        ("billing_refund", "high", 1.0, "escalate", "'billing_refund' typically requires"),
        (fixed.AMBIGUOUS, "high", 1.0, "escalate", "too vague"),
        ("how_to_question", "medium", 1.0, "escalate", "confidence was 'medium', not high"),
        ("how_to_question", None, 1.0, "escalate", "confidence was 'None'"),
        ("how_to_question", "high", 0.45, "auto", "known precedent"),
        ("how_to_question", "high", 0.4499, "escalate", "similarity: 0.45), situation"),
        ("how_to_question", "high", 0.0, "escalate", "similarity: 0.00)"),
        ("how_to_question", "high", None, "escalate", "similarity: 0.00)"),
        ("billing_refund", "low", 0.0, "escalate", "account-specific verification"),
    ],
)
def test_decision(spark, intent, confidence, similarity, decision, part):
    df = spark.createDataFrame([(intent, confidence, similarity)], "i string, c string, s double")
    row = df.select(decide_escalation(F.col("i"), F.col("c"), F.col("s")).alias("d")).first().d
    assert row.decision == decision and part in row.reason


def test_two_decimals(spark):
    df = spark.createDataFrame([(0.126,), (1.0,), (0.5,)], "x double")
    assert [r[0] for r in df.select(two_decimals(F.col("x"))).collect()] == ["0.13", "1.00", "0.50"]


def test_prompts(spark):
    df = spark.createDataFrame([("my phone",)], "m string")
    retrieved = F.array(
        F.struct(F.lit("c1").alias("past_customer_msg"), F.lit("r1").alias("past_brand_reply"),
                 F.lit(0.875).alias("similarity")),
        F.struct(F.lit("c2").alias("past_customer_msg"), F.lit("r2").alias("past_brand_reply"),
                 F.lit(0.5).alias("similarity")),
    )
    row = df.select(
        P.classify_prompt(F.col("m")).alias("one"),
        P.classify_batch_prompt(F.array(F.lit("x"), F.lit("y"))).alias("many"),
        P.reply_prompt(F.col("m"), F.lit("how_to_question"), retrieved, "Brand").alias("reply"),
        P.rubric_prompt(F.col("m"), F.lit("do this")).alias("rubric"),
    ).first()
    assert 'Classify this new message:\n"my phone"\n\nRespond with ONLY valid JSON' in row.one
    assert "- billing_refund: Customer was charged incorrectly" in row.one
    assert '  Examples:\n    - "billed twice for icloud storage"\n    - "I was' in row.one
    assert 'EACH of these 2 messages:\n0. "x"\n1. "y"\n\nRespond' in row.many
    assert row.reply.startswith("You are Brand, replying")
    assert (
        "Example 1 (similarity: 0.88):\n  Customer: c1\n  Brand reply: r1\n\nExample 2"
        in row.reply
    )
    assert "as: how_to_question\n\nNew customer message: \"my phone\"" in row.reply
    assert 'Customer message: "my phone"\n\nDrafted reply: "do this"' in row.rubric
    for text in row:
        assert "<<" not in text and ">>" not in text


GOOD = '{"intent": "billing_refund", "confidence": "high"}'
FALLBACK = (fixed.AMBIGUOUS, "low")


@pytest.mark.parametrize(
    "raw, label",
    [
        (GOOD, ("billing_refund", "high")),
        (f"```json\n{GOOD}\n```", ("billing_refund", "high")),
        (f"```\n{GOOD}```", ("billing_refund", "high")),
        (f"{GOOD} thanks", FALLBACK),
        (f"{GOOD} }}", FALLBACK),
        (f"{GOOD}] }}", FALLBACK),
        (f"{GOOD}}} }}", FALLBACK),
        (f"{GOOD}, {GOOD}", FALLBACK),
        ("not json", FALLBACK),
        (GOOD.replace("billing_refund", "billing"), FALLBACK),
        (GOOD.replace('"', "'"), FALLBACK),
        ('{"intent": "billing_refund"}', ("billing_refund", "low")),
        ('{"intent": 3}', FALLBACK),
        ("[1]", FALLBACK), (f"[{GOOD}]", FALLBACK), ("null", FALLBACK), ("", FALLBACK),
        (None, FALLBACK),
    ],
)
def test_label_replies(spark, raw, label):
    df = spark.createDataFrame([(raw,)], "r string")
    assert tuple(df.select(R.parse_label(F.col("r")).alias("l")).first().l) == label


def item(index, intent, confidence="high"):
    return f'{{"index": {index}, "intent": "{intent}", "confidence": "{confidence}"}}'


ORDERED = f"[{item(0, 'billing_refund')}, {item(1, 'how_to_question', 'medium')}]"


@pytest.mark.parametrize(
    "raw, labels",
    [
        (ORDERED, [("billing_refund", "high"), ("how_to_question", "medium")]),
        (f"```json\n{ORDERED}\n```", [("billing_refund", "high"), ("how_to_question", "medium")]),
        (f"[{item(5, 'how_to_question')}, {item(2, 'billing_refund')}]",
         [("billing_refund", "high"), ("how_to_question", "high")]),
        (f"[{item(0, 'new')}, {item(1, 'how_to_question')}]",
         [FALLBACK, ("how_to_question", "high")]),
        (f"[{item(0, 'billing_refund')}]", [FALLBACK] * 2),
        (f"[{item(0, 'billing_refund')}, {{\"intent\": \"billing_refund\"}}]", [FALLBACK] * 2),
        (f"{ORDERED} done", [FALLBACK] * 2),
        ("{}", [FALLBACK] * 2), ("[1, 2]", [FALLBACK] * 2), (None, [FALLBACK] * 2),
    ],
)
def test_batch_replies(spark, raw, labels):
    df = spark.createDataFrame([(raw,)], "r string")
    got = df.select(R.parse_label_batch(F.col("r"), F.lit(2)).alias("l")).first().l
    assert [tuple(x) for x in got] == labels


def rubric(h, t, g, tail=', "justification": "ok"}'):
    return f'{{"helpfulness": {h}, "tone_match": {t}, "grounding": {g}{tail}'


NEUTRAL = (3, 3, 3, fixed.NEUTRAL_JUSTIFICATION)


@pytest.mark.parametrize(
    "raw, scores",
    [
        (rubric(4, 5, 1), (4, 5, 1, "ok")),
        (rubric('"4"', '" 2 "', "4.7"), (4, 2, 4, "ok")),
        (rubric("-2.5", "true", "9"), (-2, 1, 9, "ok")),
        (rubric('"4.7"', 5, 1), NEUTRAL),
        (rubric("null", 5, 1), NEUTRAL),
        ('{"helpfulness": 4, "grounding": 3}', NEUTRAL),
        (rubric(4, 5, 1, "}"), (4, 5, 1, None)),
        (rubric(4, 5, 1) + " as asked }", NEUTRAL),
        ("[4]", NEUTRAL), ("four", NEUTRAL), ("", NEUTRAL), (None, NEUTRAL),
    ],
)
def test_rubric_replies(spark, raw, scores):
    df = spark.createDataFrame([(raw,)], "r string")
    row = df.select(R.parse_rubric(F.col("r")).alias("s")).select(
        "s", R.rubric_out_of_range(F.col("s")).alias("odd")
    ).first()
    assert tuple(row.s) == scores
    assert row.odd == any(x not in range(1, 6) for x in scores[:3])


def test_single_and_batch_agree(spark):
    texts = [m for m, _ in MESSAGES] * 9
    df = frame(spark, texts)
    single = classify(df, "customer_msg_clean", rule_provider("customer_msg_clean"))
    batch = classify_batch(
        df, "message_id", "customer_msg_clean", rule_batch_provider(), n_buckets=3
    )
    a = {(r.message_id, r.intent, r.confidence) for r in single.collect()}
    b = {(r.message_id, r.intent, r.confidence) for r in batch.collect()}
    assert a == b and len(a) == len(texts)
    assert {i for _, i, c in a if c == "low"} == {fixed.AMBIGUOUS}


def test_batches_are_bounded(spark):
    df = frame(spark, [f"message {i}" for i in range(1000)])
    batches = message_batches(df, "message_id", "customer_msg_clean", n_buckets=10)
    rows = batches.select("bucket", F.size("items").alias("n")).collect()
    assert sum(r.n for r in rows) == 1000 and max(r.n for r in rows) == 15
    assert len({r.bucket for r in rows}) == 10


def test_another_message_moves_only_its_own_bucket(spark):
    texts = [f"message {i}" for i in range(301)]

    def batches(n):
        rows = message_batches(frame(spark, texts[:n]), "message_id", "customer_msg_clean").collect()
        return {(r.bucket, r.batch): r.prompt for r in rows}

    before, after = batches(300), batches(301)
    moved = {b for b, _ in {k for k in before.keys() | after.keys() if before.get(k) != after.get(k)}}
    assert len(moved) == 1


def test_user_model(spark):
    def load():
        calls = []

        def model(prompts):
            calls.append(len(prompts))
            assert len(prompts) <= 4
            return [GOOD if "refund" in p.rsplit("Classify this", 1)[1] else "?" for p in prompts]

        return model

    df = frame(spark, ["a refund"] * 10 + ["something else"] * 5)
    got = classify(df, "customer_msg_clean", function_provider(load, batch_size=4))
    assert sorted({(r.message_id < 10, r.intent) for r in got.collect()}) == [
        (False, fixed.AMBIGUOUS), (True, "billing_refund"),
    ]


def test_nearest_example(spark):
    from caseweave.operators.embedding import fit_embedder

    examples = [(i, e) for i, info in fixed.INTENTS.items() for e in info["examples"]]
    df = frame(spark, [e for _, e in examples])
    embedder = fit_embedder(df, "customer_msg_clean", 1 << 14)
    got = classify(
        df, "customer_msg_clean", nearest_example_provider("customer_msg_clean", embedder)
    ).orderBy("message_id")
    assert [(r.intent, r.confidence) for r in got.collect()] == [(i, "high") for i, _ in examples]
