import pytest
from pyspark.sql import functions as F

from caseweave import fixed, schemas
from caseweave.functions.keywords import add_keyword_intent
from caseweave.operators.classify import classify_batch
from caseweave.operators.labelling import (
    DECISION_CHECK, INTENT_CHECK, RUBRIC_CHECKS, attach_suggestions, bucket_members, bucket_sizes,
    bulk_finalize, golden_candidates, label_counts, split_valid,
)
from caseweave.operators.patches import Patch, apply_patches, patch_residual, review_queue
from caseweave.operators.providers import rule_batch_provider

TAIL = " and it has been like that for days now"


def pairs(spark):
    texts = (
        [f"battery {i} drains" + TAIL for i in range(40)]
        + [f"charged {i} times, battery too" + TAIL for i in range(10)]
        + [f"short {i}" for i in range(5)]
        + ["short 0", "nothing known in this one" + TAIL]
    )
    rows = [(i, t, f"reply {i}") for i, t in enumerate(texts)]
    return spark.createDataFrame(
        rows, "message_id long, customer_msg_clean string, brand_reply_clean string"
    )


def test_candidates(spark):
    df = pairs(spark)
    sizes = {r.bucket: (r.n_found, r.n_sampled) for r in bucket_sizes(bucket_members(df)).collect()}
    assert sizes == {
        "post_update_battery_drain": (50, 28), "billing_refund": (10, 10),
        fixed.AMBIGUOUS: (6, 6),
    }
    got = golden_candidates(df)
    assert got.schema.names == schemas.CANDIDATES.names
    rows = got.collect()
    assert len({r.customer_msg_clean for r in rows}) == len(rows)
    drain = [r for r in rows if r.candidate_intent_heuristic == "post_update_battery_drain"]
    assert len(drain) == 28
    # of the charged-and-battery messages, those sampled as battery stay there
    both = {r.message_id for r in rows if 40 <= r.message_id < 50}
    assert both == set(range(40, 50))
    assert all(r.true_intent is None for r in rows)
    given = golden_candidates(df, per_bucket=2, defaults={"true_intent": "x"}).collect()
    assert {r.true_intent for r in given} == {"x"} and len(given) <= 6


def candidates(spark):
    return golden_candidates(pairs(spark), per_bucket=5)


def test_prelabel_complete_and_partial(spark):
    cands = candidates(spark).cache()
    labels = classify_batch(cands, "message_id", "customer_msg_clean", rule_batch_provider())
    full = attach_suggestions(cands, labels)
    assert full.schema.names == schemas.PRELABELED.names
    want = {
        r.message_id: r.intent for r in add_keyword_intent(cands, "customer_msg_clean").collect()
    }
    assert {r.message_id: r.suggested_intent for r in full.collect()} == want
    some = attach_suggestions(cands, labels.where("message_id < 45")).collect()
    assert len(some) == len(want)
    for r in some:
        assert (r.suggested_intent == "") == (r.message_id >= 45)
        assert (r.suggested_escalate_or_auto == "") == (r.message_id >= 45)


def test_bulk_finalize(spark):
    cands = candidates(spark).cache()
    labels = cands.select("message_id", F.lit("billing_refund").alias("intent")).where(
        "message_id < 45"
    )
    pre = attach_suggestions(cands, labels.union(
        spark.createDataFrame([(999, "x")], "message_id long, intent string")))
    done = cands.where("message_id >= 50").select(
        "message_id", "customer_msg_clean", "brand_reply_clean",
        F.lit("how_to_question").alias("true_intent"), F.lit("auto").alias("escalate_or_auto"),
        F.lit("mine").alias("good_reply_should_include"), F.lit("mine").alias("escalate_reason"),
    )
    rows = {r.message_id: r for r in bulk_finalize(pre, done).collect()}
    assert len(rows) == cands.count()
    for i, r in rows.items():
        if i >= 50:
            assert r.good_reply_should_include == "mine" and r.true_intent == "how_to_question"
        elif i < 45:
            assert (r.good_reply_should_include, r.escalate_reason) == (
                fixed.LABEL_TEMPLATES["billing_refund"])
            assert r.escalate_or_auto == "escalate"
        else:
            assert (r.true_intent, r.escalate_or_auto) == (fixed.AMBIGUOUS, "escalate")
            assert r.escalate_reason == fixed.REVIEW_FLAG
    counts = label_counts(bulk_finalize(pre, done)).first()
    assert counts.n_rows == len(rows)
    assert counts.n_flagged == sum(45 <= i < 50 for i in rows)
    assert bulk_finalize(pre).count() == len(rows)
    unknown = pre.withColumn("suggested_intent", F.lit("unknown"))
    assert {r.escalate_reason for r in bulk_finalize(unknown).collect()} == {""}


GOLDEN = [
    (1, "Yes (really?) this *is* it", "NEEDS MANUAL REVIEW"),
    (2, "thank you", "NEEDS MANUAL REVIEW"),
    (3, "thank you all", None),
    (4, None, "done"),
]


def golden(spark, rows=GOLDEN):
    return spark.createDataFrame(
        [(i, t, "old", "old", "old", r) for i, t, r in rows],
        "message_id long, customer_msg_clean string, true_intent string, escalate_or_auto string,"
        " good_reply_should_include string, escalate_reason string",
    )


def test_patches(spark, plan_of):
    patches = [
        Patch("(really?)", "a", "auto", "note", "reason"),  # one row, literally
        Patch("thank", "b", "auto", "note", "reason"),  # two rows
        Patch("nowhere", "c"),  # no row
        Patch("*is*", None, None, "later note"),  # same row, later, one column
        Patch("th.nk you all", "d"),  # not a pattern
    ]
    patched, report = apply_patches(golden(spark), patches)
    rows = {r.message_id: r for r in patched.collect()}
    assert rows[1].true_intent == "a" and rows[1].good_reply_should_include == "later note"
    assert rows[1].escalate_reason == "reason"
    for i in (2, 3, 4):
        assert rows[i].true_intent == "old"
    got = {r.patch: (r.n_matches, r.applied) for r in report.collect()}
    assert got == {0: (1, True), 1: (2, False), 2: (0, False), 3: (1, True), 4: (0, False)}
    assert "Join" not in plan_of(patched)
    assert patched.columns == golden(spark).columns


def test_patches_without_any_match(spark):
    patched, _ = apply_patches(golden(spark), [Patch("nowhere", "c")])
    assert patched.exceptAll(golden(spark)).count() == 0 and patched.count() == 4


def test_many_patches_give_the_same_rows(spark, monkeypatch):
    from caseweave.operators import patches as module

    listed = [
        Patch("(really?)", "a", "auto", "note", "reason"), Patch("thank", "b"), Patch("nowhere", "c"),
        Patch("*is*", None, None, "later note"), Patch("th.nk you all", "d"), Patch("", "e"), Patch("(really?)", "f"),
    ]
    few, few_report = apply_patches(golden(spark), listed)
    few, few_report = few.collect(), few_report.collect()
    monkeypatch.setattr(module, "PLAN_PATCHES", 2)
    many, many_report = apply_patches(golden(spark), listed)
    assert sorted(map(str, few)) == sorted(map(str, many.collect()))
    assert sorted(map(str, few_report)) == sorted(map(str, many_report.collect()))


def test_a_long_list_of_patches(spark):
    patches = [Patch(str(i), "x") for i in range(1500)] + [Patch("(really?)", "a")]
    patched, report = apply_patches(golden(spark), patches)
    assert {r.message_id: r.true_intent for r in patched.collect()}[1] == "a"
    assert report.count() == 1501


def test_residual_patch(spark):
    patch = Patch("thank you", "fixed", "auto", "note", "closing")
    two = golden(spark)
    assert review_queue(two).count() == 2
    assert patch_residual(two, patch).exceptAll(two).count() == 0
    one = golden(spark, GOLDEN[1:])
    row = patch_residual(one, patch).where("message_id = 2").first()
    assert (row.true_intent, row.escalate_reason) == ("fixed", "closing")
    assert patch_residual(one, patch).where("message_id = 3").first().true_intent == "old"
    other = patch_residual(one, Patch("something else", "fixed"))
    assert other.exceptAll(one).count() == 0
    none = golden(spark, GOLDEN[2:])
    assert patch_residual(none, patch).exceptAll(none).count() == 0


def test_validation(spark):
    df = spark.createDataFrame(
        [(1, "billing_refund", "auto"), (2, "Billing_refund", "auto"), (3, None, "maybe")],
        "message_id long, true_intent string, escalate_or_auto string",
    )
    valid, rejected = split_valid(df, {**INTENT_CHECK, **DECISION_CHECK})
    assert [r.message_id for r in valid.collect()] == [1]
    assert {r.message_id: r.invalid_columns for r in rejected.collect()} == {
        2: ["true_intent"], 3: ["true_intent", "escalate_or_auto"],
    }
    scores = spark.createDataFrame(
        [(1, 5, 5), (0, 5, 6)], "helpfulness int, tone_match int, grounding int"
    )
    assert split_valid(scores, RUBRIC_CHECKS)[1].first().invalid_columns == [
        "helpfulness", "grounding"
    ]
