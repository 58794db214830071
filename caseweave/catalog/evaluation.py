"""Queries on labelling and evaluation (q31 - q47)."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseweave import fixed
from caseweave.catalog import data as D
from caseweave.catalog.preparation import BUCKETS, CANDIDATES
from caseweave.functions.prompts import rubric_prompt
from caseweave.functions.responses import parse_rubric, rubric_out_of_range
from caseweave.operators import metrics
from caseweave.operators.classify import classify_batch
from caseweave.operators.labelling import (
    CANDIDATE_LABELS, attach_suggestions, bulk_finalize, check_labels, golden_candidates, label_counts,
)
from caseweave.operators.patches import Patch, apply_patches, patch_residual, review_queue
from caseweave.operators.providers import rule_batch_provider, rule_provider
from caseweave.operators.retrieval import partial_index, sample_index
from caseweave.plans.evaluate import (
    attach_scores, evaluation_results, judge_replies, pair_labels, pair_scores,
)
from caseweave.plans.handle import handle_messages
from caseweave.session import scratch_path, store_stage
from caseweave.sources.incremental import pending, read_done, record_labels, run_resumable

PATCHES = [
    Patch("Than in ofblethti", "how_to_question", "auto", "explain", "known question"),
    Patch("tion", "billing_refund", "escalate", "apologize", "matches many rows"),
    Patch("no such text", "billing_refund", "escalate", "apologize", "matches no row"),
    Patch("Eauouon.", "known_widespread_bug", None, "give the workaround", None),
    Patch("(a|b)*", "billing_refund", "escalate", "apologize", "not a pattern"),
]
RESIDUAL = Patch("a", fixed.AMBIGUOUS, "auto", "acknowledge, no action needed", "closing remark")


def _rule_labels(df, text="customer_msg_clean"):
    return classify_batch(df, "message_id", text, rule_batch_provider("items", D.RULES))


def prelabelled(spark, sf):
    candidates = store_stage(golden_candidates(D.documents(spark, sf), rules=D.RULES), "candidates")
    return attach_suggestions(candidates, _rule_labels(candidates))


def _labelled_ids(spark, sf):
    return D.table(spark, sf, "labels").select(F.col("doc_id").alias("message_id"))


def partly_prelabelled(spark, sf):
    """Labelling was interrupted: only the documents in ``labels`` have a suggestion."""
    candidates = store_stage(golden_candidates(D.documents(spark, sf), rules=D.RULES), "candidates")
    done = candidates.join(_labelled_ids(spark, sf), "message_id", "left_semi")
    return attach_suggestions(candidates, _rule_labels(done))


def partly_indexed(spark, sf):
    vectors = D.table(spark, sf, "embeddings")
    built = partial_index(
        vectors.select("vec_id", "label"), vectors.select("vec_id", "embedding"), "vec_id", 300
    )
    return built.select("vec_id", "label", F.round("norm", 6).alias("norm"))


def _as_candidates(docs):
    return docs.withColumns(
        {c: F.lit(None).cast("string") for c in ["candidate_intent_heuristic", *CANDIDATE_LABELS]}
    )


def finalized(spark, sf):
    """Toxic documents were labelled by hand; of the others only those in ``labels`` have
    suggestions."""
    docs = D.documents(spark, sf)
    ids = _labelled_ids(spark, sf)
    suggested = _rule_labels(docs.join(ids, "message_id", "left_semi"))
    prelabelled_docs = attach_suggestions(_as_candidates(docs), suggested)
    toxic = D.table(spark, sf, "labels").where(F.col("toxic") == 1)
    done = docs.join(
        toxic.select(F.col("doc_id").alias("message_id")), "message_id", "left_semi"
    ).withColumns(
        {
            "true_intent": F.lit("billing_refund"),
            "escalate_or_auto": F.lit("escalate"),
            "good_reply_should_include": F.lit("by hand"),
            "escalate_reason": F.lit("by hand"),
        }
    )
    return bulk_finalize(prelabelled_docs, done)


def _golden_docs(spark, sf):
    docs = D.documents(spark, sf)
    first = docs.agg(F.min("message_id")).scalar()
    reason = F.when(F.col("message_id") == first, fixed.REVIEW_FLAG).otherwise("reviewed")
    return docs.withColumns(
        {
            "true_intent": F.lit(fixed.AMBIGUOUS),
            "escalate_or_auto": F.lit("escalate"),
            "good_reply_should_include": F.lit("ask"),
            "escalate_reason": reason,
        }
    )


def patched(spark, sf):
    rows, _ = apply_patches(_golden_docs(spark, sf), PATCHES)
    return rows.select("message_id", *CANDIDATE_LABELS)


def patch_report(spark, sf):
    _, report = apply_patches(_golden_docs(spark, sf), PATCHES)
    return report


def residual_patched(spark, sf):
    golden = _golden_docs(spark, sf)
    queue = review_queue(golden).select("message_id", F.lit(True).alias("was_flagged"))
    return (
        patch_residual(golden, RESIDUAL)
        .join(queue, "message_id", "left")
        .select("message_id", "was_flagged", *CANDIDATE_LABELS)
    )


def label_validation(spark, sf):
    labels = D.table(spark, sf, "labels")
    checked = check_labels(labels, {"quality": [1], "toxic": [0]})
    return checked.select(
        "doc_id", "quality", "toxic",
        F.array_join("invalid_columns", ",").alias("invalid_columns"),
        (F.size("invalid_columns") == 0).alias("is_valid"),
    )


def _evaluated(spark, sf, n):
    cases = store_stage(D.pairs(spark, sf), "cases")
    index = sample_index(cases, "message_id")
    golden = store_stage(D.golden(spark, sf), "golden")

    def handle(rows):
        return handle_messages(
            D.with_vectors(spark, sf, rows), index, rule_provider("message", D.RULES),
            brand=D.BRAND, keep=["true_intent", "true_escalate"],
        )

    return evaluation_results(golden, handle, n, rules=D.SECOND_RULES)


def eval_rows(spark, sf):
    return _evaluated(spark, sf, fixed.EVALUATION_SAMPLE_SIZE).withColumn(
        "pipeline_top_similarity", F.round("pipeline_top_similarity", 6)
    )


def accuracies(spark, sf):
    table = metrics.accuracy(_evaluated(spark, sf, None))
    return table.select(
        "model", "n_rows",
        F.round("intent_accuracy", 6).alias("intent_accuracy"),
        F.round("escalate_accuracy", 6).alias("escalate_accuracy"),
    )


def _label_pairs(spark, sf):
    return pair_labels(D.golden(spark, sf), D.second_labels(spark, sf), n=None)


def confusions(spark, sf):
    return metrics.confusion(_label_pairs(spark, sf), "existing_intent", "my_intent")


def judge_prompts(spark, sf):
    return D.pairs(spark, sf).select(
        "message_id",
        rubric_prompt(F.col("customer_msg_clean"), F.col("brand_reply_clean")).alias("prompt"),
    )


def _scores(spark, sf):
    raw = D.rubric_replies(spark, sf)
    return raw.withColumn("_s", parse_rubric(F.col("raw"))).select(
        "message_id", "quality", "toxic", "raw", "_s.*"
    )


def judged(spark, sf):
    scores = _scores(spark, sf)
    results = D.documents(spark, sf).select("message_id")
    return attach_scores(results, scores).withColumn(
        "out_of_range",
        rubric_out_of_range(F.struct(*fixed.RUBRIC_DIMENSIONS)),
    )


def judged_replies(spark, sf):
    """Replies scored by a provider, from prompt to parsed scores.

    The provider answers each prompt that holds its message with the rubric reply of the row.
    """
    results = (
        D.documents(spark, sf)
        .join(D.rubric_replies(spark, sf), "message_id")
        .withColumnsRenamed({"customer_msg_clean": "message", "brand_reply_clean": "pipeline_reply"})
    )

    def provider(df):
        asked = F.contains("prompt", "message") & F.contains("prompt", "pipeline_reply")
        return df.withColumn("raw_response", F.when(asked, F.col("raw")).otherwise(""))

    return judge_replies(results, provider).select(
        "message_id", *fixed.RUBRIC_DIMENSIONS, "justification"
    )


def score_extremes(spark, sf):
    return metrics.score_ranges(metrics.score_distribution(_paired_scores(spark, sf)))


def confusion_table(spark, sf):
    return metrics.confusion_matrix(confusions(spark, sf), list(fixed.INTENTS))


def finalized_counts(spark, sf):
    return label_counts(finalized(spark, sf))


def recorded_labels(spark, sf):
    """Labels recorded in two sittings: first only good ones are valid, then all of them."""
    labels = D.table(spark, sf, "labels")
    path = scratch_path(spark, "labels")
    harmless = labels.where("toxic = 0")
    rejected = record_labels(harmless, path, "doc_id", {"quality": [1]})
    rejected = store_stage(rejected, "rejected")
    record_labels(labels, path, "doc_id", {"quality": [0, 1]})
    marks = rejected.select("doc_id", F.lit(True).alias("was_rejected"))
    recorded = read_done(spark, path, labels.schema).join(marks, "doc_id", "left")
    return recorded.withColumn("was_rejected", F.coalesce("was_rejected", F.lit(False)))


def judge_means(spark, sf):
    return metrics.mean_scores(_scores(spark, sf)).withColumn(
        "mean_score", F.round("mean_score", 6)
    )


def _paired_scores(spark, sf):
    judged_rows = _scores(spark, sf).withColumns(
        {"message": F.col("raw"), "pipeline_reply": F.col("raw")}
    )
    human = D.table(spark, sf, "labels").select(
        F.col("doc_id").alias("message_id"),
        (F.col("quality") * 3 + 1).alias("helpfulness"),
        (F.lit(4) - F.col("toxic") * 2).alias("tone_match"),
        (F.col("quality") * 2 + 1).alias("grounding"),
    )
    return pair_scores(judged_rows, human, n=None)


def agreement(spark, sf):
    table = metrics.rater_agreement(_paired_scores(spark, sf))
    return table.select(
        "dimension", "n_rows",
        F.round("exact_match", 6).alias("exact_match"),
        F.round("within_one", 6).alias("within_one"),
    )


def spot_check(spark, sf):
    paired = _label_pairs(spark, sf)
    columns = ["existing_intent", "my_intent", "existing_escalate", "my_escalate"]
    return metrics.disagreements(paired).select("message_id", "preview", *columns)


def spot_check_rates(spark, sf):
    return metrics.label_agreement(_label_pairs(spark, sf)).select(
        "n_rows",
        F.round("intent_agreement", 6).alias("intent_agreement"),
        F.round("escalate_agreement", 6).alias("escalate_agreement"),
    )


def distribution(spark, sf):
    return metrics.score_distribution(_paired_scores(spark, sf))


def pending_rows(spark, sf):
    source = D.table(spark, sf, "documents").withColumnRenamed("doc_id", "message_id")
    return pending(source, _labelled_ids(spark, sf), "message_id").select(
        "message_id", "lang", "n_chars"
    )


def resumed_labels(spark, sf):
    """Labelling in two runs: the first sees only documents in ``labels``, the second all."""
    docs = D.documents(spark, sf)
    first = docs.join(_labelled_ids(spark, sf), "message_id", "left_semi")
    path, schema = scratch_path(spark, "resumed"), "message_id long, intent string"
    schema = spark.createDataFrame([], schema).schema
    run_resumable(first, path, "message_id", _rule_labels, schema)
    return run_resumable(docs, path, "message_id", _rule_labels, schema, n_parts=2)


QUERIES = {
    "q31_prelabel": prelabelled,
    "q32_partial_prelabel": partly_prelabelled,
    "q33_partial_index": partly_indexed,
    "q34_bulk_finalize": finalized,
    "q34_label_counts": finalized_counts,
    "q35_snippet_patch": patched,
    "q35_snippet_patch_report": patch_report,
    "q36_residual_patch": residual_patched,
    "q37_label_validation": label_validation,
    "q38_eval_rows": eval_rows,
    "q39_accuracy": accuracies,
    "q40_confusion": confusions,
    "q40_confusion_matrix": confusion_table,
    "q41_judge_prompt": judge_prompts,
    "q42_judge_parse": judged,
    "q42_judged_replies": judged_replies,
    "q43_judge_means": judge_means,
    "q44_rater_agreement": agreement,
    "q45_spot_check": spot_check,
    "q45_spot_check_rates": spot_check_rates,
    "q46_score_distribution": distribution,
    "q46_score_ranges": score_extremes,
    "q47_pending_rows": pending_rows,
    "q47_recorded_labels": recorded_labels,
    "q47_resumed_labels": resumed_labels,
}

_NULL_LABELS = ", ".join(f"NULL::VARCHAR AS {c}" for c in CANDIDATE_LABELS)


def _prelabelled_sql(has_suggestion: str) -> str:
    intent = D.sql_intent("customer_msg_clean")
    return f"""WITH {D.DOCS}, {BUCKETS}, {CANDIDATES},
        labelled AS (
            SELECT *, CASE WHEN {has_suggestion} THEN {intent} END AS intent FROM candidates)
        SELECT message_id, customer_msg_clean, brand_reply_clean, candidate_intent_heuristic,
               coalesce(intent, '') AS suggested_intent,
               CASE WHEN intent IS NULL THEN '' ELSE {D.sql_rule_decision("intent")} END
                 AS suggested_escalate_or_auto, {_NULL_LABELS}
        FROM labelled"""


def _template_sql(part: int) -> str:
    branches = " ".join(
        f"WHEN {D.q(i)} THEN {D.q(t[part])}" for i, t in fixed.LABEL_TEMPLATES.items()
    )
    return f"CASE intent {branches} ELSE '' END"


def _patch_value(v: str | None) -> str:
    return "NULL" if v is None else D.q(v)


_PATCH_VALUES = ", ".join(
    f"({i}, {D.q(p.snippet)}, {_patch_value(p.true_intent)}, {_patch_value(p.escalate_or_auto)}, "
    f"{_patch_value(p.good_reply_should_include)}, {_patch_value(p.escalate_reason)})"
    for i, p in enumerate(PATCHES)
)
_PATCH_CTES = f"""
    patches(patch, snippet, n_intent, n_decision, n_note, n_reason) AS (VALUES {_PATCH_VALUES}),
    hits AS (
        SELECT d.message_id, p.*, count(*) OVER (PARTITION BY p.patch) AS n
        FROM docs d JOIN patches p ON contains(d.customer_msg_clean, p.snippet))"""
_REVIEW = f"""CASE WHEN message_id = (SELECT min(message_id) FROM docs)
    THEN '{fixed.REVIEW_FLAG}' ELSE 'reviewed' END"""


def _last(column: str, old: str) -> str:
    return f"""coalesce((SELECT arg_max({column}, patch) FROM hits h
        WHERE h.message_id = d.message_id AND h.n = 1 AND {column} IS NOT NULL), {old})"""


_EVALUATED = f"""{D.PAIR_CTES}, {D.CASES}, {D.INDEX}, {D.DOCS}, {D.GOLDEN},
    messages AS (
        SELECT g.message_id, g.customer_msg_clean, g.true_intent,
               g.escalate_or_auto AS true_escalate, e.embedding::DOUBLE[] AS embedding
        FROM golden g JOIN embeddings e
          ON e.vec_id = {D.sql_hash("g.message_id")} % (SELECT count(*) FROM embeddings)),
    {D.sql_retrieved("messages", "true")},
    scored AS (
        SELECT m.message_id, m.customer_msg_clean AS message, m.true_intent, m.true_escalate,
               {D.sql_intent("m.customer_msg_clean")} AS pipeline_intent,
               {D.sql_intent("m.customer_msg_clean", D.SECOND_RULES)} AS simple_intent,
               coalesce(max(f.similarity), 0.0) AS similarity,
               coalesce(max(f.past_brand_reply) FILTER (f.rank = 1), '') AS reply
        FROM messages m LEFT JOIN found f USING (message_id)
        GROUP BY m.message_id, m.customer_msg_clean, m.true_intent, m.true_escalate),
    verdicts AS (
        SELECT *, {D.sql_decision(
            "pipeline_intent", f"({D.sql_confidence('pipeline_intent')})", "similarity"
        )} FROM scored),
    results AS (
        SELECT message_id, message, true_intent, true_escalate, pipeline_intent,
               decision AS pipeline_escalate, trim(reply) AS pipeline_reply,
               round(similarity, 6) AS pipeline_top_similarity,
               (SELECT true_intent FROM golden GROUP BY true_intent
                ORDER BY count(*) DESC, true_intent LIMIT 1) AS trivial_intent,
               (SELECT escalate_or_auto FROM golden GROUP BY escalate_or_auto
                ORDER BY count(*) DESC, escalate_or_auto LIMIT 1) AS trivial_escalate,
               simple_intent, {D.sql_rule_decision("simple_intent")} AS simple_escalate
        FROM verdicts)"""

_PAIRED_LABELS = f"""{D.GOLDEN_CTES},
    rated AS (
        SELECT message_id, customer_msg_clean AS message, true_intent AS existing_intent,
               escalate_or_auto AS existing_escalate,
               {D.sql_intent("customer_msg_clean")} AS my_intent FROM golden),
    paired AS (SELECT *, {D.sql_rule_decision("my_intent")} AS my_escalate FROM rated)"""

# Scores as the raw replies hold them: form 2 lacks a score and forms 3 and 4 are not JSON.
_SCORES = f"""scores AS (
    SELECT doc_id AS message_id, quality, toxic, form,
           CASE WHEN form IN (2, 3, 4) THEN 3 ELSE quality * 3 + 1 + toxic END AS helpfulness,
           CASE WHEN form IN (2, 3, 4) THEN 3 ELSE 5 - toxic * 2 END AS tone_match,
           CASE WHEN form IN (2, 3, 4) THEN 3 ELSE quality + toxic + 2 END AS grounding,
           CASE WHEN form IN (2, 3, 4) THEN '{fixed.NEUTRAL_JUSTIFICATION}'
                WHEN form = 1 THEN NULL ELSE 'fits' END AS justification
    FROM (SELECT *, {D.sql_hash("doc_id")} % 7 AS form FROM labels))"""
_RATERS = """raters AS (
    SELECT 'judge' AS rater, message_id, helpfulness, tone_match, grounding FROM scores
    UNION ALL
    SELECT 'my', doc_id, quality * 3 + 1, 4 - toxic * 2, quality * 2 + 1 FROM labels),
    long AS (
        SELECT rater, message_id, unnest(['helpfulness', 'tone_match', 'grounding']) AS dimension,
               unnest([helpfulness, tone_match, grounding]) AS score FROM raters)"""

ORACLE = {
    "q47_resumed_labels": f"""WITH {D.DOCS}
        SELECT message_id, {D.sql_intent("customer_msg_clean")} AS intent FROM docs""",
    "q31_prelabel": _prelabelled_sql("true"),
    "q32_partial_prelabel": _prelabelled_sql("message_id IN (SELECT doc_id FROM labels)"),
    "q33_partial_index": f"""
        SELECT vec_id, label, round(sqrt(list_sum(
                 list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))), 6) AS norm
        FROM embeddings ORDER BY {D.sql_sample_order(fixed.INDEX_SEED, "vec_id")}, vec_id
        LIMIT 300""",
    "q34_bulk_finalize": f"""WITH {D.DOCS},
        labelled AS (
            SELECT d.*, l.toxic, l.doc_id IS NULL AS missing,
                   {D.sql_intent("d.customer_msg_clean")} AS intent
            FROM docs d LEFT JOIN labels l ON l.doc_id = d.message_id)
        SELECT message_id, customer_msg_clean, brand_reply_clean,
               CASE WHEN toxic = 1 THEN 'billing_refund' WHEN missing THEN '{fixed.AMBIGUOUS}'
                    ELSE intent END AS true_intent,
               CASE WHEN toxic = 1 OR missing THEN 'escalate'
                    ELSE {D.sql_rule_decision("intent")} END AS escalate_or_auto,
               CASE WHEN toxic = 1 THEN 'by hand' WHEN missing THEN '{fixed.REVIEW_NOTE}'
                    ELSE {_template_sql(0)} END AS good_reply_should_include,
               CASE WHEN toxic = 1 THEN 'by hand' WHEN missing THEN '{fixed.REVIEW_FLAG}'
                    ELSE {_template_sql(1)} END AS escalate_reason
        FROM labelled""",
    "q35_snippet_patch": f"""WITH {D.DOCS}, {_PATCH_CTES}
        SELECT message_id, {_last("n_intent", D.q(fixed.AMBIGUOUS))} AS true_intent,
               {_last("n_decision", "'escalate'")} AS escalate_or_auto,
               {_last("n_note", "'ask'")} AS good_reply_should_include,
               {_last("n_reason", _REVIEW)} AS escalate_reason
        FROM docs d""",
    "q35_snippet_patch_report": f"""WITH {D.DOCS}, {_PATCH_CTES}
        SELECT p.patch::INTEGER AS patch, p.snippet, count(h.message_id) AS n_matches,
               count(h.message_id) = 1 AS applied
        FROM patches p LEFT JOIN hits h ON h.patch = p.patch GROUP BY p.patch, p.snippet""",
    "q36_residual_patch": f"""WITH {D.DOCS},
        golden AS (SELECT *, {_REVIEW} AS reason FROM docs),
        queue AS (SELECT message_id FROM golden WHERE contains(reason, '{fixed.REVIEW_FLAG}')),
        marked AS (
            SELECT g.message_id, g.reason, q.message_id IS NOT NULL AS flagged,
                   q.message_id IS NOT NULL AND (SELECT count(*) FROM queue) = 1
                     AND contains(g.customer_msg_clean, {D.q(RESIDUAL.snippet)}) AS fix
            FROM golden g LEFT JOIN queue q USING (message_id))
        SELECT message_id, CASE WHEN flagged THEN true END AS was_flagged,
               '{fixed.AMBIGUOUS}' AS true_intent,
               CASE WHEN fix THEN 'auto' ELSE 'escalate' END AS escalate_or_auto,
               CASE WHEN fix THEN {D.q(RESIDUAL.good_reply_should_include)} ELSE 'ask' END
                 AS good_reply_should_include,
               CASE WHEN fix THEN {D.q(RESIDUAL.escalate_reason)} ELSE reason END
                 AS escalate_reason
        FROM marked""",
    "q37_label_validation": """
        SELECT doc_id, quality, toxic, quality IS NOT DISTINCT FROM 1
                 AND toxic IS NOT DISTINCT FROM 0 AS is_valid,
               concat_ws(',', CASE WHEN quality IS DISTINCT FROM 1 THEN 'quality' END,
                              CASE WHEN toxic IS DISTINCT FROM 0 THEN 'toxic' END)
                 AS invalid_columns
        FROM labels""",
    "q38_eval_rows": f"""{_EVALUATED}
        SELECT * FROM results
        ORDER BY {D.sql_sample_order(fixed.EVALUATION_SEED, "message_id")}, message_id
        LIMIT {fixed.EVALUATION_SAMPLE_SIZE}""",
    "q39_accuracy": _EVALUATED + "".join(
        f"""{" UNION ALL" if i else ""}
        SELECT '{m}' AS model, count(*) AS n_rows,
               round(avg((coalesce({m}_intent = true_intent, false))::INTEGER), 6)
                 AS intent_accuracy,
               round(avg((coalesce({m}_escalate = true_escalate, false))::INTEGER), 6)
                 AS escalate_accuracy
        FROM results"""
        for i, m in enumerate(["trivial", "simple", "pipeline"])
    ),
    "q40_confusion": f"""{_PAIRED_LABELS}
        SELECT existing_intent AS truth, my_intent AS predicted, count(*) AS n_rows
        FROM paired GROUP BY 1, 2""",
    "q41_judge_prompt": f"""{D.PAIR_CTES}
        SELECT brand_tweet_id AS message_id, {D.sql_fill(
            fixed.RUBRIC_PROMPT, {"message": "customer_msg_clean", "reply": "brand_reply_clean"}
        )} AS prompt FROM clean_pairs""",
    "q42_judge_parse": f"""WITH {_SCORES}
        SELECT d.doc_id AS message_id, s.helpfulness::INTEGER AS helpfulness,
               s.tone_match::INTEGER AS tone_match, s.grounding::INTEGER AS grounding,
               s.justification,
               s.helpfulness NOT BETWEEN 1 AND 5 OR s.tone_match NOT BETWEEN 1 AND 5
                 OR s.grounding NOT BETWEEN 1 AND 5 AS out_of_range
        FROM documents d LEFT JOIN scores s ON s.message_id = d.doc_id""",
    "q42_judged_replies": f"""WITH {_SCORES}
        SELECT s.message_id, s.helpfulness::INTEGER AS helpfulness,
               s.tone_match::INTEGER AS tone_match, s.grounding::INTEGER AS grounding, s.justification
        FROM scores s JOIN documents d ON d.doc_id = s.message_id""",
    "q46_score_ranges": f"""WITH {_SCORES}, {_RATERS}
        SELECT rater, dimension, min(score)::INTEGER AS min_score, max(score)::INTEGER AS max_score
        FROM long GROUP BY rater, dimension""",
    "q40_confusion_matrix": f"""{_PAIRED_LABELS}
        SELECT existing_intent AS truth, {", ".join(
            f'count(*) FILTER (my_intent = {D.q(i)}) AS "{i}"' for i in fixed.INTENTS
        )} FROM paired GROUP BY 1""",
    "q34_label_counts": f"""WITH {D.DOCS}
        SELECT count(*) AS n_rows, count(*) FILTER (l.doc_id IS NULL) AS n_flagged
        FROM docs d LEFT JOIN labels l ON l.doc_id = d.message_id""",
    "q47_recorded_labels": """
        SELECT doc_id, quality, toxic, toxic = 0 AND quality = 0 AS was_rejected FROM labels""",
    "q43_judge_means": f"""WITH {_SCORES}, {_RATERS}
        SELECT dimension, count(*) AS n_rows, round(avg(score), 6) AS mean_score
        FROM long WHERE rater = 'judge' GROUP BY dimension""",
    "q44_rater_agreement": f"""WITH {_SCORES}, {_RATERS}
        SELECT a.dimension, count(*) AS n_rows,
               round(avg((a.score = b.score)::INTEGER), 6) AS exact_match,
               round(avg((abs(a.score - b.score) <= 1)::INTEGER), 6) AS within_one
        FROM long a JOIN long b ON a.message_id = b.message_id AND a.dimension = b.dimension
        WHERE a.rater = 'judge' AND b.rater = 'my' GROUP BY a.dimension""",
    "q45_spot_check": f"""{_PAIRED_LABELS}
        SELECT message_id, substr(message, 1, 60) || '...' AS preview, existing_intent, my_intent,
               existing_escalate, my_escalate
        FROM paired WHERE my_intent <> existing_intent OR my_escalate <> existing_escalate""",
    "q45_spot_check_rates": f"""{_PAIRED_LABELS}
        SELECT count(*) AS n_rows,
               round(avg((my_intent = existing_intent)::INTEGER), 6) AS intent_agreement,
               round(avg((my_escalate = existing_escalate)::INTEGER), 6) AS escalate_agreement
        FROM paired""",
    "q46_score_distribution": f"""WITH {_SCORES}, {_RATERS}
        SELECT rater, dimension, score::INTEGER AS score, count(*) AS n_rows
        FROM long GROUP BY rater, dimension, score""",
    "q47_pending_rows": """
        SELECT doc_id AS message_id, lang, n_chars FROM documents
        WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
}
