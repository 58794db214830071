"""Queries on preparation, sampling and keyword rules (q01 - q15)."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseweave import fixed
from caseweave.catalog import data as D
from caseweave.functions import text as T
from caseweave.functions.keywords import add_keyword_intent, rule_decision
from caseweave.operators.filters import drop_short, only_short
from caseweave.operators.labelling import bucket_members, bucket_sizes, golden_candidates
from caseweave.operators.metrics import majority_value
from caseweave.operators.pairs import (
    filter_brand_replies, keep_first, reconstruct_pairs, stage_counts,
)
from caseweave.operators.sampling import sample_exact, sample_prefix
from caseweave.plans.prepare import prepare_pairs
from caseweave.session import scratch_path
from caseweave.sources.tables import overwrite, read_tweets_csv

PAIR_COLUMNS = [
    "thread_id", "customer_msg", "brand_reply", "customer_tweet_id", "brand_tweet_id", "timestamp",
]


def tweets_view(spark, sf):
    return D.tweets(spark, sf).select(
        "tweet_id", "author_id", "inbound", "created_at", "text", "in_response_to_tweet_id"
    )


def tweets_csv(spark, sf):
    """The messages written as a CSV export, line breaks and all, and read back."""
    path = scratch_path(spark, "export")
    overwrite(D.tweets(spark, sf), path, "csv")
    return read_tweets_csv(spark, path).select(
        "tweet_id", "author_id", "inbound", "created_at", "text", "in_response_to_tweet_id"
    )


def brand_replies(spark, sf):
    return filter_brand_replies(D.tweets(spark, sf), D.BRAND).select("tweet_id", "text")


def raw_pairs(spark, sf):
    tweets = D.tweets(spark, sf)
    return reconstruct_pairs(tweets, filter_brand_replies(tweets, D.BRAND)).select(*PAIR_COLUMNS)


def cleaned(spark, sf):
    docs = D.texts(spark, sf, "documents", "doc_id")
    return docs.select("doc_id", "text", T.clean_text(F.col("text")).alias("text_clean"))


def min_length_dedup(spark, sf):
    docs = drop_short(D.documents(spark, sf))
    return keep_first(docs, ["customer_msg_clean"], [F.col("message_id").asc()]).select(
        "message_id", "customer_msg_clean"
    )


def prepared(spark, sf):
    return prepare_pairs(D.tweets(spark, sf), D.BRAND).select(
        *PAIR_COLUMNS, "customer_msg_clean", "brand_reply_clean"
    )


def seeded_sample(spark, sf):
    docs = D.table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    whole = sample_exact(docs, 600, fixed.DISCOVERY_SEED, "doc_id")
    part = sample_prefix(docs, 150, 600, fixed.DISCOVERY_SEED, "doc_id")
    return whole.withColumn("kind", F.lit("sample")).unionByName(
        part.withColumn("kind", F.lit("prefix"))
    )


def short_messages(spark, sf):
    docs = only_short(D.documents(spark, sf))
    return docs.select(
        "message_id", "customer_msg_clean",
        T.word_count(F.col("customer_msg_clean")).alias("n_words"),
    )


def counts_by_stage(spark, sf):
    return stage_counts(D.tweets(spark, sf), D.BRAND)


def buckets(spark, sf):
    return bucket_members(D.documents(spark, sf), rules=D.RULES)


def sizes(spark, sf):
    return bucket_sizes(buckets(spark, sf))


def candidates(spark, sf):
    return golden_candidates(D.documents(spark, sf), rules=D.RULES)


def classified(spark, sf):
    return add_keyword_intent(
        D.documents(spark, sf), "customer_msg_clean", D.RULES
    ).select("message_id", "intent")


def decided_by_rule(spark, sf):
    return classified(spark, sf).withColumn("decision", rule_decision(F.col("intent")))


def majority_baseline(spark, sf):
    decided = decided_by_rule(spark, sf)
    return D.table(spark, sf, "documents").select(
        "doc_id",
        majority_value(decided, "intent").scalar().alias("trivial_intent"),
        majority_value(decided, "decision").scalar().alias("trivial_escalate"),
    )


QUERIES = {
    "q01_tweets_view": tweets_view,
    "q01_tweets_csv": tweets_csv,
    "q02_brand_replies": brand_replies,
    "q03_reconstruct_pairs": raw_pairs,
    "q04_clean_text": cleaned,
    "q05_min_length_dedup": min_length_dedup,
    "q06_pairs_end_to_end": prepared,
    "q07_seeded_sample": seeded_sample,
    "q08_short_messages": short_messages,
    "q09_stage_counts": counts_by_stage,
    "q10_keyword_buckets": buckets,
    "q11_bucket_sizes": sizes,
    "q12_stratified_candidates": candidates,
    "q13_keyword_classify": classified,
    "q14_rule_escalation": decided_by_rule,
    "q15_majority_baseline": majority_baseline,
}

_SAMPLE = D.sql_sample_order(fixed.DISCOVERY_SEED, "doc_id")

BUCKETS = "members AS (" + " UNION ALL ".join(
    [
        f"SELECT message_id, {D.q(intent)} AS bucket, {i} AS bucket_rank FROM docs "
        f"WHERE {D.sql_hits('lower(customer_msg_clean)', words)}"
        for i, (intent, words) in enumerate(D.RULES.items())
    ]
    + [
        f"SELECT message_id, {D.q(fixed.AMBIGUOUS)}, {len(D.RULES)} FROM docs "
        f"WHERE {D.sql_words('customer_msg_clean')} <= 7"
    ]
) + ")"

CANDIDATES = f"""candidates AS (
    SELECT d.message_id, d.customer_msg_clean, d.brand_reply_clean,
           m.bucket AS candidate_intent_heuristic
    FROM (SELECT *, row_number() OVER (PARTITION BY bucket
                 ORDER BY {D.sql_sample_order(fixed.CANDIDATE_SEED, "message_id")}, message_id)
                 AS sample_rank
          FROM members QUALIFY sample_rank <= {fixed.CANDIDATES_PER_INTENT}) m
    JOIN docs d USING (message_id)
    QUALIFY row_number() OVER (PARTITION BY d.customer_msg_clean
                               ORDER BY m.bucket_rank, m.sample_rank) = 1)"""

_LABELLED = f"""labelled AS (
    SELECT message_id, {D.sql_intent("customer_msg_clean")} AS intent FROM docs)"""
_PAIR_LIST = ", ".join(PAIR_COLUMNS)
_NULLS = ", ".join(
    f"NULL::VARCHAR AS {c}"
    for c in ("true_intent", "good_reply_should_include", "escalate_or_auto", "escalate_reason")
)

_TWEETS = f"""WITH {D.TWEETS}
    SELECT tweet_id, author_id, inbound, created_at, text, in_response_to_tweet_id FROM tweets"""

ORACLE = {
    "q01_tweets_view": _TWEETS,
    "q01_tweets_csv": _TWEETS,
    "q02_brand_replies": f"""WITH {D.TWEETS}
        SELECT tweet_id, text FROM tweets WHERE author_id = '{D.BRAND}' AND NOT inbound""",
    "q03_reconstruct_pairs": f"""WITH {D.TWEETS}, {D.RAW_PAIRS}
        SELECT {_PAIR_LIST} FROM raw_pairs""",
    "q04_clean_text": f"""
        SELECT doc_id, text, {D.sql_clean("text")} AS text_clean FROM documents""",
    "q05_min_length_dedup": f"""WITH {D.DOCS}
        SELECT message_id, customer_msg_clean FROM docs WHERE length(customer_msg_clean) > 5
        QUALIFY row_number() OVER (PARTITION BY customer_msg_clean ORDER BY message_id) = 1""",
    "q06_pairs_end_to_end": f"""{D.PAIR_CTES}
        SELECT {_PAIR_LIST}, customer_msg_clean, brand_reply_clean FROM clean_pairs
        ORDER BY {D.sql_sample_order(fixed.PAIR_SEED, "brand_tweet_id")}, brand_tweet_id
        LIMIT {fixed.PAIR_SAMPLE_SIZE}""",
    "q07_seeded_sample": f"""
        (SELECT doc_id, lang, n_chars, 'sample' AS kind FROM documents
         ORDER BY {_SAMPLE} LIMIT 600)
        UNION ALL
        (SELECT doc_id, lang, n_chars, 'prefix' AS kind FROM documents
         ORDER BY {_SAMPLE} LIMIT 150)""",
    "q08_short_messages": f"""WITH {D.DOCS}
        SELECT message_id, customer_msg_clean,
               len(list_filter(string_split(customer_msg_clean, ' '), lambda w: w <> ''))::INTEGER
                 AS n_words
        FROM docs
        WHERE len(list_filter(string_split(customer_msg_clean, ' '), lambda w: w <> '')) <= 7""",
    "q09_stage_counts": f"""{D.PAIR_CTES},
        replies AS (
            SELECT r.tweet_id, r.in_response_to_tweet_id AS pointer, p.tweet_id AS parent,
                   p.inbound AS parent_inbound
            FROM tweets r LEFT JOIN tweets p ON r.in_response_to_tweet_id = p.tweet_id
            WHERE r.author_id = '{D.BRAND}' AND NOT r.inbound)
        SELECT 'replies' AS stage, count(*) AS n_rows FROM replies
        UNION ALL SELECT 'no_pointer', count(*) FROM replies WHERE pointer IS NULL
        UNION ALL SELECT 'parent_absent', count(*) FROM replies
                  WHERE pointer IS NOT NULL AND parent IS NULL
        UNION ALL SELECT 'parent_not_inbound', count(*) FROM replies WHERE NOT parent_inbound
        UNION ALL SELECT 'pairs', count(*) FROM raw_pairs
        UNION ALL SELECT 'long_enough', count(*) FROM raw_pairs
                  WHERE length({D.sql_clean("customer_msg")}) > 5
        UNION ALL SELECT 'distinct_messages', count(*) FROM clean_pairs
        UNION ALL SELECT 'sampled', least(count(*), {fixed.PAIR_SAMPLE_SIZE})
                  FROM clean_pairs""",
    "q10_keyword_buckets": f"WITH {D.DOCS}, {BUCKETS} SELECT message_id, bucket FROM members",
    "q11_bucket_sizes": f"""WITH {D.DOCS}, {BUCKETS}
        SELECT bucket, count(*) AS n_found,
               least(count(*), {fixed.CANDIDATES_PER_INTENT}) AS n_sampled
        FROM members GROUP BY bucket""",
    "q12_stratified_candidates": f"""WITH {D.DOCS}, {BUCKETS}, {CANDIDATES}
        SELECT *, {_NULLS} FROM candidates""",
    "q13_keyword_classify": f"WITH {D.DOCS}, {_LABELLED} SELECT message_id, intent FROM labelled",
    "q14_rule_escalation": f"""WITH {D.DOCS}, {_LABELLED}
        SELECT message_id, intent, {D.sql_rule_decision("intent")} AS decision FROM labelled""",
    "q15_majority_baseline": f"""WITH {D.DOCS}, {_LABELLED},
        decided AS (SELECT intent, {D.sql_rule_decision("intent")} AS decision FROM labelled)
        SELECT doc_id,
               (SELECT intent FROM decided GROUP BY intent ORDER BY count(*) DESC, intent LIMIT 1)
                 AS trivial_intent,
               (SELECT decision FROM decided GROUP BY decision
                ORDER BY count(*) DESC, decision LIMIT 1) AS trivial_escalate
        FROM documents""",
}
