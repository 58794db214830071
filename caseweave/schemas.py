"""Declared schemas of the stored tables.  Readers never infer."""

from __future__ import annotations

from pyspark.sql import types as T


def _table(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


_S, _L, _I, _D, _B = (
    T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType(),
)
VECTOR = T.ArrayType(T.FloatType(), True)

TWEETS = _table(
    ("tweet_id", _L), ("author_id", _S), ("inbound", _B), ("created_at", _S), ("text", _S),
    ("response_tweet_id", _S), ("in_response_to_tweet_id", _L),
)

_PAIR_FIELDS = [
    ("thread_id", _L), ("customer_msg", _S), ("brand_reply", _S), ("customer_tweet_id", _L),
    ("brand_tweet_id", _L), ("timestamp", _S), ("customer_msg_clean", _S),
    ("brand_reply_clean", _S),
]
PAIRS = _table(*_PAIR_FIELDS)
INDEX = _table(*_PAIR_FIELDS, ("embedding", VECTOR), ("norm", _D))
CLUSTERED = _table(*_PAIR_FIELDS, ("cluster", _I))

CANDIDATES = _table(
    ("message_id", _L), ("customer_msg_clean", _S), ("brand_reply_clean", _S),
    ("candidate_intent_heuristic", _S), ("true_intent", _S), ("good_reply_should_include", _S),
    ("escalate_or_auto", _S), ("escalate_reason", _S),
)
PRELABELED = _table(
    ("message_id", _L), ("customer_msg_clean", _S), ("brand_reply_clean", _S),
    ("candidate_intent_heuristic", _S), ("suggested_intent", _S), ("true_intent", _S),
    ("suggested_escalate_or_auto", _S), ("escalate_or_auto", _S),
    ("good_reply_should_include", _S), ("escalate_reason", _S),
)
GOLDEN = _table(
    ("message_id", _L), ("customer_msg_clean", _S), ("brand_reply_clean", _S),
    ("true_intent", _S), ("escalate_or_auto", _S), ("good_reply_should_include", _S),
    ("escalate_reason", _S),
)

_RESULT_FIELDS = [
    ("message_id", _L), ("message", _S), ("true_intent", _S), ("true_escalate", _S),
    ("pipeline_intent", _S), ("pipeline_escalate", _S), ("pipeline_reply", _S),
    ("pipeline_top_similarity", _D), ("trivial_intent", _S), ("trivial_escalate", _S),
    ("simple_intent", _S), ("simple_escalate", _S),
]
EVAL_RESULTS = _table(*_RESULT_FIELDS)
JUDGE_SCORES = _table(
    *_RESULT_FIELDS, ("helpfulness", _I), ("tone_match", _I), ("grounding", _I),
    ("justification", _S),
)
MESSAGE_RESULT = _table(
    ("message_id", _L), ("message", _S), ("intent", _S), ("confidence", _S),
    ("drafted_reply", _S), ("decision", _S), ("decision_reason", _S), ("top_similarity", _D),
)
JUDGE_AGREEMENT = _table(
    ("message_id", _L), ("message", _S), ("reply", _S),
    ("judge_helpfulness", _I), ("my_helpfulness", _I), ("judge_tone_match", _I),
    ("my_tone_match", _I), ("judge_grounding", _I), ("my_grounding", _I),
)
SPOT_CHECK = _table(
    ("message_id", _L), ("message", _S), ("existing_intent", _S), ("my_intent", _S),
    ("intent_agree", _B), ("existing_escalate", _S), ("my_escalate", _S), ("escalate_agree", _B),
)

# Vectors beside their key; used where text and vectors are kept in separate tables.
VECTORS = _table(("vec_id", _L), ("embedding", VECTOR), ("label", _I))
CONVERSATIONS = _table(("conv_id", _L), ("turn", _L), ("role", _S), ("text", _S))
DOCUMENTS = _table(
    ("doc_id", _L), ("text", _S), ("lang", _S), ("source", _S), ("n_chars", _L),
)
LABELS = _table(("doc_id", _L), ("quality", _I), ("toxic", _I))

# Model replies.
LABEL_REPLY = "struct<intent:string,confidence:string>"
BATCH_REPLY = "array<struct<index:int,intent:string,confidence:string>>"
RETRIEVED = "array<struct<past_customer_msg:string,past_brand_reply:string,similarity:double>>"
