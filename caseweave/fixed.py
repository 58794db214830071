"""Fixed values.

Everything in this file is data, not logic: names, word lists, thresholds and text formats that
must have exactly these values for results (labels, decisions, reasons, prompts) to come out the
same.  Every operator that uses one of them takes it as a default and accepts another.
"""

from __future__ import annotations

DEFAULT_BRAND = "AppleSupport"

RAW_COLUMNS = [
    "tweet_id",
    "author_id",
    "inbound",
    "created_at",
    "text",
    "response_tweet_id",
    "in_response_to_tweet_id",
]

# --- characters -----------------------------------------------------------------------------
# Word and white-space characters as Unicode defines them, spelled out so that the same pattern
# means the same thing in Java's and in RE2's regular expressions.
WORD_CLASS = r"[\p{L}\p{N}_]"
SPACE_SET = (
    r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
SPACE_CLASS = f"[{SPACE_SET}]"
SPACE_CHARS = "".join(
    chr(c)
    for c in [
        *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
        0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    ]
)
NONSPACE_CLASS = f"[^{SPACE_SET}]"
MENTION_PATTERN = "@" + WORD_CLASS + "+"
URL_PATTERN = "http" + NONSPACE_CLASS + "+"

# --- sizes, seeds and thresholds --------------------------------------------------------------
MIN_CLEAN_LENGTH = 5
SHORT_MESSAGE_WORDS = 7
PAIR_SAMPLE_SIZE = 5000
DISCOVERY_SAMPLE_SIZE = 600
INDEX_SAMPLE_SIZE = 1500
CANDIDATES_PER_INTENT = 28
EVALUATION_SAMPLE_SIZE = 50
SPOT_CHECK_SAMPLE_SIZE = 20
AGREEMENT_SAMPLE_SIZE = 15
PAIR_SEED = 42
DISCOVERY_SEED = 42
CANDIDATE_SEED = 42
EVALUATION_SEED = 42
INDEX_SEED = 7
SPOT_CHECK_SEED = 99
AGREEMENT_SEED = 123
LABEL_BATCH_SIZE = 15
EMBED_BATCH_SIZE = 10
RETRIEVED_PER_MESSAGE = 3
N_CLUSTERS = 8
N_CLUSTER_STARTS = 10
MAX_CLUSTER_ITERATIONS = 300
EXAMPLES_PER_CLUSTER = 8
MIN_CONFIDENCE_FOR_AUTO = "high"
MIN_SIMILARITY_FOR_AUTO = 0.45

# --- intents ----------------------------------------------------------------------------------
AMBIGUOUS = "ambiguous_insufficient_context"

INTENTS = {
    "account_access_data_loss": {
        "description": "Customer can't sign in, access iCloud/App Store, or their "
        "purchased/synced content (photos, music, playlists) has disappeared.",
        "examples": [
            "Can't use the App Store; refuses to sign in my Apple ID. Can't download anything.",
            "all my playlist and songs I picked for Apple Music are now gone",
        ],
    },
    "post_update_performance_issue": {
        "description": "Phone is freezing, restarting, slow, or apps are crashing after "
        "a software update. Does NOT primarily mention battery.",
        "examples": [
            "why is my phone freezing every second after your latest update?",
            "my phone acts like it has no cellular service, doesn't wanna load anything, "
            "is it cuz of the update?",
        ],
    },
    "post_update_battery_drain": {
        "description": "Battery draining unusually fast or not holding a charge, "
        "specifically after installing a software update.",
        "examples": [
            "heavy Battery drain on iOS 11.1 on a iPhone 7. Worst than 11.0.3",
            "This new update on my iPhone has really slowed down my battery life",
        ],
    },
    "known_widespread_bug": {
        "description": "A specific, named, reproducible software bug affecting many users "
        "(e.g. a particular glitch), as opposed to a general performance complaint.",
        "examples": [
            "fix the I problem, it's annoying - autocorrect keeps replacing the letter I",
            "you guys better fix this glitch with the LETTER I",
        ],
    },
    "billing_refund": {
        "description": "Customer was charged incorrectly, charged twice, or wants a refund.",
        "examples": [
            "billed twice for icloud storage",
            "I was charged for a subscription I already cancelled, please refund",
        ],
    },
    "how_to_question": {
        "description": "Customer wants guidance on how to do something. Nothing is broken; "
        "they just don't know how to use a feature.",
        "examples": [
            "New phone and it wont let me screenshot... thanks apple",
            "how do I turn off read receipts in messages",
        ],
    },
    "ambiguous_insufficient_context": {
        "description": "Message is too short, vague, or context-dependent to classify "
        "confidently on its own (e.g. a reactive follow-up in a thread).",
        "examples": [
            "This keeps popping up too.",
            "MINE DOES THE SAME I GET SO MAD",
        ],
    },
}

KEYWORD_RULES = {
    "account_access_data_loss": [
        "sign in", "icloud", "apple id", "can't access", "cant access",
        "disappeared", "missing", "gone", "lost my", "purchase history",
    ],
    "post_update_performance_issue": [
        "freez", "restart", "crash", "slow", "lag", "won't load", "wont load",
    ],
    "post_update_battery_drain": [
        "battery", "drain", "won't hold a charge", "wont hold a charge",
    ],
    "known_widespread_bug": ["glitch", "bug", "letter i", "autocorrect", "emoji"],
    "billing_refund": ["charge", "billed", "refund", "money", "subscription", "payment"],
    "how_to_question": ["how do i", "how to", "how can i", "is there a way"],
}

ALWAYS_ESCALATE_INTENTS = [
    "billing_refund",
    "account_access_data_loss",
    "ambiguous_insufficient_context",
]

DECISIONS = ["auto", "escalate"]
CONFIDENCES = ["high", "medium", "low"]
RUBRIC_DIMENSIONS = ["helpfulness", "tone_match", "grounding"]
RUBRIC_SCORES = [1, 2, 3, 4, 5]

# --- decision reasons; <<name>> marks a value filled in per row ----------------------------------
REASON_VAGUE = "message is too vague or lacks context to act on confidently"
REASON_SENSITIVE = (
    "intent '<<intent>>' typically requires account-specific "
    "verification (money or personal data involved)"
)
REASON_CONFIDENCE = (
    "classifier confidence was '<<confidence>>', not high enough "
    "to trust an automated response"
)
REASON_NOVEL = (
    "no sufficiently similar past case found (best match "
    "similarity: <<similarity>>), situation may be novel"
)
REASON_AUTO = "generic, high-confidence issue with a known precedent, no account access needed"

# --- labelling ------------------------------------------------------------------------------------
REVIEW_FLAG = "NEEDS MANUAL REVIEW"
REVIEW_NOTE = "NEEDS MANUAL REVIEW - no AI suggestion available"

# intent -> (what a good reply should include, reason for the decision)
LABEL_TEMPLATES = {
    "account_access_data_loss": (
        "check account/iCloud status, verify identity",
        "account-specific issue, needs verification",
    ),
    "post_update_performance_issue": (
        "ask device/iOS version, suggest restart",
        "generic troubleshooting, no account access needed",
    ),
    "post_update_battery_drain": (
        "ask device/iOS version, suggest battery troubleshooting steps",
        "generic troubleshooting, no account access needed",
    ),
    "known_widespread_bug": (
        "acknowledge known bug, give workaround or fixed version",
        "known issue, workaround available",
    ),
    "billing_refund": (
        "apologize, ask for order/receipt ID, route to billing team",
        "involves money, needs account-specific verification",
    ),
    "how_to_question": (
        "give clear how-to steps or link to relevant setting",
        "generic how-to question, no account access needed",
    ),
    "ambiguous_insufficient_context": (
        "ask for more detail or clarification",
        "not enough information to determine intent",
    ),
}

NEUTRAL_SCORE = 3
NEUTRAL_JUSTIFICATION = "PARSE_FAILED - neutral default score"

# --- prompts; <<name>> marks a value filled in per row -------------------------------------------
PROMPT_ACCOUNT = "Apple's\nsupport Twitter account"

TAXONOMY_ENTRY = "- <<intent>>: <<description>>\n  Examples:\n<<examples>>\n"
TAXONOMY_EXAMPLE = '    - "<<example>>"'

CLASSIFY_PROMPT = """You are classifying customer support messages sent to <<account>> into exactly one of the following intents.

<<taxonomy>>

Classify this new message:
"<<message>>"

Respond with ONLY valid JSON, no other text, in this exact format:
{"intent": "<one of the intent ids above>", "confidence": "<high|medium|low>"}
"""

CLASSIFY_BATCH_PROMPT = """You are classifying customer support messages sent to <<account>> into exactly one of the following intents.

<<taxonomy>>

Classify EACH of these <<count>> messages:
<<messages>>

Respond with ONLY a valid JSON array, no other text, with one object per
message in the SAME ORDER, in this exact format:
[{"index": 0, "intent": "<intent_id>", "confidence": "<high|medium|low>"}, ...]
"""
BATCH_LINE = '<<index>>. "<<message>>"'

REPLY_PROMPT = """You are <<brand>>, replying to a customer on Twitter.
Here is how this brand has replied to similar past issues:

<<examples>>
Now draft a reply to this NEW customer message, in the same tone and
style as the examples above. The message's intent has been classified
as: <<intent>>

New customer message: "<<message>>"

Respond with ONLY the reply text, nothing else - no preamble, no labels.
"""
REPLY_EXAMPLE = (
    "Example <<number>> (similarity: <<similarity>>):\n"
    "  Customer: <<customer>>\n"
    "  Brand reply: <<reply>>\n\n"
)

RUBRIC_PROMPT = """You are an expert quality reviewer for customer support replies.
Score the DRAFTED REPLY below on three dimensions, each from 1 (poor) to
5 (excellent):

- helpfulness: does it actually address the customer's specific problem?
- tone_match: does it sound like a real, professional brand support agent
  (not generic, not robotic, not overly casual)?
- grounding: does it stay consistent with what a real support reply would
  say, without inventing specific facts, promises, or details it can't
  actually know?

Customer message: "<<message>>"

Drafted reply: "<<reply>>"

Respond with ONLY valid JSON, no other text, in this exact format:
{"helpfulness": <1-5>, "tone_match": <1-5>, "grounding": <1-5>, "justification": "<one short sentence>"}
"""
