"""The given tables in the shapes the operators work on, for Spark and for the SQL twins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseweave import fixed, schemas
from caseweave.functions.keywords import add_keyword_intent, rule_decision
from caseweave.functions.text import clean_text, fill_text
from caseweave.operators import clustering
from caseweave.plans.prepare import clean_pairs
from caseweave.sources.conversations import TURNS_PER_CONVERSATION, tweets_from_turns
from caseweave.sources.tables import read_table, spread_few_splits

BRAND = "assistant"

# Keywords that occur in the given texts, in place of the English support vocabulary.
RULES = {
    "account_access_data_loss": ["license", "lag"],
    "post_update_performance_issue": ["und ", "***"],
    "post_update_battery_drain": ["que", "batt"],
    "known_widespread_bug": ["bug", "heit"],
    "billing_refund": ["ment", "charge"],
    "how_to_question": ["sh ", "tion"],
}
# A second opinion: the same rules, tried in the opposite order.
SECOND_RULES = dict(reversed(RULES.items()))


# ----------------------------------------------------------------------------------------------
# Spark
# ----------------------------------------------------------------------------------------------
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = {
        "conversations": schemas.CONVERSATIONS,
        "documents": schemas.DOCUMENTS,
        "embeddings": schemas.VECTORS,
        "labels": schemas.LABELS,
    }[name]
    return read_table(spark, f"{sf_dir}/{name}.parquet", schema)


def texts(spark: SparkSession, sf_dir: str, name: str, *key: str) -> DataFrame:
    """A table whose texts are about to be processed."""
    return spread_few_splits(table(spark, sf_dir, name), *key)


def tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tweets_from_turns(texts(spark, sf_dir, "conversations", "conv_id", "turn"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as messages: the cleaned text, and the source in place of a reply."""
    return texts(spark, sf_dir, "documents", "doc_id").select(
        F.col("doc_id").alias("message_id"),
        clean_text(F.col("text")).alias("customer_msg_clean"),
        F.col("source").alias("brand_reply_clean"),
    )


def hash_number(key: Column) -> Column:
    """Number from the md5 of a key; the same in both engines."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint")


def with_vectors(spark: SparkSession, sf_dir: str, df: DataFrame, how: str = "inner") -> DataFrame:
    """Messages with a vector each: the given vectors, dealt out by hash of the message id.

    A message without an id has none, and stays with ``how="left"``.
    """
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    n_vectors = vectors.agg(F.count(F.lit(1)).alias("n")).scalar()
    return (
        df.withColumn("vec_id", F.pmod(hash_number(F.col("message_id")), n_vectors))
        .join(vectors, "vec_id", how)
        .drop("vec_id")
    )


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean pairs with vectors; the index, and the messages of the flagship."""
    cleaned = clean_pairs(tweets(spark, sf_dir), BRAND)
    return with_vectors(
        spark,
        sf_dir,
        cleaned.select(
            F.col("brand_tweet_id").alias("message_id"),
            "customer_msg_clean",
            "brand_reply_clean",
        ),
    )


def golden(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents; the given labels and the second rules stand in for hand-made labels."""
    labelled = documents(spark, sf_dir).join(
        table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "message_id"), "message_id"
    )
    judged = add_keyword_intent(labelled, "customer_msg_clean", SECOND_RULES, "_intent")
    toxic, poor = F.col("toxic") == 1, F.col("quality") == 0
    return judged.select(
        "message_id",
        "customer_msg_clean",
        "brand_reply_clean",
        F.when(toxic, "billing_refund").when(poor, fixed.AMBIGUOUS)
        .otherwise(F.col("_intent")).alias("true_intent"),
        F.when(toxic | poor, "escalate").otherwise("auto").alias("escalate_or_auto"),
    )


def second_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of a second rater for the same documents: the rules in their usual order."""
    rated = add_keyword_intent(
        golden(spark, sf_dir).select("message_id", "customer_msg_clean"),
        "customer_msg_clean", RULES, "true_intent",
    )
    return rated.withColumn("escalate_or_auto", rule_decision(F.col("true_intent")))


def rubric_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rubric replies written from the labels, in all the forms a model may answer."""
    form = F.pmod(hash_number(F.col("doc_id")), F.lit(7))
    score = {
        "h": F.col("quality") * 3 + 1 + F.col("toxic"),
        "t": F.lit(5) - F.col("toxic") * 2,
        "g": F.col("quality") + F.col("toxic") + 2,
    }
    text = {name: value.cast("string") for name, value in score.items()}
    plain = F.concat(
        F.lit('{"helpfulness": '), text["h"], F.lit(', "tone_match": '), text["t"],
        F.lit(', "grounding": '), text["g"], F.lit(', "justification": "fits"}'),
    )
    quoted = F.concat(
        F.lit('{"helpfulness": "'), text["h"], F.lit('", "tone_match": '), text["t"],
        F.lit('.7, "grounding": '), text["g"], F.lit("}"),
    )
    missing = F.concat(
        F.lit('{"helpfulness": '), text["h"], F.lit(', "grounding": '), text["g"], F.lit("}")
    )
    raw = (
        F.when(form == 0, F.concat(F.lit("```json\n"), plain, F.lit("\n```")))
        .when(form == 1, quoted)
        .when(form == 2, missing)
        .when(form == 3, F.concat(plain, F.lit(" as asked }")))
        .when(form == 4, F.lit("I would give it a 4"))
        .otherwise(plain)
    )
    return table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("message_id"), "quality", "toxic", raw.alias("raw")
    )


# ----------------------------------------------------------------------------------------------
# SQL
# ----------------------------------------------------------------------------------------------
def q(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def sql_clean(column: str) -> str:
    no_mentions = f"regexp_replace({column}, {q(fixed.MENTION_PATTERN)}, '', 'g')"
    no_links = f"regexp_replace({no_mentions}, {q(fixed.URL_PATTERN)}, '', 'g')"
    return f"trim(regexp_replace({no_links}, {q(fixed.SPACE_CLASS + '+')}, ' ', 'g'))"


def sql_words(column: str) -> str:
    return f"len(regexp_extract_all({column}, {q(fixed.NONSPACE_CLASS + '+')}))"


def sql_strip(column: str) -> str:
    ends = f"^{fixed.SPACE_CLASS}+|{fixed.SPACE_CLASS}+$"
    return f"regexp_replace({column}, {q(ends)}, '', 'g')"


def sql_unfence(column: str) -> str:
    body = sql_strip(column)
    for fence in ("^```json", "^```", "```$"):
        body = f"regexp_replace({body}, {q(fence)}, '')"
    return sql_strip(body)


def sql_hits(lowered: str, keywords: list[str]) -> str:
    return "(" + " OR ".join(f"contains({lowered}, {q(k)})" for k in keywords) + ")"


def sql_intent(column: str, rules: dict[str, list[str]] = RULES) -> str:
    branches = " ".join(
        f"WHEN {sql_hits(f'lower({column})', words)} THEN {q(intent)}"
        for intent, words in rules.items()
    )
    return (
        f"CASE WHEN {sql_words(column)} <= 7 THEN {q(fixed.AMBIGUOUS)} {branches} "
        f"ELSE {q(fixed.AMBIGUOUS)} END"
    )


def sql_in(values: list[str]) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def sql_rule_decision(column: str) -> str:
    return (
        f"CASE WHEN {column} IN {sql_in(fixed.ALWAYS_ESCALATE_INTENTS)} "
        "THEN 'escalate' ELSE 'auto' END"
    )


def sql_confidence(intent: str) -> str:
    return f"CASE WHEN {intent} = {q(fixed.AMBIGUOUS)} THEN 'low' ELSE 'high' END"


def sql_fill(template: str, values: dict[str, str]) -> str:
    """SQL expression that fills a template; values are SQL expressions."""
    pieces = template.replace(">>", "<<").split("<<")
    return " || ".join(
        q(piece) if i % 2 == 0 else f"({values[piece]})" for i, piece in enumerate(pieces)
    )


def sql_decision(intent: str, confidence: str, similarity: str) -> str:
    """(decision, reason) as two columns."""
    sensitive = f"{intent} IN {sql_in(fixed.ALWAYS_ESCALATE_INTENTS)}"
    number = f"printf('%.2f', round({similarity}, 2))"
    auto = f"NOT ({sensitive}) AND {confidence} = 'high' AND {similarity} >= 0.45"
    return f"""
        CASE WHEN {auto} THEN 'auto' ELSE 'escalate' END AS decision,
        CASE WHEN {intent} = {q(fixed.AMBIGUOUS)} THEN {q(fixed.REASON_VAGUE)}
             WHEN {sensitive} THEN {sql_fill(fixed.REASON_SENSITIVE, {"intent": intent})}
             WHEN {confidence} IS DISTINCT FROM 'high'
               THEN {sql_fill(fixed.REASON_CONFIDENCE, {"confidence": confidence})}
             WHEN {similarity} < 0.45
               THEN {sql_fill(fixed.REASON_NOVEL, {"similarity": number})}
             ELSE {q(fixed.REASON_AUTO)} END AS decision_reason"""


def sql_hash(key: str) -> str:
    return f"('0x' || substr(md5(({key})::VARCHAR), 1, 8))::BIGINT"


def sql_sample_order(seed: int, key: str) -> str:
    return f"md5('{seed}:' || ({key})::VARCHAR)"


TWEETS = f"""tweets AS (
    SELECT conv_id * {TURNS_PER_CONVERSATION} + turn AS tweet_id, role AS author_id,
           role = 'user' AS inbound, conv_id || '-' || turn AS created_at, text,
           lag(conv_id * {TURNS_PER_CONVERSATION} + turn)
             OVER (PARTITION BY conv_id ORDER BY turn) AS in_response_to_tweet_id
    FROM conversations)"""

RAW_PAIRS = f"""raw_pairs AS (
    SELECT p.tweet_id AS thread_id, p.text AS customer_msg, r.text AS brand_reply,
           p.tweet_id AS customer_tweet_id, r.tweet_id AS brand_tweet_id,
           r.created_at AS timestamp
    FROM tweets r JOIN tweets p ON r.in_response_to_tweet_id = p.tweet_id
    WHERE r.author_id = '{BRAND}' AND NOT r.inbound AND p.inbound)"""

CLEAN_PAIRS = f"""clean_pairs AS MATERIALIZED (
    SELECT * FROM (
        SELECT *, {sql_clean("customer_msg")} AS customer_msg_clean,
               {sql_clean("brand_reply")} AS brand_reply_clean
        FROM raw_pairs)
    WHERE length(customer_msg_clean) > 5
    QUALIFY row_number() OVER (PARTITION BY customer_msg_clean ORDER BY brand_tweet_id) = 1)"""

CASES = f"""cases AS MATERIALIZED (
    SELECT p.brand_tweet_id AS message_id, p.customer_msg_clean, p.brand_reply_clean,
           e.embedding::DOUBLE[] AS embedding
    FROM clean_pairs p JOIN embeddings e
      ON e.vec_id = {sql_hash("p.brand_tweet_id")} % (SELECT count(*) FROM embeddings))"""

INDEX = f"""idx AS MATERIALIZED (
    SELECT * FROM cases ORDER BY {sql_sample_order(fixed.INDEX_SEED, "message_id")}, message_id
    LIMIT {fixed.INDEX_SAMPLE_SIZE})"""


def sql_retrieved(
    messages: str = "cases", allowed: str = "m.message_id <> i.message_id"
) -> str:
    """``found``: the best three cases of every message, by default other than itself."""
    return f"""compared AS MATERIALIZED (
    SELECT m.message_id, i.message_id AS case_id,
           round(list_cosine_similarity(m.embedding, i.embedding), 9) AS similarity
    FROM {messages} m JOIN idx i ON {allowed}),
    nearest AS MATERIALIZED (
    SELECT *, row_number() OVER (PARTITION BY message_id ORDER BY similarity DESC, case_id) AS rank
    FROM compared QUALIFY rank <= 3),
    found AS MATERIALIZED (
    SELECT n.*, i.customer_msg_clean AS past_customer_msg, i.brand_reply_clean AS past_brand_reply
    FROM nearest n JOIN idx i ON i.message_id = n.case_id)"""


def sql_embedded(name: str, source: str, key: str, text: str, n_features: int) -> str:
    """CTE ``name(key, vector, norm)``: hashed words weighted by rarity, of unit length."""
    words = f"unnest(regexp_extract_all(lower(coalesce({text}, '')), {q(fixed.NONSPACE_CLASS + '+')}))"
    return f"""
    {name}_words AS MATERIALIZED (
        SELECT key, {sql_hash("word")} % {n_features} AS feature, count(*) AS n
        FROM (SELECT {key} AS key, {words} AS word FROM {source}) GROUP BY ALL),
    {name}_weights AS MATERIALIZED (
        SELECT feature, ln(((SELECT count(*) FROM {source}) + 1)::DOUBLE / (count(*) + 1)) AS weight
        FROM {name}_words GROUP BY feature),
    {name}_values AS MATERIALIZED (
        SELECT key, feature, n * weight AS value, sqrt(sum((n * weight) ** 2) OVER (PARTITION BY key)) AS norm
        FROM {name}_words JOIN {name}_weights USING (feature)),
    {name} AS MATERIALIZED (
        SELECT s.key, list(coalesce((v.value / nullif(v.norm, 0))::FLOAT, 0::FLOAT)::DOUBLE ORDER BY s.feature) AS vector,
               coalesce(max(v.norm), 0.0) AS norm
        FROM (SELECT {key} AS key, feature FROM {source}, range({n_features}) AS f(feature)) s
        LEFT JOIN {name}_values v ON v.key = s.key AND v.feature = s.feature
        GROUP BY s.key)"""


def sql_kmeans(points: str, steps: int, seed: int = fixed.DISCOVERY_SEED) -> str:
    """CTEs ``km_centres(cluster, x)`` and ``km_assigned(key, cluster, far)`` of ``points(key, x)``.

    The same draws, reductions and steps for every start as in ``operators.clustering``, with room for
    ``steps`` of the latter; those after the last that moves a centre change nothing.
    """
    k, starts = fixed.N_CLUSTERS, fixed.N_CLUSTER_STARTS
    far = f"round(list_distance(p.x, c.x) ** 2, {clustering.DECIMALS})"
    factors = ", ".join(
        f"({r}, {s}, {a}, {b})"
        for r in range(clustering.INIT_ROUNDS + 1)
        for s in range(starts)
        for a, b in [clustering.draw_factors(seed, s, r)]
    )
    parts = [
        f"km_points AS MATERIALIZED (SELECT key, {sql_hash('key')} AS hash, x FROM {points})",
        f"""km_chances AS MATERIALIZED (
            SELECT r, s, key, x, ((hash * a + b) % {clustering._PRIME})::DOUBLE / {clustering._PRIME} AS u
            FROM km_points, (VALUES {factors}) AS f(r, s, a, b))""",
        """km_drawn0 AS MATERIALIZED (
            SELECT s, 0 AS idx, x FROM km_chances WHERE r = 0
            QUALIFY row_number() OVER (PARTITION BY s ORDER BY u, key) = 1)""",
    ]
    for r in range(1, clustering.INIT_ROUNDS + 1):
        parts += [
            f"""km_far{r} AS MATERIALIZED (
                SELECT s, key, min({far}) AS far FROM km_points p, km_drawn{r - 1} c GROUP BY s, key)""",
            f"""km_drawn{r} AS MATERIALIZED (
                SELECT s, idx, x FROM km_drawn{r - 1} UNION ALL
                SELECT s, {r} * 1000000 + row_number() OVER (PARTITION BY s ORDER BY u, key) AS idx, x
                FROM (SELECT c.s, c.key, c.x, c.u, f.far, sum(f.far) OVER (PARTITION BY c.s) AS total
                      FROM km_chances c JOIN km_far{r} f ON f.s = c.s AND f.key = c.key WHERE c.r = {r})
                WHERE u * (total / {clustering.OVERSAMPLING * k}) < far)""",
        ]
    last = clustering.INIT_ROUNDS
    parts += [
        f"""km_near AS MATERIALIZED (
            SELECT c.s, c.idx FROM km_points p, km_drawn{last} c
            QUALIFY row_number() OVER (PARTITION BY c.s, p.key ORDER BY {far}, c.idx) = 1)""",
        f"""km_weighed AS MATERIALIZED (
            SELECT d.s, d.idx, d.x, count(n.idx) AS w FROM km_drawn{last} d LEFT JOIN km_near n ON n.s = d.s AND n.idx = d.idx
            GROUP BY d.s, d.idx, d.x)""",
        """km_first0 AS MATERIALIZED (
            SELECT s, 0 AS cluster, x FROM km_weighed QUALIFY row_number() OVER (PARTITION BY s ORDER BY w DESC, idx) = 1)""",
    ]
    for j in range(1, k):
        parts.append(
            f"""km_first{j} AS MATERIALIZED (
                SELECT * FROM km_first{j - 1} UNION ALL
                SELECT s, {j} AS cluster, x FROM (
                    SELECT p.s, p.idx, p.x, p.w * min({far}) AS score
                    FROM km_weighed p JOIN km_first{j - 1} c ON c.s = p.s GROUP BY p.s, p.idx, p.x, p.w)
                WHERE score > 0
                QUALIFY row_number() OVER (PARTITION BY s ORDER BY score DESC, idx) = 1)"""
        )
    parts.append(f"km_step0 AS MATERIALIZED (SELECT * FROM km_first{k - 1})")
    near = f"""SELECT p.key, c.s, c.cluster, {far} AS far FROM km_points p, {{centres}} c
            QUALIFY row_number() OVER (PARTITION BY c.s, p.key ORDER BY {far}, c.cluster) = 1"""
    for t in range(1, steps + 1):
        parts.append(
            f"""km_step{t} AS MATERIALIZED (
                SELECT c.s, c.cluster, coalesce(m.x, c.x) AS x
                FROM km_step{t - 1} c LEFT JOIN (
                    SELECT s, cluster, list(v ORDER BY i) AS x FROM (
                        SELECT a.s, a.cluster, i, avg(p.x[i]) AS v
                        FROM ({near.format(centres=f"km_step{t - 1}")}) a
                        JOIN km_points p ON p.key = a.key, unnest(range(1, len(p.x) + 1)) AS d(i) GROUP BY ALL)
                    GROUP BY s, cluster) m ON m.s = c.s AND m.cluster = c.cluster)"""
        )
    return ", ".join(
        [
            *parts,
            f"km_all AS MATERIALIZED ({near.format(centres=f'km_step{steps}')})",
            """km_best AS MATERIALIZED (
                SELECT s FROM km_all GROUP BY s ORDER BY round(sum(far), 6), s LIMIT 1)""",
            f"km_centres AS MATERIALIZED (SELECT cluster, x FROM km_step{steps} WHERE s = (SELECT s FROM km_best))",
            "km_assigned AS MATERIALIZED (SELECT key, cluster, far FROM km_all WHERE s = (SELECT s FROM km_best))",
        ]
    )


PAIR_CTES = f"WITH {TWEETS}, {RAW_PAIRS}, {CLEAN_PAIRS}"
CASE_CTES = f"{PAIR_CTES}, {CASES}, {INDEX}, {sql_retrieved()}"

DOCS = f"""docs AS (
    SELECT doc_id AS message_id, {sql_clean("text")} AS customer_msg_clean,
           source AS brand_reply_clean
    FROM documents)"""

GOLDEN = f"""golden AS (
    SELECT d.message_id, d.customer_msg_clean, d.brand_reply_clean,
           CASE WHEN l.toxic = 1 THEN 'billing_refund'
                WHEN l.quality = 0 THEN {q(fixed.AMBIGUOUS)}
                ELSE {sql_intent("d.customer_msg_clean", SECOND_RULES)} END AS true_intent,
           CASE WHEN l.toxic = 1 OR l.quality = 0 THEN 'escalate' ELSE 'auto' END
             AS escalate_or_auto
    FROM docs d JOIN labels l ON l.doc_id = d.message_id)"""

GOLDEN_CTES = f"WITH {DOCS}, {GOLDEN}"

_TAXONOMY = "".join(
    fill_text(
        fixed.TAXONOMY_ENTRY,
        {
            "intent": intent,
            "description": info["description"],
            "examples": "\n".join(
                fill_text(fixed.TAXONOMY_EXAMPLE, {"example": e}) for e in info["examples"]
            ),
        },
    )
    for intent, info in fixed.INTENTS.items()
)
PROMPT_CONSTANTS = {"account": q(fixed.PROMPT_ACCOUNT), "taxonomy": q(_TAXONOMY)}
