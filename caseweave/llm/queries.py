"""The registered queries of the corpus operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from caseweave.llm import (
    chat,
    decontaminate,
    filter_audit,
    html,
    lexical,
    near_dedup,
    packing,
    pii,
    quality,
    suffix_dedup,
    token_store,
    url_filter,
    window_dedup,
)
from caseweave.llm.common import read
from caseweave.session import scratch_path


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    path = scratch_path(spark, "token-store")
    token_store.write_store(docs, path)
    found = token_store.read_documents(spark, path, docs, with_ids=False)
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", control), (-7, 1, "assistant", control)], rows.schema)
    path = scratch_path(spark, "chats")
    chat.write_chats(rows.unionByName(extra), path)
    return chat.digest(chat.read_turns(spark, path))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_pages(read(spark, sf_dir, "pages"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    judged = quality.judge(docs, quality.fit(docs, read(spark, sf_dir, "labels")))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.summary(read(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return decontaminate.judge(found).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


#: Host, path and verdict of the contract's rules.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge_urls(read(spark, sf_dir, "pages"), rules)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), with_ids=False).drop("ids")


def op10_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_passages(read(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lexical.search_all(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("item_id", "rank", "doc_id", "score")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op13_repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = window_dedup.remove_repeats(read(spark, sf_dir, "documents"), with_text=False)
    return left.select("doc_id", "n_words", "n_removed", "kept_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_store,
        op2_near_duplicates,
        op3_chat_format,
        op4_main_text,
        op5_quality_rules,
        op6_personal_data,
        op7_decontaminate,
        op8_url_filter,
        op9_packing,
        op10_repeated_passages,
        op11_ranked_search,
        op12_filter_audit,
        op13_repeated_windows,
    )
}

_ESCAPED = r"""regexp_replace(regexp_replace({0}, '<(\\*)(/?s>)', '<\\\1\2', 'g'), '\[(\\*)(/?INST\])', '[\\\1\2', 'g')"""

ORACLE: dict[str, str] = {
    "op3_chat_format": rf"""
        WITH c AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
        ), g AS (
            SELECT conv_id, count(*) AS n_turns,
                string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, md5(text)) AS turns,
                coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, md5(text)), '') AS loss,
                sum(10 + length({_ESCAPED.format("role")}) + 9 + length({_ESCAPED.format("text")}) + 5) AS formatted_chars
            FROM c GROUP BY conv_id
        )
        SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
            CAST(formatted_chars AS BIGINT) AS formatted_chars
        FROM g
    """,
    "op7_decontaminate": r"""
        WITH dw AS (
            SELECT row_number() OVER () AS r, doc_id,
                regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents
        ), bw AS (
            SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item,
                regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark
        ), pat AS (
            SELECT DISTINCT item, least(10, len(w)) AS m, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS p
            FROM bw, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS u(i) WHERE len(w) > 0
        ), size AS (SELECT DISTINCT m FROM pat),
        win AS (
            SELECT r, m, i, array_to_string(w[i : i + m - 1], ' ') AS p
            FROM dw, size, unnest(range(1, len(w) - m + 2)) AS u(i)
        ), hit AS (SELECT r, win.m, i, item FROM win JOIN pat ON win.m = pat.m AND win.p = pat.p),
        words AS (
            SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT DISTINCT r, m, i FROM hit), unnest(range(i, i + m)) AS u(j) GROUP BY r
        ), items AS (
            SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
            sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM dw LEFT JOIN words USING (r) LEFT JOIN items USING (r)
    """,
    "op8_url_filter": r"""
        WITH u AS (
            SELECT page_id, instr(coalesce(url, ''), '://') AS pos, coalesce(url, '') AS url FROM pages
        ), p AS (
            SELECT page_id, CASE WHEN pos = 0 THEN '' ELSE regexp_extract(substr(url, pos + 3), '^[^/?#]*') END AS raw,
                CASE WHEN pos = 0 THEN '' ELSE regexp_extract(substr(url, pos + 3), '^[^/?#]*([^?#]*)', 1) END AS path
            FROM u
        ), h AS (
            SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM p
        ), f AS (
            SELECT *, 'x.' || host AS sub FROM h
        ), r AS (
            SELECT page_id, host, path, CASE
                WHEN sub LIKE '%.www.example.com' AND path LIKE '/en/%' THEN 'www.example.com/en/'
                WHEN sub LIKE '%.example.com' AND path LIKE '/en/%' THEN 'example.com/en/'
                WHEN sub LIKE '%.net' AND path LIKE '/es/%' THEN 'net/es/'
                WHEN sub LIKE '%.net' AND path LIKE '/fr/%' THEN 'net/fr/'
                WHEN sub LIKE '%.com' AND path LIKE '/%' THEN 'com/'
            END AS rule FROM f
        )
        SELECT page_id, host, path, rule,
            CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
        FROM r
    """,
    "op11_ranked_search": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id,
                regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
            FROM documents
        ), q AS (
            SELECT DISTINCT item_id,
                unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark
        ), s AS (
            SELECT CAST(count(*) FILTER (len(w) > 0) AS BIGINT) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d
        ), m AS (
            SELECT r, doc_id, CAST(50 + (50 * len(w) * n_docs) // n_terms AS BIGINT) AS m FROM d, s WHERE len(w) > 0
        ), tf AS (
            SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY r, term
        ), wt AS (
            SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
            FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), s
        ), sc AS (
            SELECT item_id, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
            FROM q JOIN wt USING (term) JOIN tf USING (term) JOIN m USING (r) GROUP BY item_id, r
        ), ranked AS (
            SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
            FROM sc JOIN m USING (r) WHERE score > 0
        )
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
    """,
    "op12_filter_audit": r"""
        WITH d AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
                regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), low AS (
            SELECT t, min(doc_id) AS first_id FROM d GROUP BY t
        ), m AS (
            SELECT doc_id, part,
                CASE WHEN len(w) < 200 THEN 1 ELSE 0 END
                + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
                + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 4 ELSE 0 END
                + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
                + CASE WHEN doc_id > first_id THEN 16 ELSE 0 END AS mask
            FROM d JOIN low USING (t)
        ), l AS (
            SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
            FROM labels GROUP BY doc_id
        ), cell AS (
            SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
            FROM m LEFT JOIN l USING (doc_id) GROUP BY part, mask
        ), f(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
        o AS (
            SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order,
                [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
            FROM f a, f b, f c, f d, f e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
                AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5
        ), s AS (
            SELECT filter_order, k AS step, bits[k] AS bit, CAST(coalesce(list_sum(bits[1 : k - 1]), 0) AS BIGINT) AS applied
            FROM o, unnest([1, 2, 3, 4, 5]) AS u(k)
        ), r AS (
            SELECT part, filter_order, step, bit,
                sum(CASE WHEN (mask & (applied | bit)) = 0 THEN n ELSE 0 END) AS kept,
                sum(CASE WHEN (mask & bit) <> 0 AND (mask & applied) = 0 THEN n ELSE 0 END) AS removed,
                sum(CASE WHEN (mask & bit) <> 0 AND (mask & applied) <> 0 THEN n ELSE 0 END) AS redundant,
                sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
                sum(CASE WHEN (mask & bit) <> 0 AND (mask & applied) = 0 THEN good ELSE 0 END) AS good_lost,
                sum(CASE WHEN (mask & bit) <> 0 AND (mask & applied) = 0 THEN toxic ELSE 0 END) AS toxic_lost
            FROM s, cell GROUP BY ALL
        )
        SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
            CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
            CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
            CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
        FROM r
    """,
    "op13_repeated_windows": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), win AS (
            SELECT r, doc_id, i, array_to_string(w[i : i + 12], ' ') AS k FROM d, unnest(range(1, len(w) - 11)) AS u(i)
        ), low AS (
            SELECT k, min(doc_id) AS first_id FROM win GROUP BY k HAVING min(doc_id) < max(doc_id) OR bool_or(doc_id IS NULL)
        ), gone AS (
            SELECT DISTINCT r, j FROM win JOIN low USING (k), unnest(range(i, i + 13)) AS u(j)
            WHERE first_id < doc_id OR (doc_id IS NULL AND first_id IS NOT NULL)
        ), places AS (
            SELECT r, count(*) AS n, list(j) AS js FROM gone GROUP BY r
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed,
            sha256(array_to_string(
                CASE WHEN n IS NULL THEN w ELSE list_filter(list_zip(w, range(1, len(w) + 1)), lambda x: NOT list_contains(js, x[2])).list_transform(lambda x: x[1]) END,
            ' ')) AS kept_sha256
        FROM d LEFT JOIN places USING (r)
    """,
}
