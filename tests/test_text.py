import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from caseweave import fixed
from caseweave.functions import text as T

CASES = [
    "@Brand help me", "@हिन्दी मदद", "x @a² y", "a b", "a  b", "a\u0085b", "a\u001cb",
    "see http://t.co/abc", "xhttpfoo bar", "mail a@b.com now", "", "   ", "@", "a\r\n\tb  c",
    "café @josé http://é.fr/à fin", "　x　", "a­b", "¡hola!  ¿qué?",
]


def is_word(c):
    return c.isalnum() or c == "_"


def scan_clean(text):
    """The cleaning rules, character by character: mentions go, links go, spaces shrink to one."""
    kept, i = [], 0
    while i < len(text):  # a mention is an @ and the word characters after it
        if text[i] == "@" and i + 1 < len(text) and is_word(text[i + 1]):
            i += 1
            while i < len(text) and is_word(text[i]):
                i += 1
        else:
            kept.append(text[i])
            i += 1
    text, kept, i = "".join(kept), [], 0
    while i < len(text):  # a link is "http" and what follows it up to a space
        if text.startswith("http", i) and i + 4 < len(text) and not text[i + 4].isspace():
            i += 4
            while i < len(text) and not text[i].isspace():
                i += 1
        else:
            kept.append(text[i])
            i += 1
    return " ".join("".join(kept).split())


def evaluate(spark, texts, **columns):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", *[c.alias(n) for n, c in columns.items()]).orderBy("i").collect()
    return [tuple(r)[1:] for r in rows]


def test_clean_text_like_python(spark):
    got = evaluate(spark, [*CASES, None], c=T.clean_text(F.col("t")))
    # a superscript digit is a word character here and in Python's \w
    assert [g[0] for g in got] == [scan_clean(c) for c in CASES] + [None]


ALPHABET = "ab @_9.\t\n\u200b\u00e9\u00b2\u0301\u00f1ht" + fixed.SPACE_CHARS


@settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.text(ALPHABET, max_size=30), min_size=40, max_size=40))
def test_text_functions_like_python(spark, texts):
    texts = [t.replace("ht", "http") for t in texts]
    t = F.col("t")
    got = evaluate(
        spark, texts,
        clean=T.clean_text(t), words=T.word_count(t), short=T.has_at_most_words(t, 3),
        strip=T.strip(t),
    )
    want = [(scan_clean(x), len(x.split()), len(x.split()) <= 3, x.strip()) for x in texts]
    assert got == want


def test_spaces_of_the_whole_plane(spark):
    points = [c for c in range(1, 0x10000) if not 0xD800 <= c < 0xE000]
    df = spark.createDataFrame([(c, chr(c)) for c in points], "c int, t string")
    got = df.where((T.plain_spaces(F.col("t")) == " ") & (F.col("t") != " ")).select("c").collect()
    assert {r.c for r in got} == {c for c in points if chr(c).isspace() and c != 0x20}
    blank = df.where(T.strip(F.col("t")) == "").select("c").collect()
    assert {r.c for r in blank} == {c for c in points if chr(c).isspace()}


def test_short_message_boundary(spark):
    seven, eight = " a b c d e f g ", "a b c d e f g h"
    got = evaluate(spark, [seven, eight, "", None], s=T.is_short(F.col("t")))
    assert [g[0] for g in got] == [True, False, True, None]


def test_short_message_on_long_word(spark):
    df = spark.range(1).select(F.repeat(F.lit("x"), 2_000_000).alias("t"))
    assert df.select(T.is_short(F.col("t"))).first()[0] is True


def test_min_length_is_strict(spark):
    got = evaluate(spark, ["12345", "123456"], k=T.long_enough(F.col("t")))
    assert [g[0] for g in got] == [False, True]


@pytest.mark.parametrize(
    "raw, body",
    [
        ("```json\n{}\n```", "{}"), ("```{}```", "{}"), (" {} ", "{}"), ("```json```json x", "json x"),
        ("{}\n```\n", "{}"), ("a```b", "a```b"), ("", ""),
    ],
)
def test_code_fence(spark, raw, body):
    assert evaluate(spark, [raw], f=T.strip_code_fence(F.col("t"))) == [(body,)]


def test_booleans_blanks_previews(spark):
    got = evaluate(spark, ["True", "false", "", None, "TRUE "], b=T.as_boolean(F.col("t")))
    assert [g[0] for g in got] == [True, False, False, False, False]
    got = evaluate(spark, ["", None, "x"], b=T.is_blank(F.col("t")))
    assert [g[0] for g in got] == [True, True, False]
    assert evaluate(spark, ["x" * 70], p=T.preview(F.col("t"))) == [("x" * 60 + "...",)]


def test_space_list_is_pythons():
    assert set(fixed.SPACE_CHARS) == {chr(c) for c in range(0x3001) if chr(c).isspace()}
