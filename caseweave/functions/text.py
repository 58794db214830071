"""Text expressions: Column in, Column out, all inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from caseweave import fixed

# White space other than the plain space.  The first half rejects ASCII and most European
# letters with one comparison, before the list of spaces is tried.
_ODD_SPACE = f"[[^ -~\\xa1-\\x{{167f}}]&&{fixed.SPACE_CLASS}]"


def strip(text: Column) -> Column:
    """Remove Unicode white space at both ends."""
    return F.btrim(text, F.lit(fixed.SPACE_CHARS))


def plain_spaces(text: Column) -> Column:
    """Every white-space character as a plain space."""
    return F.regexp_replace(text, _ODD_SPACE, " ")


def clean_text(text: Column) -> Column:
    """Drop @mentions, then links, then collapse white space."""
    no_mentions = F.when(
        F.contains(text, F.lit("@")), F.regexp_replace(text, fixed.MENTION_PATTERN, "")
    ).otherwise(text)
    no_links = F.regexp_replace(no_mentions, fixed.URL_PATTERN, "")
    # one replacement per odd space and per run of spaces, not one per word
    return F.trim(F.regexp_replace(plain_spaces(no_links), " {2,}", " "))


def word_count(text: Column) -> Column:
    """Number of white-space separated words; blank text has none."""
    return F.size(F.array_remove(F.split(plain_spaces(text), " "), ""))


def has_at_most_words(text: Column, limit: int) -> Column:
    """``word_count(text) <= limit`` without looking further than word ``limit + 1``.

    The pattern is anchored and its repeats are possessive, so long texts, and long texts
    without any white space, are read at most once.
    """
    word, gap = f"{fixed.NONSPACE_CLASS}++", f"{fixed.SPACE_CLASS}++"
    longer = f"^{fixed.SPACE_CLASS}*+(?:{word}{gap}){{{limit}}}{fixed.NONSPACE_CLASS}"
    return ~text.rlike(longer)


def is_short(text: Column, limit: int = fixed.SHORT_MESSAGE_WORDS) -> Column:
    return has_at_most_words(text, limit)


def long_enough(text: Column, longer_than: int = fixed.MIN_CLEAN_LENGTH) -> Column:
    return F.length(text) > longer_than


def contains_any(lowered: Column, keywords: list[str]) -> Column:
    """True if already lower-cased text contains one of the keywords."""
    hit = F.lit(False)
    for keyword in keywords:
        hit = hit | F.contains(lowered, F.lit(keyword))
    return hit


def as_boolean(value: Column) -> Column:
    """Boolean from its text form; anything but "true" (any case), also NULL, is false."""
    return F.coalesce(F.lower(value.cast("string")) == "true", F.lit(False))


def is_blank(value: Column) -> Column:
    """NULL or empty: no value was given."""
    return F.coalesce(value, F.lit("")) == ""


def strip_code_fence(text: Column) -> Column:
    """Remove a Markdown code fence that surrounds a model reply."""
    body = strip(text)
    for fence in ("^```json", "^```", "```\\z"):
        body = F.regexp_replace(body, fence, "")
    return strip(body)


def preview(text: Column, n: int = 60) -> Column:
    """First ``n`` characters and an ellipsis."""
    return F.concat(F.substring(text, 1, n), F.lit("..."))


def fill(template: str, values: dict[str, Column | str]) -> Column:
    """Column that fills the ``<<name>>`` marks of a template."""
    pieces: list[Column] = []
    literal = ""
    for i, part in enumerate(template.replace(">>", "<<").split("<<")):
        if i % 2 == 0:
            literal += part
        elif isinstance(values[part], str):
            literal += values[part]
        else:
            pieces += [F.lit(literal), values[part]]
            literal = ""
    return F.concat(*pieces, F.lit(literal))


def fill_text(template: str, values: dict[str, str]) -> str:
    """The same as :func:`fill` for plain strings."""
    for name, value in values.items():
        template = template.replace(f"<<{name}>>", value)
    return template
