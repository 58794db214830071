"""Parsing and validation of model replies.

Model output is untrusted text.  A reply counts only if the whole of it is one JSON value of
the expected kind; everything else becomes the documented default and never fails the job.
Spark's JSON reader stops after the first value, so a reply is read once inside ``[...]`` and
once inside ``{"r":...}``: text after the value breaks at least one of the two.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from caseweave import fixed, schemas
from caseweave.functions.text import strip, strip_code_fence

_STRICT = {"allowSingleQuotes": "false"}


def _in_array(body: Column) -> Column:
    return F.concat(F.lit("["), body, F.lit("]"))


def _whole_json(body: Column) -> Column:
    """True if the text is exactly one JSON value."""
    as_member = F.try_parse_json(F.concat(F.lit('{"r":'), body, F.lit("}")))
    as_element = F.from_json(_in_array(body), "array<variant>", _STRICT)
    return as_member.isNotNull() & F.coalesce(F.size(as_element) == 1, F.lit(False))


def _known(intent: Column, intents: list[str]) -> Column:
    return F.coalesce(intent.isin(intents), F.lit(False))


def _label(intent: Column, confidence: Column) -> Column:
    return F.struct(intent.alias("intent"), confidence.alias("confidence"))


def _fallback_label() -> Column:
    return _label(F.lit(fixed.AMBIGUOUS), F.lit("low"))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def parse_label(raw: Column, intents: list[str] = list(fixed.INTENTS)) -> Column:
    """``struct<intent, confidence>`` from one reply; the fallback label if it is not usable.

    A missing confidence becomes ``low``.
    """

    def parse(body: Column) -> Column:
        replies = F.from_json(_in_array(body), f"array<{schemas.LABEL_REPLY}>", _STRICT)
        return F.when(_whole_json(body), F.get(replies, F.lit(0)))

    def label(reply: Column) -> Column:
        confidence = F.coalesce(reply["confidence"], F.lit("low"))
        return F.when(_known(reply["intent"], intents), _label(reply["intent"], confidence))

    parsed = _let(_let(strip_code_fence(raw), parse), label)
    return F.coalesce(parsed, _fallback_label())


def parse_label_batch(
    raw: Column, n_messages: Column, intents: list[str] = list(fixed.INTENTS)
) -> Column:
    """Array of ``n_messages`` labels in message order from one reply for a batch.

    The whole batch falls back if the reply is not a JSON array of that length whose members
    all carry an index.  An unknown intent makes only its own message fall back.
    """

    def parse(body: Column) -> Column:
        replies = F.from_json(_in_array(body), f"array<{schemas.BATCH_REPLY}>", _STRICT)
        return F.when(_whole_json(body), F.get(replies, F.lit(0)))

    def place(item: Column, i: Column) -> Column:
        return F.struct(
            item["index"].alias("index"),
            i.alias("position"),
            item["intent"].alias("intent"),
            item["confidence"].alias("confidence"),
        )

    def label(item: Column) -> Column:
        confidence = F.coalesce(item["confidence"], F.lit("low"))
        known = _known(item["intent"], intents)
        return F.when(known, _label(item["intent"], confidence)).otherwise(_fallback_label())

    def labels(items: Column) -> Column:
        complete = F.forall(items, lambda item: item["index"].isNotNull())
        ordered = F.array_sort(F.transform(items, place))
        return F.when((F.size(items) == n_messages) & complete, F.transform(ordered, label))

    parsed = _let(_let(strip_code_fence(raw), parse), labels)
    return F.coalesce(parsed, F.array_repeat(_fallback_label(), n_messages))


def _score(reply: Column, dimension: str) -> Column:
    """Integer from a JSON integer, a JSON number (cut) or a string that is an integer."""
    path = f"$.{dimension}"

    def read(value: Column) -> Column:
        kind = F.schema_of_variant(value)
        digits = strip(F.try_variant_get(value, "$", "string"))
        from_string = F.when(digits.rlike(r"^[+-]?[0-9]+\z"), digits.try_cast("int"))
        from_number = F.try_variant_get(value, "$", "double").try_cast("int")
        from_flag = F.try_variant_get(value, "$", "boolean").try_cast("int")
        return (
            F.when(kind == "STRING", from_string)
            .when(kind == "BOOLEAN", from_flag)
            .when(kind != "VOID", from_number)
        )

    return _let(F.try_variant_get(reply, path, "variant"), read)


def parse_rubric(raw: Column) -> Column:
    """``struct<helpfulness, tone_match, grounding, justification>`` from one reply.

    Unless all three scores can be read, the row gets the neutral default.
    """

    def parse(body: Column) -> Column:
        return F.when(_whole_json(body), F.try_parse_json(body))

    def read(reply: Column) -> Column:
        return F.struct(
            *[_score(reply, d).alias(d) for d in fixed.RUBRIC_DIMENSIONS],
            F.try_variant_get(reply, "$.justification", "string").alias("justification"),
        )

    def checked(scores: Column) -> Column:
        usable = F.lit(True)
        for dimension in fixed.RUBRIC_DIMENSIONS:
            usable = usable & scores[dimension].isNotNull()
        return F.when(usable, scores)

    neutral = F.struct(
        *[F.lit(fixed.NEUTRAL_SCORE).alias(d) for d in fixed.RUBRIC_DIMENSIONS],
        F.lit(fixed.NEUTRAL_JUSTIFICATION).alias("justification"),
    )
    scores = _let(_let(strip_code_fence(raw), parse), read)
    return F.coalesce(_let(scores, checked), neutral)


def rubric_out_of_range(scores: Column) -> Column:
    """True if a score lies outside 1..5; such scores are kept, this marks them."""
    outside = F.lit(False)
    for dimension in fixed.RUBRIC_DIMENSIONS:
        outside = outside | ~scores[dimension].isin(fixed.RUBRIC_SCORES)
    return outside
