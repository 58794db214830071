"""Prompts for a model provider, built as string expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from caseweave import fixed
from caseweave.functions.decision import two_decimals
from caseweave.functions.text import fill, fill_text


def taxonomy_text(intents: dict[str, dict] = fixed.INTENTS) -> str:
    """Intent list with descriptions and examples; a constant of the job."""
    entries = []
    for intent, info in intents.items():
        examples = [
            fill_text(fixed.TAXONOMY_EXAMPLE, {"example": text}) for text in info["examples"]
        ]
        entries.append(
            fill_text(
                fixed.TAXONOMY_ENTRY,
                {
                    "intent": intent,
                    "description": info["description"],
                    "examples": "\n".join(examples),
                },
            )
        )
    return "".join(entries)


def classify_prompt(
    message: Column,
    intents: dict[str, dict] = fixed.INTENTS,
    account: str = fixed.PROMPT_ACCOUNT,
) -> Column:
    """Prompt that asks for the intent of one message."""
    return fill(
        fixed.CLASSIFY_PROMPT,
        {"account": account, "taxonomy": taxonomy_text(intents), "message": message},
    )


def classify_batch_prompt(
    messages: Column,
    intents: dict[str, dict] = fixed.INTENTS,
    account: str = fixed.PROMPT_ACCOUNT,
) -> Column:
    """Prompt that asks for the intents of an array of messages, numbered from 0."""
    lines = F.transform(
        messages,
        lambda message, i: fill(
            fixed.BATCH_LINE, {"index": i.cast("string"), "message": message}
        ),
    )
    return fill(
        fixed.CLASSIFY_BATCH_PROMPT,
        {
            "account": account,
            "taxonomy": taxonomy_text(intents),
            "count": F.size(messages).cast("string"),
            "messages": F.array_join(lines, "\n"),
        },
    )


def reply_prompt(
    message: Column, intent: Column, retrieved: Column, brand: str = fixed.DEFAULT_BRAND
) -> Column:
    """Prompt that asks for a reply in the style of the retrieved precedents."""
    examples = F.transform(
        retrieved,
        lambda case, i: fill(
            fixed.REPLY_EXAMPLE,
            {
                "number": (i + 1).cast("string"),
                "similarity": two_decimals(case["similarity"]),
                "customer": F.coalesce(case["past_customer_msg"], F.lit("")),
                "reply": F.coalesce(case["past_brand_reply"], F.lit("")),
            },
        ),
    )
    return fill(
        fixed.REPLY_PROMPT,
        {
            "brand": brand,
            "examples": F.array_join(examples, ""),
            "intent": intent,
            "message": message,
        },
    )


def rubric_prompt(message: Column, reply: Column) -> Column:
    """Prompt that asks for rubric scores of one drafted reply."""
    return fill(fixed.RUBRIC_PROMPT, {"message": message, "reply": reply})
