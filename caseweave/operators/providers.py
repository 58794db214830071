"""Model providers.

A provider takes a DataFrame with a ``prompt`` column and returns it with ``raw_response``, the
model's reply as text.  The replies are parsed and validated elsewhere, whoever wrote them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseweave import fixed
from caseweave.functions.keywords import LOWERED, keyword_intent, with_lowered
from caseweave.functions.text import strip
from caseweave.operators.embedding import embed
from caseweave.operators.retrieval import broadcast_index, neighbours

Provider = Callable[[DataFrame], DataFrame]


def _label_json(intent: Column) -> Column:
    confidence = F.when(intent == fixed.AMBIGUOUS, "low").otherwise("high")
    return F.to_json(F.struct(intent.alias("intent"), confidence.alias("confidence")))


def rule_provider(text: str, rules: dict[str, list[str]] = fixed.KEYWORD_RULES) -> Provider:
    """Answers with the keyword rules: high confidence on a hit, low otherwise."""

    def provide(df: DataFrame) -> DataFrame:
        intent = keyword_intent(F.col(text), F.col(LOWERED), rules)
        labelled = with_lowered(df, text).withColumn("_intent", intent)
        return labelled.withColumn("raw_response", _label_json(F.col("_intent"))).drop(
            "_intent", LOWERED
        )

    return provide


def rule_batch_provider(
    items: str = "items", rules: dict[str, list[str]] = fixed.KEYWORD_RULES
) -> Provider:
    """The same for batches: ``items`` is an array of structs with a ``message`` field."""

    def provide(df: DataFrame) -> DataFrame:
        def lowered(item: Column) -> Column:
            text = item["message"]
            return F.struct(text.alias("message"), F.lower(text).alias("lowered"))

        def answer(item: Column, i: Column) -> Column:
            intent = keyword_intent(item["message"], item["lowered"], rules)
            confidence = F.when(intent == fixed.AMBIGUOUS, "low").otherwise("high")
            return F.struct(
                i.alias("index"), intent.alias("intent"), confidence.alias("confidence")
            )

        answers = F.transform(F.transform(F.col(items), lowered), answer)
        return df.withColumn("raw_response", F.to_json(answers))

    return provide


def nearest_example_provider(
    text: str, embedder, intents: dict[str, dict] = fixed.INTENTS, min_similarity: float = 0.45
) -> Provider:
    """Answers with the intent whose example in the taxonomy is most similar."""

    def provide(df: DataFrame) -> DataFrame:
        rows = [
            (i, intent, example)
            for i, (intent, example) in enumerate(
                (intent, example)
                for intent, info in intents.items()
                for example in info["examples"]
            )
        ]
        examples = df.sparkSession.createDataFrame(
            rows, "example_id bigint, intent string, example string"
        )
        index = broadcast_index(
            embed(examples, "example", embedder), "example_id", payload={"intent": "intent"}
        )
        found = neighbours(index, F.col("_vector"), F.lit(-1), k=1)
        nearest = F.get(F.col("_found"), F.lit(0))
        intent = F.coalesce(nearest["intent"], F.lit(fixed.AMBIGUOUS))
        confidence = F.when(nearest["similarity"] >= min_similarity, "high").otherwise("low")
        return (
            embed(df, text, embedder, "_vector")
            .withColumn("_found", found)
            .withColumn(
                "raw_response",
                F.to_json(F.struct(intent.alias("intent"), confidence.alias("confidence"))),
            )
            .drop("_vector", "_found")
        )

    return provide


def extractive_provider(retrieved: str = "retrieved") -> Provider:
    """Answers a reply prompt with the reply of the most similar precedent."""

    def provide(df: DataFrame) -> DataFrame:
        reply = F.get(F.col(retrieved), F.lit(0))["past_brand_reply"]
        return df.withColumn("raw_response", strip(F.coalesce(reply, F.lit(""))))

    return provide


def function_provider(
    load_model: Callable[[], Callable[[list[str]], list[str]]], batch_size: int = 64
) -> Provider:
    """Provider from a user's own model.

    ``load_model`` is called once per task and returns a function from a list of prompts to their
    replies.  Only prompts are sent to Python.  Spark may repeat a lost task, so the model may be
    asked the same prompt again.
    """

    @F.arrow_udf("string")
    def replies(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = load_model()
        for batch in batches:
            prompts = batch.to_pylist()
            answers: list = []
            for start in range(0, len(prompts), batch_size):
                answers += list(model(prompts[start : start + batch_size]))
            yield pa.array(answers, pa.string())

    def provide(df: DataFrame) -> DataFrame:
        return df.withColumn("raw_response", replies.asNondeterministic()(F.col("prompt")))

    return provide
