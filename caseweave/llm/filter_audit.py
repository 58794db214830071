"""What each quality filter removes, alone and in every order, by recursive enumeration of filter prefixes.

Every document gets a mask with one bit per filter that it fails. Documents with equal masks behave alike in every
order, so all that the audit needs is a table of *cells*: for each part of the corpus and each mask the number of
documents, of good and of toxic ones. A recursive query then starts from the empty prefix, extends each prefix by
the filters that it doesn't have yet, joins the cells of its part and carries the bits that are applied so far; each level
of the recursion gives the metrics of that step. An order of all filters is read off its prefixes, so 5 filters take 325
prefixes and not 600 steps.

The texts are read once, by DataFrame functions alone. What is shuffled is a digest, an id and a mask per
document; equal texts are counted before they meet, so a text that a third of the rows share is no hot key.

Defined cases: a null text is empty; a null part is the empty string; an empty table gives no rows. The duplicate
filter fails a document if a smaller doc_id has the same text, so rows that share the smallest doc_id all pass, and a
null doc_id neither fails it nor makes others fail. Rows that repeat count one by one. Labels that repeat count a
document once, as good (or toxic) if any of its labels says so; null labels say nothing; a null doc_id has no label.
"""

from __future__ import annotations

import math
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseweave.llm.common import stored

SPACES = r"[\x20\x09-\x0D]+"
_COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def failures(text: Column, words: Column) -> dict[str, Column]:
    """The production filters: letter -> whether a text, taken apart into words, fails."""
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > 3 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def _cells(docs: DataFrame, labels: DataFrame, filters, duplicates: str | None, part: str) -> tuple[DataFrame, list[str]]:
    """(part, cells: mask, n, good, toxic) and the letters in the order of their bits."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    rows = rows.withColumn("words", F.array_remove(F.split("text", SPACES, -1), ""))
    failing = filters(F.col("text"), F.col("words"))
    letters = [*failing, *([duplicates] if duplicates else [])]
    mask = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(failing.values())), F.lit(0))
    signed = rows.select("id", "part", mask.cast("int").alias("mask"), F.unhex(F.sha2("text", 256)).alias("h"))

    is_one = lambda c: F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(c)
    flags = labels.where("doc_id is not null and (quality = 1 or toxic = 1)").groupBy(F.col("doc_id").alias("id"))
    flagged = signed.join(flags.agg(is_one("quality"), is_one("toxic")), "id", "left").na.fill(False, ["quality", "toxic"])

    kind = ["h", "part", "mask", "quality", "toxic"]
    per_id = flagged.groupBy(*kind, "id").agg(F.count(F.lit(1)).alias("n"))
    per_text = per_id.groupBy(*kind).agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("n_null"),
        F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("first"),
    )
    if duplicates:
        # a text has one row per part, mask and labels here
        per_text = per_text.withColumn("low", F.min("first.id").over(Window.partitionBy("h")))
        passes = F.when(F.col("first.id") == F.col("low"), F.col("first.n")).otherwise(0) + F.col("n_null")
        bit = 1 << len(failing)
        split = F.array(
            F.struct(F.col("mask"), passes.alias("n")), F.struct((F.col("mask") + bit).alias("mask"), (F.col("n") - passes).alias("n"))
        )
    else:
        split = F.array(F.struct("mask", "n"))
    counted = (
        per_text.select("part", "quality", "toxic", F.explode(split).alias("s"))
        .where("s.n > 0")
        .groupBy("part", F.col("s.mask").alias("mask"))
        .agg(
            F.sum("s.n").alias("n"),
            F.sum(F.when(F.col("quality"), F.col("s.n")).otherwise(0)).alias("good"),
            F.sum(F.when(F.col("toxic"), F.col("s.n")).otherwise(0)).alias("toxic"),
        )
    )
    return counted.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells")), letters


@contextmanager
def _unbounded_recursion(spark: SparkSession):
    """The number of rows follows the number of parts; the recursion ends by itself when no filter is left."""
    name = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def prefixes(cells: DataFrame, letters: list[str]) -> DataFrame:
    """One row per part and non-empty prefix: part, prefix, step, and the metrics of the prefix's last filter."""
    spark, view = cells.sparkSession, f"audit_cells_{uuid.uuid4().hex}"
    choices = ", ".join(f"named_struct('letter', '{x}', 'bit', {1 << i})" for i, x in enumerate(letters))
    count = lambda what, where: f"aggregate(filter(c.cells, m -> {where}), 0L, (s, m) -> s + m.{what})"
    # a cell is there before the step if it fails none of the applied filters, and goes if it fails the new one
    goes = "(m.mask & l.bit) <> 0 AND (m.mask & p.applied) = 0"
    metrics = (
        count("n", "(m.mask & (p.applied | l.bit)) = 0"),
        count("n", goes),
        count("n", "(m.mask & l.bit) <> 0 AND (m.mask & p.applied) <> 0"),
        count("n", "m.mask = l.bit"),
        count("good", goes),
        count("toxic", goes),
    )
    cells.createOrReplaceTempView(view)
    try:
        levels = spark.sql(
            f"""
            WITH RECURSIVE levels(part, prefix, step, applied, {", ".join(_COUNTS)}) AS (
                SELECT part, '', 0, 0, {", ".join(["0L"] * len(_COUNTS))} FROM {view}
                UNION ALL
                SELECT p.part, concat(p.prefix, l.letter), p.step + 1, p.applied | l.bit, {", ".join(metrics)}
                FROM levels p JOIN {view} c ON c.part = p.part
                LATERAL VIEW explode(filter(array({choices}), x -> (p.applied & x.bit) = 0)) unused AS l
            )
            SELECT part, prefix, step, {", ".join(_COUNTS)} FROM levels WHERE step > 0
            """
        )
        with _unbounded_recursion(spark):
            return stored(levels, "prefixes")
    finally:
        spark.catalog.dropTempView(view)


def audit(docs: DataFrame, labels: DataFrame, filters=failures, duplicates: str | None = "E", part: str = "lang") -> DataFrame:
    """One row per part, order of all filters and step, with the metrics of that step.

    ``filters(text, words)`` gives the failure conditions by letter; ``duplicates`` names the filter for texts that a
    smaller doc_id has, or is None. Columns: part, filter_order, step, kept, removed, redundant (fails this filter, gone
    before), unique_fails (fails this filter only), good_lost, toxic_lost, shapley (removed by this filter, summed over
    all orders).
    """
    cells, letters = _cells(docs, labels, filters, duplicates, part)
    n = len(letters)
    levels = prefixes(stored(cells, "cells"), letters)
    orders = levels.where(F.col("step") == n).select("part", F.col("prefix").alias("filter_order"))
    steps = orders.select("*", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step")).withColumn(
        "prefix", F.col("filter_order").substr(F.lit(1), F.col("step"))
    )
    completions = F.element_at(F.array(*(F.lit(math.factorial(n - s)) for s in range(1, n + 1))), F.col("step"))
    letter = F.right("prefix", F.lit(1)).alias("letter")
    shapley = levels.groupBy("part", letter).agg(F.sum(F.col("removed") * completions).alias("shapley"))
    return (
        steps.join(levels.select("part", "prefix", *_COUNTS), ["part", "prefix"])
        .withColumn("letter", letter)
        .join(shapley, ["part", "letter"])
        .select("part", "filter_order", "step", *_COUNTS, "shapley")
    )
