"""Corrections of labelled rows, found by a snippet of their text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import asdict, dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseweave import fixed
from caseweave.session import store_stage

PLAN_PATCHES = 200  # up to which patches are expressions of the plan
PATCHED_COLUMNS = [
    "true_intent", "escalate_or_auto", "good_reply_should_include", "escalate_reason",
]


@dataclass(frozen=True)
class Patch:
    """New values for the one row whose text contains ``snippet``; None keeps a value."""

    snippet: str
    true_intent: str | None = None
    escalate_or_auto: str | None = None
    good_reply_should_include: str | None = None
    escalate_reason: str | None = None


def _matches(patches: list[Patch], text: str) -> Column:
    """Numbers of the patches whose snippet a row contains."""
    hits = [
        F.when(F.contains(F.col(text), F.lit(patch.snippet)), F.lit(i))
        for i, patch in enumerate(patches)
    ]
    return F.array_compact(F.array(*hits))


def apply_patches(
    df: DataFrame, patches: list[Patch], text: str = "customer_msg_clean"
) -> tuple[DataFrame, DataFrame]:
    """Rows with the patches applied, and a report ``(patch, snippet, n_matches, applied)``.

    A patch applies only if exactly one row contains its snippet (literally).  If several patches
    apply to one row, the last one wins, column by column.

    Up to :data:`PLAN_PATCHES` patches need no join: matches are found by expressions in each row,
    and the patches that match once come back as a scalar.  A longer list gives the same rows another
    way: one pass finds all snippets in a text, and the few rows that match are joined with their
    patches.
    """
    if len(patches) > PLAN_PATCHES:
        return _apply_many(df, patches, text)
    counts = (
        df.select(F.explode(_matches(patches, text)).alias("patch"))
        .groupBy("patch")
        .agg(F.count(F.lit(1)).alias("n_matches"))
    )
    unique = counts.where(F.col("n_matches") == 1).agg(
        F.collect_list("patch").alias("unique")
    )  # at most one number per patch
    marked = df.withColumn("_apply", F.array_intersect(_matches(patches, text), unique.scalar()))

    def last_value(column: str) -> Column:
        value = F.when(F.lit(False), F.col(column))
        for i, patch in reversed(list(enumerate(patches))):
            new = getattr(patch, column)
            if new is not None:
                value = value.when(F.array_contains(F.col("_apply"), i), F.lit(new))
        return value.otherwise(F.col(column))

    patched = marked.withColumns({c: last_value(c) for c in PATCHED_COLUMNS})
    spark = df.sparkSession
    listed = spark.createDataFrame(
        [(i, p.snippet) for i, p in enumerate(patches)], "patch int, snippet string"
    )
    n_matches = F.coalesce(F.col("n_matches"), F.lit(0).cast("bigint"))
    report = listed.join(counts, "patch", "left").select(
        "patch", "snippet", n_matches.alias("n_matches"), (n_matches == 1).alias("applied")
    )
    return patched.select(*df.columns), report


def _find_snippets(patches: list[Patch]):
    """Numbers of the patches whose snippet a text contains, by one pass over the text."""
    numbers: dict[str, list[int]] = {}
    for i, patch in enumerate(patches):
        numbers.setdefault(patch.snippet, []).append(i)

    @F.arrow_udf("array<int>")
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for snippet, own in numbers.items():
            if snippet:
                automaton.add_word(snippet, own)
        automaton.make_automaton()
        anywhere = numbers.get("", [])  # an empty snippet is in every text
        for batch in batches:
            found = []
            for value in batch.to_pylist():
                if value is None:
                    found.append([])
                    continue
                hits = {i for _, own in automaton.iter(value) for i in own} if len(automaton) else set()
                found.append(sorted(hits.union(anywhere)))
            yield pa.array(found, pa.list_(pa.int32()))

    return find.asNondeterministic()


def _apply_many(df: DataFrame, patches: list[Patch], text: str) -> tuple[DataFrame, DataFrame]:
    """``apply_patches`` for a long list of patches."""
    spark = df.sparkSession
    rows = store_stage(df.withColumn("_row", F.monotonically_increasing_id()), "rows")
    hits = store_stage(
        rows.select("_row", F.explode(_find_snippets(patches)(F.col(text))).alias("patch")), "hits"
    )
    counts = hits.groupBy("patch").agg(F.count(F.lit(1)).alias("n_matches"))
    fields = ["snippet", *PATCHED_COLUMNS]
    listed = spark.createDataFrame(
        [(i, *(getattr(p, f) for f in fields)) for i, p in enumerate(patches)],
        "patch int, " + ", ".join(f"{f} string" for f in fields),
    )
    single = hits.join(counts.where("n_matches = 1"), "patch").join(listed, "patch")
    new = single.groupBy("_row").agg(
        *(F.max_by(c, F.when(F.col(c).isNotNull(), F.col("patch"))).alias(f"_{c}") for c in PATCHED_COLUMNS)
    )
    patched = rows.join(new, "_row", "left").withColumns(
        {c: F.coalesce(F.col(f"_{c}"), F.col(c)) for c in PATCHED_COLUMNS}
    )
    n_matches = F.coalesce(F.col("n_matches"), F.lit(0).cast("bigint"))
    report = listed.join(counts, "patch", "left").select(
        "patch", "snippet", n_matches.alias("n_matches"), (n_matches == 1).alias("applied")
    )
    return patched.select(*df.columns), report


def is_flagged(reason: Column, flag: str = fixed.REVIEW_FLAG) -> Column:
    """True if a row is marked for review; NULL is not marked."""
    return F.coalesce(F.contains(reason, F.lit(flag)), F.lit(False))


def review_queue(df: DataFrame, reason: str = "escalate_reason") -> DataFrame:
    return df.where(is_flagged(F.col(reason)))


def patch_residual(
    df: DataFrame, patch: Patch, text: str = "customer_msg_clean", reason: str = "escalate_reason"
) -> DataFrame:
    """Patch the only row left in the review queue, if its text contains the snippet."""
    left = review_queue(df, reason).agg(F.count(F.lit(1)).alias("n")).scalar()
    applies = (
        is_flagged(F.col(reason))
        & (left == 1)
        & F.coalesce(F.contains(F.col(text), F.lit(patch.snippet)), F.lit(False))
    )
    new = {c: v for c, v in asdict(patch).items() if c != "snippet" and v is not None}
    marked = df.withColumn("_applies", applies)
    return marked.withColumns(
        {c: F.when(F.col("_applies"), F.lit(v)).otherwise(F.col(c)) for c, v in new.items()}
    ).drop("_applies")
