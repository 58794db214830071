"""Learned decision lists of quality rules.

Sequential covering: while labelled rejects are left, a rule (a conjunction of thresholds on text
statistics) is grown on two thirds of the rows by information gain, pruned on the other third, and kept if
it is precise enough there; the rows it covers are set aside. The rules are applied in order as one Spark
conditional expression. Statistics are computed for every word of every text.

Fitting reads at most ``max_rows`` labels, chosen by a hash of their id, and one text for each; all else covers all
data.

Defined cases: a null or empty text has no words, fails the base rules and is not kept; labels that are null,
or of unknown documents, are ignored; without rejects among the labels no rule is learned and only the base
rules decide; repeated rows are judged one by one and repeated labels count as often as they occur; of rows that share
a doc_id the one with the smallest counts stands for the label when rules are learned.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from caseweave.llm.common import fresh, stored

MAX_ROWS = 20_000
MIN_PRECISION = 0.9
MAX_CONDITIONS = 4
THRESHOLDS = 48
STRAY = 0.02

_SPACES = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks", "n_digits", "n_same")

Condition = tuple[str, str, float]  # statistic, "<=" or ">", threshold


def count_text(text: str | None) -> tuple[int, ...]:
    """The counts of one text, in the order of ``COUNTS``."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split at ASCII white space only
    n = len(words)
    triples = list(zip(words, words[1:], words[2:], strict=False))
    repeated = 0
    if len(set(triples)) < len(triples):
        often = Counter(triples)
        until = 0  # words before this one are counted
        for i, t in enumerate(triples):
            if often[t] > 1:
                repeated += i + 3 - max(until, i)
                until = i + 3
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return (
        n,
        len(text) - sum(map(text.count, _SPACES)),
        sum(map(text.count, _SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated,
        len(lines),
        len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")),
        text.count("!") + text.count("?"),
        len(raw) - len(raw.translate(None, b"0123456789")),
        sum(a == b for a, b in zip(words, words[1:], strict=False)),
    )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [count_text(x.as_py()) for x in batch.column("text")]
        table = np.array(rows, np.int64).reshape(-1, len(COUNTS))
        yield pa.record_batch(
            {"key": batch.column("key")} | {c: table[:, i] for i, c in enumerate(COUNTS)}
        )


def text_counts(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``COUNTS`` of every text, beside its key."""
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col("text").cast("string").alias("text"))
    schema = f"key {kind}, " + ", ".join(f"{c} long" for c in COUNTS)
    return rows.mapInArrow(_count, schema).withColumnRenamed("key", key)


def statistics() -> dict[str, Column]:
    """What the rules look at, from ``COUNTS``."""
    share = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return {
        "mean_word": share("word_chars", "n_words"),
        "symbol_share": share("n_symbols", "word_chars"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "upper_share": share("n_upper", "word_chars"),
        "mark_share": share("n_marks", "word_chars"),
        "digit_share": share("n_digits", "word_chars"),
        "same_share": share("n_same", "n_words"),  # words equal to the one before
    }


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _covers(rule: list[Condition], x: dict[str, np.ndarray], n: int) -> np.ndarray:
    hit = np.ones(n, bool)
    for name, op, t in rule:
        hit &= x[name] <= t if op == "<=" else x[name] > t
    return hit


def _grow(x: dict[str, np.ndarray], y: np.ndarray) -> list[Condition]:
    """Add the condition of the highest information gain until no accepted row is covered."""
    rule: list[Condition] = []
    inside = np.ones(len(y), bool)
    while len(rule) < MAX_CONDITIONS:
        p, n = int((y & inside).sum()), int((~y & inside).sum())
        if not n or not p:
            break
        best, best_gain = None, 1e-9
        before = math.log2(p / (p + n))
        for name, column in x.items():
            points = np.unique(np.quantile(column[inside], np.linspace(0.01, 0.99, THRESHOLDS)))
            below = column[inside, None] <= points[None, :]
            p_low = (below & y[inside, None]).sum(0)
            n_low = below.sum(0) - p_low
            for op, ps, ns in (("<=", p_low, n_low), (">", p - p_low, n - n_low)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(ps > 0, ps * (np.log2(ps / (ps + ns)) - before), -1.0)
                i = int(gain.argmax())
                if gain[i] > best_gain:
                    best, best_gain = (name, op, float(points[i])), float(gain[i])
        if best is None:
            break
        rule.append(_widest(best, x[best[0]][inside], y[inside]))
        inside &= _covers(rule[-1:], x, len(y))
    return rule


def _widest(condition: Condition, column: np.ndarray, y: np.ndarray) -> Condition:
    """The threshold moved to the middle between the nearest accepted row and the bulk of the rejects.

    A rule then doesn't rest on one stray value: all but ``STRAY`` of its rejects lie beyond the gap.
    """
    name, op, t = condition
    if op == ">":
        beyond, short = column[y & (column > t)], column[~y & (column <= t)]
        if len(beyond) and len(short):
            t = max(t, (float(short.max()) + float(np.quantile(beyond, STRAY))) / 2)
    else:
        beyond, short = column[y & (column <= t)], column[~y & (column > t)]
        if len(beyond) and len(short):
            t = min(t, (float(short.min()) + float(np.quantile(beyond, 1 - STRAY))) / 2)
    return name, op, t


def learn(x: dict[str, np.ndarray], y: np.ndarray, order: np.ndarray, min_precision: float = MIN_PRECISION) -> list[list[Condition]]:
    """An ordered list of rules that cover rejects (``y`` true). ``order`` parts the rows, like a hash."""
    rules: list[list[Condition]] = []
    left = np.ones(len(y), bool)
    while (y & left).any():
        grow, prune = left & (order % 3 != 0), left & (order % 3 == 0)
        rule = _grow({k: v[grow] for k, v in x.items()}, y[grow])
        best, best_value = [], -2.0
        for size in range(1, len(rule) + 1):
            hit = _covers(rule[:size], x, len(y)) & prune
            p, n = int((y & hit).sum()), int((~y & hit).sum())
            value = (p - n) / max(1, p + n)
            if p and value > best_value:
                best, best_value = rule[:size], value
        hit = _covers(best, x, len(y)) & left if best else np.zeros(len(y), bool)
        p, n = int((y & hit).sum()), int((~y & hit).sum())
        if not best or (best_value + 1) / 2 < min_precision or p < min_precision * (p + n):
            break
        rules.append(best)
        left &= ~hit
    return rules


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, min_precision: float = MIN_PRECISION) -> list[list[Condition]]:
    """Learn rules from ``labels`` (doc_id, quality: 0 is a reject)."""
    known = labels.where("doc_id is not null and quality is not null").select("doc_id", F.col("quality").cast("int"))
    drawn = stored(known.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(max_rows), "labels")
    texts = docs.select("doc_id", "text").join(F.broadcast(drawn.select("doc_id").distinct()), "doc_id", "left_semi")
    counts = F.min(F.struct(*COUNTS)).alias("counts")  # one row a label, so that max_rows bounds what is collected
    rows = (
        text_counts(texts)
        .groupBy("doc_id")
        .agg(counts)
        .select("doc_id", "counts.*")
        .where(~base_failed())  # what is rejected anyway teaches nothing
        .join(F.broadcast(drawn), "doc_id")
        .select("quality", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(1 << 20)).alias("fold"), *(c.alias(k) for k, c in statistics().items()))
        .orderBy("fold", "quality", *statistics())
        .collect()
    )
    if not rows:
        return []
    x = {k: np.array([r[k] for r in rows], float) for k in statistics()}
    y = np.array([r["quality"] == 0 for r in rows])
    return learn(x, y, np.array([r["fold"] for r in rows]), min_precision)


def verdict(rules: list[list[Condition]]) -> Column:
    """The name of the first rule that covers a row, or null, as one conditional expression."""
    stats = statistics()
    out = F.when(F.lit(False), F.lit(""))
    for i, rule in enumerate(rules):
        parts = [stats[name] <= t if op == "<=" else stats[name] > t for name, op, t in rule]
        label = f"rule {i + 1}: " + " and ".join(f"{name} {op} {t:.4g}" for name, op, t in rule)
        out = out.when(reduce(lambda a, b: a & b, parts), F.lit(label))
    return out


def judge(docs: DataFrame, rules: list[list[Condition]], key: str = "doc_id") -> DataFrame:
    """One row per document: key, the counts, base_failed, rule (that rejects it, or null), kept."""
    return (
        text_counts(docs, key)
        .withColumns({"base_failed": base_failed(), "rule": verdict(rules)})
        .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the base rules and the learned rules keep, with all their columns."""
    rules = fit(docs, labels)
    names = fresh(docs, *COUNTS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = docs_columns.index("text")
        for batch in batches:
            table = np.array([count_text(x.as_py()) for x in batch.column(at)], np.int64).reshape(-1, len(COUNTS))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(table[:, i]) for i in range(len(COUNTS)))], names=[*docs_columns, *names]
            )

    docs_columns = docs.columns
    schema = StructType([*docs.schema.fields, *(StructField(n, LongType()) for n in names)])
    counted = docs.mapInArrow(count, schema)
    # the rules name the counts plainly; a struct keeps the documents' own columns apart from those names
    row = F.struct(*(F.col(f"`{c}`") for c in docs_columns)).alias("row")
    judged = counted.select(row, *(F.col(f"`{n}`").alias(c) for n, c in zip(names, COUNTS, strict=True)))
    return judged.where(~base_failed() & verdict(rules).isNull()).select("row.*")
