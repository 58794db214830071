"""Personal data by weak supervision, in DataFrame operations only.

Candidate spans come from strict patterns (email, ip, card, phone) and from wider ones: spelled-out addresses,
card-like numbers that fail the checksum, phone-like numbers without a country code. Labelers vote on each
candidate: the strict pattern or checksum, a gazetteer, context words before the span, and its shape; a labeler may
abstain. Expectation-maximisation over the counts of vote patterns, taken over all candidates of the corpus,
estimates how reliable each labeler is for each kind. The resulting probabilities then train a naive Bayes
classifier on surface features of the spans. Spans of the strict patterns always stay; a wider candidate is added
if the classifier gives it at least ``MIN_PROBABILITY``.

What leaves the executors is a table of counts with a fixed number of possible rows.

Defined cases: a null text is empty and has no spans; numbers in very long runs of digits are one candidate, as the
patterns say; repeated rows are judged one by one; with no candidates at all nothing is learned and none is added;
the time for a text grows as its length and, but for a logarithm, as its matches.
"""

from __future__ import annotations

import math
from collections import defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseweave.llm.common import fresh

KINDS = ("email", "ip", "card", "phone")
MIN_PROBABILITY = 0.9
LABELERS = 4
EM_STEPS = 100
#: (kind, labeler) -> how often its vote for a true span is right, where that is known: a card number always
#: passes the checksum.
KNOWN_HITS = {(2, 0): 0.999}

#: The patterns with possessive repeats, and an anchor that skips starts inside a run: same matches, linear time.
_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_NUMBER = r"[0-9](?:[\x20-]?[0-9])++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_SPELLED = (
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?:\x20at\x20|\x20?\[at\]\x20?|\x20?\(at\)\x20?)[A-Za-z0-9-]{1,63}+"
    r"(?:(?:\x20dot\x20|\x20?\[dot\]\x20?|\x20?\(dot\)\x20?)[A-Za-z0-9-]{1,63}+){1,4}+"
)
_LOCAL = r"(?<![0-9+().-])(?<![0-9+().-]\x20)\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9.-])"

_DOMAINS = "com|org|net|edu|gov|mil|int|info|biz|io|co|de|fr|es|it|uk|eu|ch|at|nl|be|pl|ru|jp|cn|in|br|mx|ca|us|au"
_CONTEXT = (
    r"(?i)\b(?:e-?mail|mail|contact|write|reach)\b",
    r"(?i)\b(?:ip|host|server|address|addr|from|client)\b",
    r"(?i)\b(?:card|visa|mastercard|amex|credit|debit|cc|payment)\b",
    r"(?i)\b(?:tel|phone|call|fax|mobile|cell|dial|telefon|tel[eé]fono|t[eé]l[eé]phone)\b",
)
_AGAINST = r"(?i)\b(?:version|release|build|section|order|invoice|token|isbn|serial|id|hash|no)\b[\x20:.#=\"]*$"
_BEFORE = 40
#: Code points of the chunks that a text is taken apart into when spans in it are replaced.
CHUNK = 1024


def _let(value: Column, use) -> Column:
    """``use(value)``, with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _running(numbers: Column, join) -> Column:
    """Running sums or maxima of an array, by doubling: a round per power of two below its size, each linear."""
    rounds = F.ceil(F.log2(F.greatest(F.size(numbers), F.lit(1)))).cast("int")
    powers = F.transform(F.array_repeat(F.lit(1), rounds), lambda one, k: F.call_function("shiftleft", one, k))
    step = lambda done, far: F.transform(done, lambda x, i: join(x, F.get(done, i - far)))
    return F.aggregate(powers, numbers, step)


def _found(text: Column, pattern: str, kind: int, strict: bool, valid) -> Column:
    """The valid matches of a pattern as spans, with the text just before each."""
    zipped = F.arrays_zip(
        F.split(text, pattern, -1).alias("piece"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("value")
    )

    def spans(pieces):
        sizes = F.transform(pieces, lambda x: F.length(x["piece"]) + F.coalesce(F.length(x["value"]), F.lit(0)))
        return _let(_running(sizes, lambda a, b: a + F.coalesce(b, F.lit(0))), lambda ends: F.transform(pieces, span(ends)))

    def span(ends):
        return lambda x, i: F.struct(
            F.lit(kind).alias("kind"),
            (F.get(ends, i) - F.length(x["value"])).alias("first"),
            F.get(ends, i).alias("last"),
            (valid(x["value"]) if strict is None else F.lit(strict)).alias("strict"),
            x["value"].alias("value"),
            F.right(x["piece"], F.lit(_BEFORE)).alias("before"),
        )

    def keep(x):
        return x["value"].isNotNull() & (_plausible(x["value"]) if strict is None else valid(x["value"]))

    return F.filter(_let(zipped, spans), keep)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _plausible(value: Column) -> Column:
    """13 to 19 digits."""
    return F.length(_digits(value)).between(13, 19)


def _valid_card(value: Column) -> Column:
    return _plausible(value) & F.call_function("luhn_check", _digits(value))


def _valid_ip(value: Column) -> Column:
    small = lambda part: F.coalesce(F.regexp_replace(part, "^0+(?=[0-9])", "").try_cast("int") <= 255, F.lit(False))
    return F.forall(F.split(value, r"\."), small)


def candidates(text: Column) -> Column:
    """All candidate spans of a text, strict and wide, by kind and place."""
    text = F.coalesce(text, F.lit(""))
    empty = F.expr("cast(array() as array<struct<kind: int, first: int, last: int, strict: boolean, value: string, before: string>>)")
    number_of = lambda c, lo, hi: F.length(_digits(c)).between(lo, hi)
    spelled = text.contains(" dot ") | text.contains("[dot]") | text.contains("(dot)")
    parts = [
        F.when(text.contains("@"), _found(text, _EMAIL, 0, True, lambda v: F.lit(True))),
        F.when(spelled, _found(text, _SPELLED, 0, False, lambda v: F.lit(True))),
        F.when(text.contains("."), _found(text, _IP, 1, True, _valid_ip)),
        _found(text, _NUMBER, 2, None, _valid_card),
        F.when(text.contains("+"), _found(text, _PHONE, 3, True, lambda v: number_of(v, 9, 15))),
        F.when(text.rlike("[0-9]{3}[.-][0-9]{4}"), _found(text, _LOCAL, 3, False, lambda v: F.lit(True))),
    ]
    return F.when(text.rlike("[@0-9]") | spelled, F.concat(*(F.coalesce(p, empty) for p in parts))).otherwise(empty)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _votes(span: Column) -> Column:
    """Four votes (1, -1, or 0 to abstain): strict pattern, gazetteer, context, shape."""
    value, before, kind, strict = span["value"], span["before"], span["kind"], span["strict"]
    never = F.lit(False)
    number = _digits(value)
    context = reduce(lambda a, k: a.when(kind == k, before.rlike(_CONTEXT[k])), range(4), F.when(never, never))
    by_kind = lambda *c: F.when(kind == 0, c[0]).when(kind == 1, c[1]).when(kind == 2, c[2]).otherwise(c[3])
    return F.array(
        by_kind(_vote(strict, never), _vote(strict, never), _vote(strict, ~strict), _vote(strict, never)),
        by_kind(
            _vote(value.rlike(rf"(?i)(?:\.|dot\x20|dot[\])]\x20?)(?:{_DOMAINS})$"), F.lit(True)),
            _vote(~value.rlike(r"^(?:0|127|255|22[4-9]|2[3-5][0-9])\."), F.lit(True)),
            _vote(number.rlike(r"^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5))"), never),
            _vote(number.rlike(r"^1?[2-9][0-9]{2}"), never),
        ),
        _vote(context, before.rlike(_AGAINST)),
        by_kind(
            _vote(F.length(value) <= 100, F.lit(True)),
            _vote(~value.rlike(r"(?:^|\.)0[0-9]"), F.lit(True)),
            _vote(F.length(number).isin(15, 16), never),
            _vote(value.rlike(r"[\x20().-]"), never),
        ),
    )


def _features(span: Column) -> Column:
    """Surface features as small numbers, other than the votes."""
    value, before = span["value"], span["before"]
    last = F.right(before, F.lit(1))
    return F.array(
        F.least(F.floor(F.length(value) / 5), F.lit(5)).cast("int"),
        F.least(F.size(F.split(value, r"[\x20().@-]", -1)) - 1, F.lit(4)).cast("int"),
        F.when(last == "", 0).when(last.rlike(r"[\s]"), 1).when(last.rlike(r"[A-Za-z0-9]"), 2).otherwise(3),
        F.when(before.rlike(r"[:=]\s*[\"']?$"), 1).otherwise(0),
    )


def _expectation(counts: dict[tuple[int, ...], float], known: dict[int, float] | None = None) -> dict[tuple[int, ...], float]:
    """Vote pattern -> probability of personal data; labelers' rates by EM, but for ``known`` hit rates."""
    prior = 0.7
    right = [[(known or {}).get(j, 0.8), 0.8] for j in range(LABELERS)]  # P(vote 1 | true), P(vote -1 | false), given a vote
    probability: dict[tuple[int, ...], float] = {}
    for _ in range(EM_STEPS):
        for votes in counts:
            yes, no = math.log(prior), math.log(1 - prior)
            for v, (hit, miss) in zip(votes, right, strict=True):
                if v:
                    yes += math.log(hit if v > 0 else 1 - hit)
                    no += math.log(1 - miss if v > 0 else miss)
            probability[votes] = 1 / (1 + math.exp(min(700, no - yes)))
        total = sum(counts.values())
        prior = (sum(n * probability[v] for v, n in counts.items()) + 1) / (total + 2)
        for j in range(LABELERS):
            pos = sum(n * probability[v] for v, n in counts.items() if v[j])
            neg = sum(n * (1 - probability[v]) for v, n in counts.items() if v[j])
            hit = sum(n * probability[v] for v, n in counts.items() if v[j] > 0)
            miss = sum(n * (1 - probability[v]) for v, n in counts.items() if v[j] < 0)
            # a few counts of an able labeler keep rates inside (0, 1) and the classes from changing places
            right[j] = [(known or {}).get(j, (hit + 8) / (pos + 10)), (miss + 8) / (neg + 10)]
    return probability


def _classifier(rows: list[tuple[int, tuple[int, ...], tuple[int, ...], int]]) -> dict[str, float]:
    """Log odds of a naive Bayes classifier: ``kind`` -> prior, ``kind:feature:value`` -> evidence."""
    odds: dict[str, float] = {}
    for kind in range(len(KINDS)):
        own = [(v, f, n) for k, v, f, n in rows if k == kind]
        if not own:
            continue
        counts: dict[tuple[int, ...], float] = defaultdict(float)
        for v, _, n in own:
            counts[v] += n
        probability = _expectation(counts, {j: p for (k, j), p in KNOWN_HITS.items() if k == kind})
        pos = sum(n * probability[v] for v, _, n in own)
        neg = sum(n * (1 - probability[v]) for v, _, n in own)
        odds[f"{kind}"] = math.log((pos + 1) / (neg + 1))
        evidence: dict[str, list[float]] = defaultdict(lambda: [1.0, 1.0])
        for v, f, n in own:
            for name, value in [*((f"v{j}", x) for j, x in enumerate(v)), *((f"f{j}", x) for j, x in enumerate(f))]:
                cell = evidence[f"{kind}:{name}:{value}"]
                cell[0] += n * probability[v]
                cell[1] += n * (1 - probability[v])
        for name, (p, q) in evidence.items():
            odds[name] = math.log(p / (pos + 8)) - math.log(q / (neg + 8))
    return odds


def _add_candidates(docs: DataFrame, spans: str) -> DataFrame:
    """``docs`` with candidate spans, their votes and features.

    Read twice, once to learn and once to decide; finding candidates again costs less than keeping
    a copy of the texts.
    """
    (holder,) = fresh(docs, "found")
    found = docs.withColumn(holder, candidates(F.col("text").cast("string")))
    voted = F.transform(
        holder,
        lambda s: F.struct(
            s["kind"].alias("kind"), s["first"].alias("first"), s["last"].alias("last"), s["strict"].alias("strict"),
            _votes(s).alias("votes"), _features(s).alias("features"),
        ),
    )
    return found.withColumn(spans, voted).drop(holder)


def train(found: DataFrame, spans: str) -> dict[str, float]:
    """Reliabilities and classifier from all candidates; only counts of their patterns are collected."""
    counts = (
        found.select(F.explode(spans).alias("s"))
        .groupBy("s.kind", "s.votes", "s.features")
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    return _classifier(sorted((r["kind"], tuple(r["votes"]), tuple(r["features"]), r["n"]) for r in counts))


def _accepted(spans: str, odds: dict[str, float]) -> Column:
    """The spans that stay, by kind and place, without equal ones."""
    if odds:
        table = F.create_map(*(x for k, v in sorted(odds.items()) for x in (F.lit(k), F.lit(v))))
        name = lambda s, j, kind, x: F.concat_ws(":", s["kind"].cast("string"), F.lit(f"{kind}{j}"), x[j].cast("string"))

        def score(s):
            keys = [s["kind"].cast("string")]
            keys += [name(s, j, "v", s["votes"]) for j in range(LABELERS)]
            keys += [name(s, j, "f", s["features"]) for j in range(4)]
            return reduce(lambda a, b: a + b, (F.coalesce(F.try_element_at(table, k), F.lit(0.0)) for k in keys))

        wanted = lambda s: s["strict"] | (score(s) >= math.log(MIN_PROBABILITY / (1 - MIN_PROBABILITY)))
    else:
        wanted = lambda s: s["strict"]
    kept = F.transform(
        F.filter(spans, wanted),
        lambda s: F.struct(s["kind"].alias("kind"), s["first"].alias("first"), s["last"].alias("last"), s["strict"].alias("strict")),
    )
    # neighbours are compared: array_distinct compares structs all with all
    new = lambda ordered: F.filter(ordered, lambda x, i: (i == 0) | (x != F.get(ordered, i - 1)))
    return _let(F.sort_array(kept), new)


def find_spans(docs: DataFrame, column: str = "pii_spans") -> DataFrame:
    """``docs`` with an array of spans (kind 0..3 as in ``KINDS``, first, last, strict), places in code points."""
    found = _add_candidates(docs, column)
    return found.withColumn(column, _accepted(column, train(found, column)))


def listed(spans: Column) -> Column:
    """``kind:start:end`` by kind and place, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["first"].cast("string"), s["last"].cast("string"))), ","
    )


def summary(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, counts of strict spans by kind, their digest, all spans."""
    found = find_spans(docs.select("doc_id", "text"), "spans")
    strict = F.filter("spans", lambda s: s["strict"])

    def count(kind: int) -> Column:
        return F.size(F.filter(strict, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    counts = [count(kind) for kind in range(len(KINDS))]
    return found.select("doc_id", *counts, F.sha2(listed(strict), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets, overlapping spans by the first one's.

    A column ``n_chars`` gets the new length.
    """
    (spans,) = fresh(docs, "pii_spans")
    found = find_spans(docs, spans)
    text = F.col("text").cast("string")
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    ordered = F.sort_array(F.transform(spans, lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last"), s["kind"].alias("kind"))))

    def part(chunks, begin, end):
        """The text from ``begin`` to ``end``; only the chunks that hold it are touched."""
        first = F.floor(begin / CHUNK).cast("int")
        n = F.greatest(F.ceil(end / CHUNK).cast("int") - first, F.lit(0))
        return F.substring(F.array_join(F.slice(chunks, first + 1, n), ""), begin - first * CHUNK + 1, end - begin)

    def without(chunks, ordered, done):
        """``done``: for each span the furthest end of it and all before it."""

        def piece(s, i):
            at = F.coalesce(F.get(done, i - 1), F.lit(0))
            return F.when(s["first"] >= at, F.concat(part(chunks, at, s["first"]), names[s["kind"]]))

        rest = part(chunks, F.element_at(done, -1), F.length(text))
        return F.concat(F.array_join(F.transform(ordered, piece), ""), rest)

    ends = lambda spans: _running(F.transform(spans, lambda s: s["last"]), lambda a, b: F.greatest(a, b))
    rebuilt = _let(
        F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0)),
        lambda chunks: _let(ordered, lambda spans: _let(ends(spans), lambda done: without(chunks, spans, done))),
    )
    out = found.withColumn("text", F.when(F.size(spans) > 0, rebuilt).otherwise(text))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size(spans) > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
