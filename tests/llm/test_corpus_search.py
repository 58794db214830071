"""Lexical search, filter audit and repeated windows against plain Python."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseweave.llm import filter_audit, lexical, window_dedup

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# ---------------------------------------------------------------------------------------- lexical search
def brute_search(docs, items, top):
    terms = [Counter(TERM.findall(lower(t))) for _, t in docs]
    sizes = [sum(c.values()) for c in terms]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for c in terms for t in c)
    asked = defaultdict(set)
    for item, text in items:
        asked[item] |= set(TERM.findall(lower(text)))
    out = {}
    for item, wanted in asked.items():
        scored = []
        for (key, _), tf, size in zip(docs, terms, sizes):
            if not size:
                continue
            m = 50 + 50 * size * n // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 20 * m))
                for t in wanted if t in tf
            )
            if score > 0:
                scored.append((-score, key is None, key, score))
        out[item] = [(k, s) for _, _, k, s in sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:top]]
    return {k: v for k, v in out.items() if v}


def search_tables(spark, seed=3):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)] + ["É", "straße", "x1"]
    weights = [1 / (i + 1) for i in range(len(vocab))]
    text = lambda n: " ".join(rng.choices(vocab, weights, k=n))
    docs = [(i, text(rng.choice([1, 3, 20, 20, 60, 400]))) for i in range(300)]
    docs += [(400 + i, "w3 w4 w5") for i in range(90)]  # a stratum of copies, ties everywhere
    docs += [(7, "W3, w9-w9"), (7, "W3, w9-w9"), (None, "w5 w9"), (-3, None), (-4, ""), (-5, " .,\n"), (900, "w0 " * 30_000)]
    items = [(f"i{i}", text(rng.choice([1, 2, 8, 30]))) for i in range(25)]
    items += [("i0", "W7 w8"), (None, "w3 w50"), ("none", None), ("blank", "..."), ("absent", "zzz yyy"), ("often", "w0 w1")]
    rng.shuffle(docs)
    return (
        docs, items,
        spark.createDataFrame([(k, t, 1, "s") for k, t in docs], "doc_id long, text string, m int, segment string"),
        spark.createDataFrame([(k, t, 2) for k, t in items], "item_id string, text string, score int"),
    )


def as_found(rows):
    found = defaultdict(list)
    for r in sorted(rows, key=lambda r: r["rank"]):
        assert r["rank"] == len(found[r["item_id"]]) + 1
        found[r["item_id"]].append((r["doc_id"], r["score"]))
    return dict(found)


@pytest.mark.parametrize(("segment_docs", "query_bytes", "known"), [(1 << 14, 1 << 20, True), (40, 1500, True), (100, 1 << 20, False)])
def test_search_equals_brute_force(spark, monkeypatch, segment_docs, query_bytes, known):
    docs, items, docs_df, items_df = search_tables(spark)
    if not known:
        monkeypatch.setattr(lexical, "VOCABULARY_BYTES", 0)
    index = lexical.build_index(docs_df, lexical.query_terms(items_df), segment_docs=segment_docs)
    assert as_found(lexical.search(index, items_df, 10, query_bytes=query_bytes).collect()) == brute_search(docs, items, 10)


def test_search_with_an_index_of_all_terms(spark):
    docs, items, docs_df, items_df = search_tables(spark, 9)
    index = lexical.build_index(docs_df)
    assert as_found(lexical.search(index, items_df, 50).collect()) == brute_search(docs, items, 50)


def test_bounds_hold_and_visits_end_early(spark, monkeypatch):
    docs, items, docs_df, items_df = search_tables(spark, 5)
    index = lexical.build_index(docs_df, segment_docs=1 << 14)
    rows = index.strata.toArrow()
    q = lexical._Queries([(i, t, df) for i, t, df in [("a", "w50", 3), ("a", "w0", 390), ("b", "w3", 90)]], 390)
    seen = 0
    for m, keys, postings in zip(rows["m"].to_pylist(), rows["keys"].to_pylist(), rows["postings"].combine_chunks()):
        stratum = lexical._Stratum(m, len(keys), postings.values, q.terms)
        bounds = stratum.bounds(q)
        for i in range(2):
            mine = slice(q.starts[i], q.starts[i + 1])
            scores = stratum.scores(q.term[mine], q.weight[mine])
            seen += int((scores > 0).sum())
            assert scores.max(initial=0) <= bounds[i]
    assert seen

    visits = []
    plain = lexical._Stratum.scores
    monkeypatch.setattr(lexical._Stratum, "scores", lambda self, *a: visits.append(1) or plain(self, *a))

    class Sent:
        value = q

    lexical._search_segment(Sent, 3)(rows)
    assert 0 < len(visits) < 2 * rows.num_rows


def test_search_in_nothing(spark):
    _, _, docs, items = search_tables(spark)
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs.where("doc_id between -5 and -3"), items)):
        found = lexical.search_all(d, i)
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.count() == 0


# ---------------------------------------------------------------------------------------- filter audit
def brute_audit(docs, labels):
    good = {k for k, q, _ in labels if k is not None and q == 1}
    toxic = {k for k, _, t in labels if k is not None and t == 1}
    first = {}
    for key, text, _ in docs:
        if key is not None:
            first[text or ""] = min(first.get(text or "", key), key)
    rows = defaultdict(list)
    for key, text, lang in docs:
        text = text or ""
        words = WORD.findall(text)
        fails = set()
        if len(words) < 200:
            fails.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text):
            fails.add("C")
        if re.search("[#$%&*|]", text):
            fails.add("D")
        if key is not None and key > first[text]:
            fails.add("E")
        rows[lang or ""].append((frozenset(fails), key in good, key in toxic))
    out = {}
    for part, own in rows.items():
        shapley = Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            for i, letter in enumerate(order):
                before = set(order[:i])
                gone = [r for r in own if letter in r[0] and not r[0] & before]
                shapley[letter] += len(gone)
                out[part, order, i + 1] = (
                    sum(not r[0] & (before | {letter}) for r in own), len(gone), sum(letter in r[0] and bool(r[0] & before) for r in own),
                    sum(r[0] == {letter} for r in own), sum(r[1] for r in gone), sum(r[2] for r in gone), letter,
                )
        for key in [k for k in out if k[0] == part]:
            out[key] = (*out[key][:-1], shapley[out[key][-1]])
    return out


def audit_tables(spark):
    rng = random.Random(2)
    docs = []
    for i in range(260):
        n = rng.choice([3, 150, 200, 260])
        words = [f"v{rng.randrange(rng.choice([20, 5000]))}" for _ in range(n)]
        text = rng.choice([" ", "\t \n", "\x0b"]).join(words) + rng.choice(["", " #", " ABC" * 12, " É", "|"])
        docs.append((i, text, rng.choice(["en", "de", None, ""])))
    docs += [(300 + i, docs[0][1], "en") for i in range(90)] + [(0, docs[0][1], "fr"), (None, docs[0][1], "en"), (None, docs[5][1], "de")]
    docs += [(500, None, "en"), (501, "", "fr"), (-1, "x" * 90_000, "fr"), (502, "alone", "it"), (None, "no id", "it"), (1, docs[0][1], "en")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 340, 2)] + [(0, 1, 1), (0, 0, 0), (None, 1, 1), (9999, 1, 1)]
    rng.shuffle(docs)
    return docs, labels


def test_audit_equals_brute_force(spark):
    docs, labels = audit_tables(spark)
    rows = filter_audit.audit(
        spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, lang string, mask int, part string"),
        spark.createDataFrame([(*r, 5) for r in labels], "doc_id long, quality int, toxic int, n int"),
    ).collect()
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r[n] for n in names) for r in rows}
    assert len(got) == len(rows) and got == brute_audit(docs, labels)


def test_audit_of_nothing_and_of_other_filters(spark):
    docs, labels = audit_tables(spark)
    docs = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs.limit(0), labels).count() == 0
    assert filter_audit.audit(docs, labels.limit(0)).agg(F.sum("good_lost") + F.sum("toxic_lost")).first()[0] == 0
    short = filter_audit.audit(docs, labels, lambda text, words: {"S": F.size(words) < 200, "H": text.contains("#")}, None)
    assert {r["filter_order"] for r in short.collect()} == {"SH", "HS"} and short.count() == 4 * docs.select(F.coalesce("lang", F.lit(""))).distinct().count()


def test_the_audit_runs_without_python(spark):
    docs, labels = audit_tables(spark)
    cells, _ = filter_audit._cells(
        spark.createDataFrame(docs, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
        filter_audit.failures, "E", "lang",
    )
    plan = cells._jdf.queryExecution().toString()
    assert "Python" not in plan and "ArrowEval" not in plan


# ---------------------------------------------------------------------------------------- repeated windows
def brute_windows(docs, window):
    words = [WORD.findall(t or "") for _, t in docs]
    order = lambda k: math.inf if k is None else k
    first = {}
    for (key, _), w in zip(docs, words):
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            first[k] = min(first.get(k, math.inf), order(key))
    out = []
    for (key, _), w in zip(docs, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < order(key):
                gone |= set(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((key, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=str)


def window_documents():
    rng = random.Random(8)
    word = lambda: rng.choice(["a", "B", "é", "\x00", "\x01", "🙂", "c,"]) + str(rng.randrange(400))
    passages = [[word() for _ in range(n)] for n in (13, 14, 60, 12, 200)]
    docs = []
    for i in range(160):
        w = [word() for _ in range(rng.choice([0, 5, 40, 300]))]
        for _ in range(rng.choice([0, 1, 2])):
            at = rng.randrange(len(w) + 1)
            w[at:at] = rng.choice(passages)
        docs.append((i * 3 % 170, rng.choice([" ", "\n", "\t\r "]).join(w)))
    docs += [(200 + i, docs[4][1]) for i in range(40)] + [(k, t) for k, t in docs[:3]]
    docs += [(None, " ".join(passages[2])), (None, docs[9][1]), (999, None), (998, ""), (-7, " ".join(passages[4]) + " x" * 60)]
    docs += [(500, "one two three four five six " * 9_000), (501, "one two " * 20), (1, " ".join(passages[2] * 3))]
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize(("chunk_bytes", "slice_cells", "cells"), [(1 << 22, 1 << 20, 8), (2000, 3000, 8), (5000, 1 << 20, 1)])
def test_windows_equal_brute_force(spark, monkeypatch, chunk_bytes, slice_cells, cells):
    """Also with many chunks and slices, and with a sketch so small that its counts say little."""
    monkeypatch.setattr(window_dedup, "CELLS_PER_WINDOW", cells)
    docs = window_documents()
    table = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id int, text string, chunk int, ids string")
    left = window_dedup.remove_repeats(table, chunk_bytes=chunk_bytes, slice_cells=slice_cells)
    assert left.schema["doc_id"].dataType.simpleString() == "int"
    rows = left.collect()
    got = sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"], r["kept_text"]) for r in rows), key=str)
    assert got == brute_windows(docs, 13)
    assert all(sum(s["last"] - s["first"] for s in r["spans"]) == r["n_removed"] for r in rows)


def test_the_sketch_never_counts_too_little():
    rng = np.random.default_rng(4)
    layout = window_dedup._Layout(5000, 700)
    keys = [rng.choice(rng.integers(0, 1 << 63, 4000, dtype=np.uint64) * np.uint64(2), 1500) for _ in range(4)]
    keys[2][:300], keys[3][:300] = keys[0][:300], keys[1][:300]
    counts = Counter(int(k) for x in keys for k in x)
    for step in range(window_dedup.DEPTH):
        merged = Counter(int(c) for x in keys for c in layout.cells(x, step))
        for x in keys:
            assert all(merged[int(c)] >= counts[int(k)] for k, c in zip(x, layout.cells(x, step)))


def test_packed_arrays_come_back():
    for a in (np.zeros(0, np.int64), np.arange(7, dtype=np.uint32), np.array([-1, 1 << 62], np.int64), np.frombuffer(b"abc", np.uint8)):
        assert window_dedup._unpack(window_dedup._pack(a), a.dtype).tolist() == a.tolist()


def test_windows_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert window_dedup.remove_repeats(empty).count() == 0
    blank = spark.createDataFrame([(1, None), (2, ""), (None, "a b")], "doc_id long, text string")
    assert sorted((r["n_words"], r["n_removed"]) for r in window_dedup.remove_repeats(blank).collect()) == [(0, 0), (0, 0), (2, 0)]
    with pytest.raises(ValueError, match="integer"):
        window_dedup.remove_repeats(spark.createDataFrame([("a", "b")], "doc_id string, text string"))
