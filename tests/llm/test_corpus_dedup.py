"""Near-duplicates, repeated passages, decontamination and the pipeline against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from test_corpus_rules import brute_counts, brute_redact
from test_corpus_text import check_packing
from caseweave.llm import decontaminate, near_dedup, pii, quality, suffix_dedup
from caseweave.llm.common import read
from caseweave.session import scratch_path

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def vocabulary(seed, n=3000):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(n)]


VOCABULARY = vocabulary(1)


def prose(rng, n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


def edit(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = rng.choice(VOCABULARY)
    return " ".join(w)


# ---------------------------------------------------------------------------------------- near-duplicates
def shingles(text):
    w = words(text)
    return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def brute_classes(rows, threshold=0.8):
    """Classes by all pairs of distinct texts."""
    sets = [shingles(t) for _, t in rows]
    df = Counter(s for x in sets for s in x)
    n = len(rows)
    least = max(2, math.ceil(near_dedup.FREQUENT * n))
    weight = {s: math.log1p(1 / ((d / n if d >= least else 0) + near_dedup.SMOOTHING)) for s, d in df.items()}
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(n):
        for j in range(i):
            a, b = rows[i][1], rows[j][1]
            same = a is not None and a == b
            if not same and sets[i] and sets[j]:
                keys = sets[i].keys() | sets[j].keys()
                low = sum(min(sets[i][k], sets[j][k]) * weight[k] for k in keys)
                high = sum(max(sets[i][k], sets[j][k]) * weight[k] for k in keys)
                same = low / high >= threshold
            if same:
                parent[root(i)] = root(j)
    names = {}
    for i, (key, _) in enumerate(rows):
        r = root(i)
        if key is not None and (r not in names or names[r] is None or key < names[r]):
            names[r] = key
        names.setdefault(r, key)
    return [names[root(i)] for i in range(n)]


def near_rows():
    rng = random.Random(4)
    rows, key = [], 0
    for _ in range(30):
        base = prose(rng, rng.randint(60, 300))
        for i in range(rng.randint(1, 6)):
            rows.append((key, edit(rng, base, 0 if i < 2 else rng.randint(1, 2)) if i else base))
            key += 1
    chain = prose(rng, 200)
    for _ in range(8):  # neighbours are alike, the ends are not
        rows.append((key, chain))
        chain, key = edit(rng, chain, 3), key + 1
    hot = prose(rng, 150)
    rows += [(key + i, edit(rng, hot, 1)) for i in range(120)]
    key += 120
    for i in range(40):  # they share a passage and are no duplicates
        rows.append((key + i, prose(rng, 120) + " " + hot[:400]))
    key += 40
    rows += [(key, None), (key + 1, None), (key + 2, ""), (key + 3, ""), (key + 4, "..."), (key + 5, "one two"), (key + 6, "one two"),
             (key + 7, "One, two!"), (key + 8, "one two three"), (None, "only null id"), (None, None), (3, rows[3][1]), (3, "another text of id three")]
    rng.shuffle(rows)
    return rows


def test_near_duplicate_classes(spark):
    rows = near_rows()
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id long, text string, h string, class_id int")
    found = near_dedup.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    expected = sorted((str(k), str(c)) for (k, _), c in zip(rows, brute_classes(rows)))
    assert sorted((str(r["doc_id"]), str(r["class_id"])) for r in found) == expected


def test_lines_repeated_very_often_count_in_full(spark):
    rng = random.Random(12)
    line, shared = "total of all the rest ", prose(rng, 6000)
    rows = [
        (1, line * 2000 + prose(rng, 600)),  # alike for the line alone
        (2, line * 2000 + prose(rng, 600)),
        (3, shared + " " + line * 260),  # alike but for the line
        (4, shared + " " + line * 1000),
        (5, prose(rng, 300)),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicates(docs).collect()}
    assert found == dict(zip(range(1, 6), brute_classes(rows), strict=True)) == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5}


def test_one_of_each_class_stays(spark):
    rows = near_rows()
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id long, text string, row_no string, h int")
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    numbered = [(i, t) for i, (_, t) in enumerate(rows)]
    classes = brute_classes(numbered)
    expected = []
    for c in sorted(set(classes)):
        own = [rows[i] for i in range(len(rows)) if classes[i] == c]
        expected.append(min(own, key=lambda r: (r[0] is None, r[0] or 0))[0])
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == sorted(map(str, expected))
    # the same from files, where a row is known by its place
    path = scratch_path(spark, "documents")
    docs.write.parquet(path)
    again = near_dedup.keep_one(spark.read.parquet(path))
    assert again.columns == docs.columns
    assert sorted(map(str, (r["doc_id"] for r in again.collect()))) == sorted(map(str, expected))


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert near_dedup.near_duplicates(docs).count() == 0
    assert near_dedup.keep_one(docs).count() == 0
    assert suffix_dedup.repeated_passages(docs).count() == 0


def test_samples_agree_as_often_as_texts_are_alike():
    rng = np.random.default_rng(3)
    grams = np.sort(rng.integers(0, 1 << 63, 3000, dtype=np.uint64))
    a, b = grams[:2500], grams[500:]
    sampler = near_dedup.Sampler(samples=400)
    weights = near_dedup.Weights(10, np.zeros(0, np.uint64), np.zeros(0, np.int64))
    one = np.ones(2500, np.int64)
    x = sampler.draw(a, weights.log(a, one), np.array([0, 2500]))
    y = sampler.draw(b, weights.log(b, one), np.array([0, 2500]))
    assert abs((x == y).mean() - 2000 / 3000) < 0.08


# ---------------------------------------------------------------------------------------- repeated passages
def brute_covered(rows, size=50):
    """Per text: the words inside a window that another text has; equal texts count as other documents."""
    texts = {t for _, t in rows if t is not None}
    copies = Counter(t for _, t in rows)
    holders = {}
    for t in texts:
        w = words(t)
        for i in range(len(w) - size + 1):
            holders.setdefault(tuple(w[i : i + size]), set()).add(t)
    out = {}
    for t in texts:
        w = words(t)
        covered = set()
        for i in range(len(w) - size + 1):
            if len(holders[tuple(w[i : i + size])]) > 1:
                covered |= set(range(i, i + size))
        if copies[t] > 1 and len(w) >= size:
            covered = set(range(len(w)))
        if covered:
            out[t] = covered
    links = {frozenset((a, b)) for h in holders.values() for a in h for b in h if a != b}
    return out, links


def passage_rows(seed):
    rng = random.Random(seed)
    shared = [prose(rng, n) for n in (49, 50, 51, 60, 75, 130, 400)]
    rows = []
    for i in range(120):
        parts = [prose(rng, rng.randint(0, 150))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(shared).split()
            cut = rng.randint(0, 12)
            parts += [" ".join(p[cut:] if rng.random() < 0.5 else p), prose(rng, rng.randint(0, 40))]
        rows.append((i, "; ".join(parts)))
    rows += [(200 + i, "Common " + shared[3]) for i in range(60)]  # equal texts
    rows += [(300 + i, prose(rng, 5) + " " + shared[4]) for i in range(150)]  # a very common passage
    own = prose(rng, 60)
    rows += [(500, own + " x " + own), (501, None), (502, ""), (503, prose(rng, 30)), (504, prose(rng, 30)), (None, shared[5]), (1, rows[1][1])]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_repeated_words_and_links(spark, seed):
    rows = passage_rows(seed)
    docs = spark.createDataFrame([(k, t, 1, "x") for k, t in rows], "doc_id long, text string, first int, h string").repartition(5)
    found = suffix_dedup.repeated_passages(docs).collect()
    covered, links = brute_covered(rows)
    by_text = {t: [k for k, x in rows if x == t] for t in covered}
    expected = Counter()
    for t, ks in by_text.items():
        for k in ks:
            expected[(str(k), tuple(sorted(covered[t])))] += 1
    got = {}
    rows_of = Counter((str(r["doc_id"]), r["first"], r["last"]) for r in found)
    texts_of = {}
    for k, t in rows:
        texts_of.setdefault(str(k), []).append(t)
    for (k, a, b), n in rows_of.items():
        got.setdefault(k, set()).update(range(a, b))
    for (k, own), _ in expected.items():
        if len(set(texts_of[k])) == 1:
            assert got.get(k, set()) == set(own), k
    assert set(got) == {k for k, _ in expected}
    # texts that share a window are in one class by their links
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for r in found:
        for other in r["linked"]:
            parent[root(str(r["doc_id"]))] = root(str(other))
    ids = {t: str(ks[0]) for t, ks in by_text.items()}
    for pair in links:
        a, b = pair
        if ids[a] != "None" and ids[b] != "None":
            assert root(ids[a]) == root(ids[b])
    assert not any(r["doc_id"] in (500, 501, 502, 503, 504) for r in found)


def test_neighbours_across_batches_and_bounds():
    import pyarrow as pa

    rng = random.Random(7)
    rows = sorted((rng.randint(0, 40), rng.randint(0, 3), rng.randint(0, 5)) for _ in range(300))
    table = pa.table({"k": pa.array([r[0] for r in rows], pa.int64()), "t": pa.array([r[1] for r in rows], pa.int64()), "place": pa.array([r[2] for r in rows], pa.int32())})
    for cuts in ([], [1], [3, 4, 150], list(range(1, 300))):
        for size in (1, 7, 1000):
            ranges = [table.slice(a, b - a) for a, b in zip([0, *cuts], [*cuts, 300])]
            out = [r for part in ranges for b in suffix_dedup._neighbours(iter(part.to_batches(max_chunksize=size))) for r in b.to_pylist()]
            low, high = {}, {}
            for r in out:
                if r["place"] < 0:
                    low[r["k"]] = min(low.get(r["k"], 99), r["t"])
                    high[r["k"]] = max(high.get(r["k"], -1), r["first_t"])
            got = sorted((r["k"], r["t"], r["place"], min(r["first_t"], low.get(r["k"], 99))) for r in out if r["place"] >= 0 and (r["shared"] or low.get(r["k"], 9) < high.get(r["k"], -1)))
            ts = {}
            for k, t, _ in rows:
                ts.setdefault(k, set()).add(t)
            assert got == sorted((k, t, p, min(ts[k])) for k, t, p in rows if len(ts[k]) > 1)


# ---------------------------------------------------------------------------------------- decontamination
def brute_hits(docs, items, window):
    patterns = {}
    for item, text in items:
        w = words(text)
        m = min(window, len(w))
        for i in range(len(w) - m + 1 if w else 0):
            patterns.setdefault(tuple(w[i : i + m]), set()).add("null" if item is None else str(item))
    out = []
    for key, text in docs:
        w = words(text)
        hit, names = set(), set()
        for p, own in patterns.items():
            for i in range(len(w) - len(p) + 1):
                if tuple(w[i : i + len(p)]) == p:
                    hit |= set(range(i, i + len(p)))
                    names |= own
        out.append((str(key), len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def contamination_rows():
    rng = random.Random(9)
    small = VOCABULARY[:6]
    items = [(i, prose(rng, rng.choice([3, 9, 10, 11, 25]))) for i in range(30)]
    items += [(30, " ".join(rng.choice(small) for _ in range(12))), (31, "a"), (32, ""), (33, None), (None, "b c"), (34, items[4][1]), (34, "É é"), (35, items[4][1])]
    docs = []
    for i in range(80):
        parts = [prose(rng, rng.randint(0, 40))]
        for _ in range(rng.randint(0, 2)):
            w = rng.choice(items)[1] or ""
            parts += [w.upper() if rng.random() < 0.3 else w.replace(" ", ", "), prose(rng, 5)]
        docs.append((i, " ".join(parts)))
    docs += [(100, None), (101, ""), (102, "a"), (102, "a"), (None, "b-c É é"), (103, " ".join(rng.choice(small) for _ in range(3000)))]
    return docs, items


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_decontamination(spark, block_bytes):
    docs, items = contamination_rows()
    frame = spark.createDataFrame([(k, t, 1, "x") for k, t in docs], "doc_id long, text string, row int, items string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.judge(decontaminate.find_contamination(frame, bench, block_bytes=block_bytes)).collect()
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in found)
    assert got == brute_hits(docs, items, 10)


def test_long_items_are_cut_without_loss(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "SEGMENT_WORDS", 7)
    docs, items = contamination_rows()
    tables = decontaminate.compile_patterns(
        [(r["item"], r["words"]) for b in decontaminate._segments(10)(iter([_batch(items)])) for r in b.to_pylist()], 10
    )
    for _, text in docs:
        w = decontaminate.words(text)
        hit = {j for t in tables for a, b, _ in t.search(w) for j in range(a, b)}
        assert len(hit) == brute_hits([(0, text)], items, 10)[0][2]


def _batch(items):
    import pyarrow as pa

    return pa.record_batch([pa.array([str(i) for i, _ in items]), pa.array([t for _, t in items])], names=["a", "b"])


def test_contaminated_documents_go(spark):
    docs, items = contamination_rows()
    frame = spark.createDataFrame([(k, t, 1, "x") for k, t in docs], "doc_id long, text string, row_no int, spans string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    clean = decontaminate.drop_contaminated(frame, bench)
    assert clean.columns == frame.columns
    expected = [k for k, t in docs if not brute_hits([(k, t)], items, 10)[0][5]]
    assert sorted(map(str, (r["doc_id"] for r in clean.collect()))) == sorted(map(str, expected))
    in_blocks = decontaminate.drop_contaminated(frame, bench, block_bytes=300)
    assert sorted(map(str, (r["doc_id"] for r in in_blocks.collect()))) == sorted(map(str, expected))
    assert decontaminate.drop_contaminated(frame, bench.limit(0)).count() == len(docs)
    assert decontaminate.drop_contaminated(frame.limit(0), bench).count() == 0


# ---------------------------------------------------------------------------------------- pipeline
def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = read(spark, sf, "documents")
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_duplicates", "benchmark_passages", "personal_data", "packed_sequences"]
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        from caseweave.llm.common import stored

        docs = stored(stage(spark, docs, sf), name)
        assert docs.columns == columns
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert set(after) <= set(before)
        seen[name] = (before, after)
    before, after = seen["near_duplicates"]
    rows = sorted(before.items())
    assert sorted(after) == sorted(set(brute_classes(rows)))
    before, after = seen["benchmark_passages"]
    items = [(r["item_id"], r["text"]) for r in read(spark, sf, "benchmark").collect()]
    assert sorted(after) == sorted(k for k, t in before.items() if not brute_hits([(k, t)], items, 10)[0][5])
    before, after = seen["personal_data"]
    assert set(before) == set(after)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert {r["doc_id"] for r in last.select("doc_id").distinct().collect()} == set(after)


def brute_statistics(text):
    """What quality rules look at, by plain counting."""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    n_words, n_chars, n_symbols, n_dup, n_repeat = brute_counts(text)
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    share = lambda a, b: a / max(b, 1)
    return n_words, n_repeat, {
        "mean_word": share(n_chars, n_words), "symbol_share": share(n_symbols, n_chars), "dup_line_share": share(n_dup, len(lines)),
        "repeat_share": share(n_repeat, n_words), "upper_share": share(len(re.findall("[A-Z]", text)), n_chars),
        "mark_share": share(text.count("!") + text.count("?"), n_chars), "digit_share": share(len(re.findall("[0-9]", text)), n_chars),
        "same_share": share(sum(a == b for a, b in zip(w, w[1:])), n_words),
    }


def brute_kept(text, rules):
    n_words, n_repeat, x = brute_statistics(text or "")
    if n_words < 50 or 100 * n_repeat > 50 * n_words:
        return False
    return not any(all(x[name] <= t if op == "<=" else x[name] > t for name, op, t in rule) for rule in rules)


def test_pipeline_run(spark):
    """All rows of the pipeline against the same stages in plain Python; models and spans are the operators' own."""
    sf = "/root/testdata/sf0.001"
    table = read(spark, sf, "documents")
    rules = quality.fit(table, read(spark, sf, "labels"))
    docs = sorted((r["doc_id"], r["text"]) for r in table.collect() if brute_kept(r["text"], rules))
    assert 0 < len(docs) < table.count() and rules
    first = set(brute_classes(docs))
    docs = [(k, t) for k, t in docs if k in first]
    items = [(r["item_id"], r["text"]) for r in read(spark, sf, "benchmark").collect()]
    hit = {r[0] for r in brute_hits(docs, items, 10) if r[5]}
    docs = [(k, t) for k, t in docs if str(k) not in hit]
    spans = {r["doc_id"]: r["spans"] for r in pii.summary(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    clean = [(k, brute_redact(t, spans[k])) for k, t in docs]
    assert clean != docs
    check_packing(corpus_pipeline.run(spark, sf).collect(), clean, 2048)


def test_pipeline_without_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = read(spark, sf, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
        assert docs.count() == 0


def test_weights_do_not_depend_on_the_size_of_the_table(spark):
    """Rare shingles weigh the same however many there are, frequent ones by their share."""
    rng = random.Random(6)
    weights = []
    for n in (300, 3000):
        docs = [(i, prose(rng, 80) + (" the same few words of all" if i % 3 == 0 else "")) for i in range(n)]
        n_docs, grams, df = near_dedup.frequent_shingles(spark.createDataFrame(docs, "doc_id long, text string").select("text"))
        shares = Counter(s for _, t in docs for s in shingles(t))
        assert n_docs == n and sorted(df.tolist()) == sorted(d for d in shares.values() if d >= max(2, math.ceil(0.01 * n)))
        w = near_dedup.Weights(n_docs, grams, df)
        other = np.array([12345], np.uint64)
        weights.append((float(w.plain(other, np.ones(1))[0]), float(w.plain(grams[np.argmax(df)][None], np.ones(1))[0])))
    assert weights[0] == weights[1] and weights[0][0] > 1.3 * weights[0][1]


def test_blocks_are_bounded_by_shingles(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", 500)
    rows = near_rows()
    docs = spark.createDataFrame([(k, t) for k, t in rows], "doc_id long, text string")
    found = near_dedup.near_duplicates(docs).collect()
    assert sorted((str(r["doc_id"]), str(r["class_id"])) for r in found) == sorted(
        (str(k), str(c)) for (k, _), c in zip(rows, brute_classes(rows))
    )
