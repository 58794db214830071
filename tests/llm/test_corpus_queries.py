"""The registered queries on the smallest given tables against brute force."""

import html as entities
import os
import re
import zlib

import numpy as np
import pytest
from test_corpus_dedup import brute_classes, brute_covered
from test_corpus_rules import brute_counts, brute_spans, brute_url, sha
from test_corpus_text import check_packing
from tokenizers import Tokenizer

from caseweave.llm import html
from caseweave.llm.common import read
from caseweave.llm.encoding import tokenizer_path
from caseweave.llm.queries import ORACLE, QUERIES, URL_RULES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="given tables not present")


@pytest.fixture(scope="module")
def documents(spark):
    return [(r["doc_id"], r["text"]) for r in read(spark, SF_DIR, "documents").collect()]


@pytest.fixture(scope="module")
def pages(spark):
    return {r["page_id"]: r for r in read(spark, SF_DIR, "pages").collect()}


def test_all_operators_are_registered():
    assert sorted({int(name[2:].split("_")[0]) for name in QUERIES}) == list(range(1, 14)) and len(QUERIES) == 13
    assert set(ORACLE) <= set(QUERIES)


def test_token_store(spark, documents):
    plain = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    expected, start = [], 0
    for key, text in sorted(documents):
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 1]
        expected.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, QUERIES["op1_token_store"](spark, SF_DIR).collect())) == expected


def test_near_duplicates(spark, documents):
    found = {r["doc_id"]: r["class_id"] for r in QUERIES["op2_near_duplicates"](spark, SF_DIR).collect()}
    assert found == dict(zip([k for k, _ in documents], brute_classes(documents)))


def test_main_text(spark, pages):
    rows = QUERIES["op4_main_text"](spark, SF_DIR).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"(?s)<article>(.*)</article>", pages[r["page_id"]]["html"])[1]
        blocks = [" ".join(entities.unescape(re.sub("<[^>]+>", " ", x)).split()) for x in re.split("</?(?:p|h1)>", article)]
        assert r["text"] == "\n".join(filter(None, blocks)) and r["n_chars"] == len(r["text"])


def test_main_text_without_article_tags(pages):
    """The scoring alone finds the text that the given pages mark as article."""
    for page in pages.values():
        plain = re.sub(r"<(/?)article\b[^>]*>", r"<\1div>", page["html"])
        assert html.extract(plain) == html.extract(page["html"]), page["page_id"]


def test_quality_rules(spark, documents):
    rows = {r["doc_id"]: r for r in QUERIES["op5_quality_rules"](spark, SF_DIR).collect()}
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for key, text in documents:
        r, counts = rows[key], brute_counts(text) if len(text or "") < 20000 else None
        if counts:
            assert tuple(r[n] for n in names) == counts
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["kept"] and r["base_failed"]) and r["kept"] == (not r["base_failed"] and r["rule"] is None)


def test_held_out_labels_are_met(spark):
    """Rules learned from half of the labels, held against the other half."""
    from caseweave.llm import quality

    docs, labels = (read(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    half = "pmod(xxhash64(doc_id, 'half'), 2) = "
    judged = quality.judge(docs, quality.fit(docs, labels.where(half + "0")))
    rows = judged.where("not base_failed").join(labels.where(half + "1"), "doc_id").select("kept", "quality").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.1 and len(bad) > 50


def test_personal_data(spark, documents):
    rows = {r["doc_id"]: r for r in QUERIES["op6_personal_data"](spark, SF_DIR).collect()}
    for key, text in documents:
        spans = brute_spans(text)
        assert [rows[key][f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [sum(s[0] == k for s in spans) for k in ("email", "ip", "card", "phone")]
        assert rows[key]["base_sha256"] == sha(",".join(f"{k}:{a}:{b}" for k, a, b in spans))


def test_urls(spark, pages):
    rows = QUERIES["op8_url_filter"](spark, SF_DIR).collect()
    assert sorted(map(str, map(tuple, rows))) == sorted(str((p, *brute_url(r["url"], URL_RULES))) for p, r in pages.items())


def test_packing(spark, documents):
    rows = QUERIES["op9_packing"](spark, SF_DIR).collect()
    used = check_packing(rows, documents, 2048)
    assert used <= 1.02 * sum(r["length"] for r in rows) / 2048 + 1


def test_repeated_passages(spark, documents):
    covered, _ = brute_covered(documents)
    got = {}
    for r in QUERIES["op10_repeated_passages"](spark, SF_DIR).collect():
        got.setdefault(r["doc_id"], set()).update(range(r["first"], r["last"]))
    assert got == {k: covered[t] for k, t in documents if t in covered}
