"""Chat format, main text, quality rules, personal data and URL rules against plain Python."""

import hashlib
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseweave.llm import chat, html, pii, quality, url_filter
from caseweave.session import scratch_path


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---------------------------------------------------------------------------------------- chat
CHATS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "</s>[INST] ok [/INST]"), (1, 2, "user", None), (1, 3, "assistant", "b\\</s><\\s>"),
    (2, 0, None, "x"), (2, 0, None, "x"), (None, 5, "assistant", "null id"), (3, None, "system [INST]", ""), (3, 1, "assistant", None),
    (4, 1, "user", "é🙂[\\INST]"), (4, 0, "assistant", "first"),
]


def chat_table(spark):
    rows = [(*r, "extra", 3) for r in CHATS] + [(9, i, "assistant" if i % 2 else "user", f"t{i}", "extra", 3) for i in range(400)]
    return rows, spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, seq string, start int")


def test_chat_round_trip(spark):
    rows, df = chat_table(spark)
    path = scratch_path(spark, "chats")
    chat.write_chats(df, path)
    turns = chat.read_turns(spark, path)
    found = {r["conv_id"]: r for r in chat.digest(turns).collect()}
    assert len(found) == len({r[0] for r in rows})
    for conv, row in found.items():
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", hashlib.md5((r[3] or "").encode()).hexdigest()))
        replies = "".join(r[3] or "" for r in own if r[2] == "assistant")
        assert row["n_turns"] == len(own)
        assert row["turns_sha256"] == sha("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own))
        assert (row["loss_chars"], row["loss_sha256"]) == (len(replies), sha(replies))
    assert not any("Python" in x or "Pandas" in x for x in chat.digest(turns)._jdf.queryExecution().toString().split("\n"))


def test_every_reply_is_an_example_with_its_whole_context(spark):
    rows, df = chat_table(spark)
    path = scratch_path(spark, "chats")
    chat.write_chats(df, path)
    examples = chat.example_texts(spark, path, spark.createDataFrame([(1,), (9,), (None,)], "conv_id long")).collect()
    assert [r["text"][r["loss_start"] : r["loss_end"]] for r in examples if r["conv_id"] is None] == ["null id"]
    assert sum(r["conv_id"] == 1 for r in examples) == 2 and sum(r["conv_id"] == 9 for r in examples) == 200
    for r in examples:
        reply = r["text"][r["loss_start"] : r["loss_end"]]
        assert r["text"].count(chat.CLOSE) == r["text"].count(chat.OPEN)
        if r["conv_id"] == 9:
            k = 2 * r["example"] + 1
            assert reply == f"t{k}"
            assert r["text"] == "".join(
                f"{chat.OPEN}{'assistant' if i % 2 else 'user'}{chat.ROLE_END}t{i}{chat.CLOSE}" for i in range(k + 1)
            )


@pytest.mark.parametrize("span", [1, 3, 64])
def test_store_holds_every_example_in_full(spark, monkeypatch, span):
    monkeypatch.setattr(chat, "SPAN", span)
    rows, df = chat_table(spark)
    rows += [(None, i, "assistant", f"n{i}", "extra", 3) for i in range(6, 9)]
    df = df.union(spark.createDataFrame(rows[-3:], df.schema))
    path = scratch_path(spark, "chats")
    chat.write_chats(df, path)
    got = {(r["conv_id"], r["example"]): r for r in spark.read.parquet(f"{path}/examples").collect()}
    assert len(got) == sum(r[2] == "assistant" for r in rows)
    escaped = lambda t: re.sub(r"\[(\\*)(/?INST\])", r"[\\\1\2", re.sub(r"<(\\*)(/?s>)", r"<\\\1\2", t or ""))
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", hashlib.md5((r[3] or "").encode()).hexdigest()))
        text, example = "", 0
        for r in own:
            text += chat.OPEN + escaped(r[2]) + chat.ROLE_END
            if r[2] == "assistant":
                found = got[conv, example]
                assert found["text"] == text + escaped(r[3]) + chat.CLOSE
                assert (found["context_chars"], found["loss_start"], found["loss_chars"]) == (len(text), len(text), len(escaped(r[3])))
                example += 1
            text += escaped(r[3]) + chat.CLOSE


@pytest.mark.parametrize("text", ["<s>", "</s>", "<\\s>", "<\\\\/s>", "[INST][/INST]", "[\\/INST]", "<<s>>", "<s", "\\", "a\\[INST]", ""])
def test_escape_is_reversible(spark, text):
    row = spark.createDataFrame([(text,)], "t string").select(chat.escape(F.col("t")).alias("e")).select("e", chat.unescape(F.col("e")).alias("u")).first()
    assert row["u"] == text
    assert not re.search(r"</?s>|\[/?INST\]", row["e"])


def test_no_conversations(spark):
    path = scratch_path(spark, "chats")
    chat.write_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string"), path)
    assert chat.digest(chat.read_turns(spark, path)).count() == 0


# ---------------------------------------------------------------------------------------- html
LONG = "This is a paragraph, long enough, with commas, to score well in any page of this kind. "
PAGES = {
    "": "",
    "just text": "just text",
    "<p>a&amp;b &#x41;&nbsp; c<br>d<p>e": "a&b A c d\ne",
    f"<body><nav><a href=x>menu</a></nav><article><h1>T</h1><p>{LONG}<p>Short.</article><footer>f</footer>": f"T\n{LONG.strip()}\nShort.",
    f"<div id='sidebar'><p>{LONG * 4}</div><main><p>{LONG}</p><section class='comments'><p>{LONG}</p></section></main>": LONG.strip(),
    f"<article><p>{LONG}<div class=\"ad\">buy</div><aside>x</aside><form><input><p>{LONG}</form><script>var t='</p>';</script><p>end</article>": f"{LONG.strip()}\nend",
    f"<article><p>{LONG}</p><style>p{{}}</style><!-- <p>no</p> --><ul><li>one<li>two</ul><table><tr><td>c1<td>c2</table></article": f"{LONG.strip()}\none\ntwo\nc1\nc2",
    f"<div><p>{LONG}</p><p>{LONG}</p></div><div class=related><a href=a>{LONG}</a></div>": f"{LONG.strip()}\n{LONG.strip()}",
    "<p>a < b and c > d &lt;p&gt;</p>": "a < b and c > d <p>",
    f"<div role=navigation><p>{LONG * 3}</p></div><div><p>{LONG}": LONG.strip(),
    "<nav>only menu</nav>": "",
}


@pytest.mark.parametrize("page", PAGES)
def test_main_text(page):
    assert html.extract(page) == PAGES[page]


PROSE = "The results differ from those of earlier work, as the sample was larger, and all the items were read by two people."


@pytest.mark.parametrize("name", ["content with-sidebar", "has-header", "comments-open", "search"])
def test_hints_on_the_element_around_the_text(name):
    page = f'<body><div class="ad">Buy now</div><div class="{name}"><p>{PROSE}</p><p>{PROSE}</p></div></body>'
    assert html.extract(page) == f"{PROSE}\n{PROSE}"


def test_parts_of_an_article_with_hints_in_their_names():
    parts = [
        f"<p>{PROSE}</p>", f'<section id="discussion"><h2>Discussion</h2><p>{PROSE}</p></section>',
        '<h2 id="form-and-content">Form</h2>', f'<section id="related-work"><p>{PROSE}</p></section>',
        f'<p id="search-methods">{PROSE}</p>', "<p>So <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p>",
    ]
    left_out = [
        f'<div id="comments"><p>{PROSE}</p></div>', f'<div class="ad">{PROSE}</div>',
        f'<div class="related"><a href="/">{PROSE}</a></div>', '<div class="share">Share this</div>',
    ]
    page = f"<body><article>{''.join(parts)}{''.join(left_out)}</article></body>"
    assert html.extract(page) == "\n".join([PROSE, "Discussion", PROSE, "Form", PROSE, PROSE, "So x=2 holds."])


def test_a_form_around_the_page_keeps_its_article():
    form = f'<form action="/x"><header>Site</header><p>{PROSE}</p><p>{PROSE}</p><label>Your name</label></form>'
    assert html.extract(f"<body>{form}<footer>f</footer></body>") == f"{PROSE}\n{PROSE}"
    assert html.extract(f"<body><form><nav>m</nav><article><p>{PROSE}</p></article></form></body>") == PROSE
    # a form that is one, in or beside the text
    for page in (f"<article><p>{PROSE}</p><form><p>{PROSE} {PROSE}</p></form></article>", f"<div><p>{PROSE}</p></div><form><label>{PROSE}</label></form>"):
        assert html.extract(page) == PROSE
    assert html.extract("<form>Search <label>here</label><input></form>") == ""


def test_very_many_inline_tags_take_linear_time():
    began = time.monotonic()
    assert html.extract("<p>" + "<b>" * 100_000 + "x" + "</b>" * 100_000) == "x"
    assert html.extract("<p>" + "<b>" * 100_000 + "x" + "</i>" * 100_000) == "x"
    assert html.extract("<div>" + "<b>" * 50_000 + "<div>y</div>" * 50_000).count("y") == 50_000
    assert html.extract("<b><li>" * 30_000 + "z") == "z"
    assert time.monotonic() - began < 30


def test_deep_and_long_pages_end():
    assert html.extract("<div>" * 20000 + "x" + "</div>" * 20000) == "x"
    assert html.extract("<p>" + "word, " * 200000).count("word") == 200000
    assert html.extract("<" * 50000) == "<" * 50000


def test_pages_keep_nulls_and_repeats(spark):
    rows = [(1, "u", "<p>a"), (1, "u", "<p>a"), (None, None, None), (2, "v", "")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, text string")
    found = sorted((str(r["page_id"]), r["text"], r["n_chars"]) for r in html.extract_pages(df).collect())
    assert found == [("1", "a", 1), ("1", "a", 1), ("2", "", 0), ("None", "", 0)]


# ---------------------------------------------------------------------------------------- quality
def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    triples = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    inside = {j for i, t in enumerate(triples) if triples.count(t) > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dups = sum(x in lines[:i] for i, x in enumerate(lines))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dups, len(inside)


TEXTS = ["", None, "a b c a b c a b c", "x\nx\n\n \n \nx y\u00a0z", "a a a a a a", "one two three\none two three four", "é# *$%&|<> \x1c b\x0bc"]


@pytest.mark.parametrize("text", TEXTS)
def test_counts(text):
    assert quality.count_text(text)[:5] == brute_counts(text)


def quality_tables(spark):
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abcdefghij"), rng.integers(2, 9)))
    rows, labels = [], []
    for i in range(600):
        bad = i % 4 == 0
        words = [word() + ("&&&" if bad else "") for _ in range(80)]
        rows.append((i, " ".join(words), 9, "n"))
        if i % 2 == 0:
            labels.append((i, 0 if bad else 1, 0))
    rows += [(1000, None, 9, "n"), (None, "short text", 9, "n"), (1001, "one two three " * 40, 9, "n")]
    labels += [(None, 0, 0), (2, None, 0), (99999, 1, 0)]
    return (
        spark.createDataFrame(rows, "doc_id long, text string, n_words int, counts string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_fitted_rows_are_bounded_by_the_labels(spark):
    docs, labels = quality_tables(spark)
    often = docs.unionByName(docs.where("doc_id % 8 = 0")).unionByName(docs.where("doc_id % 8 = 0"))
    assert quality.fit(often, labels) == quality.fit(docs, labels)


def test_rules_are_learned_and_applied(spark):
    docs, labels = quality_tables(spark)
    rules = quality.fit(docs, labels)
    assert rules
    rows = {r["doc_id"]: r for r in quality.judge(docs, rules).collect()}
    good = [rows[i]["kept"] for i in range(600) if i % 4]
    bad = [rows[i]["kept"] for i in range(600) if i % 4 == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.05  # a quarter of these have no label
    assert rows[1000]["base_failed"] and rows[None]["base_failed"] and rows[1001]["base_failed"]
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {k for k, r in rows.items() if r["kept"]}


def test_without_labels_the_base_rules_decide(spark):
    docs, labels = quality_tables(spark)
    assert quality.fit(docs, labels.limit(0)) == []
    assert quality.fit(docs.limit(0), labels) == []
    assert quality.keep_good(docs.limit(0), labels).count() == 0
    assert quality.keep_good(docs, labels.limit(0)).count() == 600


def test_one_class_gives_no_rule():
    x = {"a": np.arange(900.0)}
    assert quality.learn(x, np.zeros(900, bool), np.arange(900)) == []
    assert quality.learn(x, np.arange(900) > 400, np.arange(900)) != []


# ---------------------------------------------------------------------------------------- personal data
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def brute_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub(r"[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


PRIVATE = [
    "mail a@b.co, c@d.e_x@f.g.h now", "é🙂 10.0.0.1 999.1.1.1 1.2.3.4.5 01.002.3.4", "card 4111 1111 1111 1111 and 4111111111111112",
    "+1 (017) 555-7713 +12 3 +49 30 1234567890123456", "@@ a@b a@b. a@b.c.", "", None, "1", "a@b.c" * 3, "+1 4111111111111111 x@1.2.3.4",
    "0" * 30000, "a" * 30000 + "@", ("1.2." * 5000) + "9", "write to bob at mail dot com", "call (555) 234-5678 or 555.234.5678", "4111-1111-1111-1111\n10.1.1.1",
]


def private_table(spark):
    rows = [(i, t, 1, "x", len(t or "")) for i, t in enumerate(PRIVATE)] + [(0, PRIVATE[0], 1, "x", len(PRIVATE[0]))]
    return spark.createDataFrame(rows, "doc_id long, text string, spans int, found string, n_chars long")


def test_base_spans_stay(spark):
    rows = pii.summary(private_table(spark)).collect()
    assert len(rows) == len(PRIVATE) + 1
    for r in rows:
        expected = brute_spans(PRIVATE[r["doc_id"]])
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(k == s[0] for s in expected) for k in PATTERNS], r["doc_id"]
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in expected)
        assert r["base_sha256"] == sha(joined)
        assert set(filter(None, joined.split(","))) <= set(r["spans"].split(","))


def test_no_python_in_the_plan(spark):
    plan = pii.summary(private_table(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "ArrowEval" not in plan


def brute_redact(text, spans):
    """The text with each listed span replaced, in order of place; one that begins inside an earlier one is passed over."""
    if text is None:
        return None
    found = [x.split(":") for x in filter(None, spans.split(","))]
    order = ("email", "ip", "card", "phone")
    out, at = [], 0
    for first, last, kind in sorted((int(a), int(b), order.index(k)) for k, a, b in found):
        if first >= at:
            out += [text[at:first], f"[{order[kind].upper()}]"]
        at = max(at, last)
    return "".join([*out, text[at:]])


def test_very_many_spans_in_one_text(spark):
    texts = ["10.0.0.1\n" * 100_000, "é a@b.co, " * 100_000, "🙂 x " * 300_000 + "+49 30 1234567, 4111 1111 1111 1111"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    began = time.monotonic()
    found = {r["doc_id"]: r for r in pii.summary(docs).collect()}
    clean = {r["doc_id"]: r["text"] for r in pii.redact(docs).collect()}
    assert time.monotonic() - began < 90
    for i, text in enumerate(texts):
        base = ",".join(f"{k}:{a}:{b}" for k, a, b in brute_spans(text))
        assert found[i]["base_sha256"] == sha(base)
        assert clean[i] == brute_redact(text, found[i]["spans"])
    assert found[0]["n_ip"] == found[1]["n_email"] == 100_000 and "[PHONE]" in clean[2]


def test_redaction(spark):
    docs = private_table(spark)
    out = pii.redact(docs)
    assert out.columns == docs.columns
    rows = {r["doc_id"]: r for r in out.collect()}
    assert rows[0]["text"] == "mail [EMAIL], [EMAIL][EMAIL] now"
    spans = {r["doc_id"]: r["spans"] for r in pii.summary(docs).collect()}
    assert all(r["text"] == brute_redact(PRIVATE[k], spans[k]) for k, r in rows.items())
    assert "10.0.0.1" not in rows[1]["text"] and "999.1.1.1" in rows[1]["text"]
    assert rows[6]["text"] is None and rows[5]["text"] == ""
    for r in rows.values():
        if r["text"]:
            assert r["n_chars"] == len(r["text"])
            assert not [s for s in brute_spans(r["text"]) if s[0] in ("email", "ip")]


def test_no_documents(spark):
    assert pii.summary(private_table(spark).limit(0)).count() == 0
    assert pii.redact(private_table(spark).limit(0)).count() == 0


def test_a_number_that_fails_the_checksum_is_no_card(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(400):
        digits = "4" + "".join(map(str, rng.integers(0, 10, 14)))
        good = next(d for d in "0123456789" if luhn(digits + d))
        last = good if i % 2 else str((int(good) + 1) % 10)
        rows.append((i, f"some words {digits}{last} and more, mail a{i}@b.com or a{i} at b dot com"))
    found = pii.summary(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    for r in found:
        assert ("card:" in r["spans"]) == bool(r["doc_id"] % 2) == bool(r["n_card"])
        assert r["spans"].count("email:") >= 1 and r["n_email"] == 1


def test_em_finds_the_better_labelers():
    rng = np.random.default_rng(1)
    counts = {}
    for _ in range(5000):
        true = rng.random() < 0.6
        votes = tuple(int((1 if rng.random() < acc else -1) * (1 if true else -1)) if rng.random() < 0.8 else 0 for acc in (0.95, 0.9, 0.85, 0.6))
        counts[votes] = counts.get(votes, 0) + 1
    probability = pii._expectation(counts)
    assert probability[(1, 1, 1, -1)] > 0.95 and probability[(-1, -1, -1, 1)] < 0.05


# ---------------------------------------------------------------------------------------- URLs
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("a.net", "/", "allow"), ("net", "/es/x", "allow"), ("Net", "/es/", "allow"), (None, None, "block")]


def brute_url(url, rules):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
    best = None
    for h, p, verdict in rules:
        h, p = (h or "").lower(), p or ""
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            rank = (len(h) + len(p), len(h), verdict == "block")
            if best is None or rank > best[0]:
                best = (rank, h + p, verdict)
    return host, path, best and best[1], best[2] if best else "allow"


def test_urls_by_the_longest_rule(spark):
    urls = [None, "", "x", "http://", "http://WWW.Example.com/en/a?x#y", "https://m.example.com/en/b", "http://example.com/fr", "ftp://com", "http://com/",
            "http://b.a.net/es/x", "http://net/es/xy", "http://badexample.com/en/", "a://b://c/d", "http://x.net/es/?q", "http://a.b.com./", "http://..com/é\n?z"]
    rows = [(i % 7 if i % 5 else None, u, "h", "r") for i, u in enumerate(urls * 30)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    found = sorted(tuple(map(str, r)) for r in url_filter.judge_urls(pages, rules).collect())
    expected = sorted(tuple(map(str, (i, *brute_url(u, RULES)))) for i, u, _, _ in rows)
    assert found == expected
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0
    assert {r["verdict"] for r in url_filter.judge_urls(pages, rules.limit(0), default="block").collect()} == {"block"}


def test_many_rules_and_one_hot_host(spark):
    rng = np.random.default_rng(2)
    hosts = [".".join(rng.choice(["a", "b", "cc", "com", "net"], rng.integers(1, 5))) for _ in range(300)]
    rules = [(h, "/" + "/".join(rng.choice(["x", "y"], rng.integers(0, 3))), str(rng.choice(["allow", "block"]))) for h in hosts]
    urls = [(i, f"http://{rng.choice(hosts)}/x/y/{rng.choice(['x', 'y'])}") for i in range(600)] + [(i, "http://a.b.com/x/") for i in range(900)]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    frame = spark.createDataFrame(rules, "host string, path string, verdict string")
    found = sorted(tuple(map(str, r)) for r in url_filter.judge_urls(pages, frame).collect())
    assert found == sorted(tuple(map(str, (i, *brute_url(u, rules)))) for i, u in urls)
