"""Operators that read one text at a time, against plain Python."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablemint.llm import classifier, html, packing, pii, rules, urls
from tablemint.llm.queries import ORACLES, QUERIES
from tests.oracle import _rows, duck

SMALL = "/root/testdata/sf0.001"
TEXTS = [None, "", " \t\n", "one", "a b c a b c", "x" * 50_000, "Ünï cødé \U0001f600 wörds"]


def docs_of(spark, texts, extra=True):
    """Documents with clashing extra columns; every text comes twice."""
    rows = [(i, t, "en" if i % 3 else None, None if i % 5 == 0 else "s", 1, "x", 0.5) for i, t in enumerate(texts)]
    return spark.createDataFrame(
        rows + rows, "doc_id long, text string, lang string, source string, n_chars long, kept string, score double"
    )


def test_every_operator_has_a_query():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{n}" for n in range(1, 14)}


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_agrees_with_sql(spark, name):
    df = QUERIES[name](spark, SMALL)
    got = _rows(df.columns, df.collect())
    result = duck(SMALL).execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert got and got == _rows(columns, result.fetchall())


# --- personal data ---------------------------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(int(p) <= 255 for p in hit.split("."))
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "card":
        total = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits)))
        return 12 <= len(digits) <= 19 and total % 10 == 0
    return True


def plain_spans(text):
    found = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            if valid(kind, m[0]):
                found.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x[2] for x in sorted(found))


FRAGMENTS = [
    "a@b.co", "x.y+z@mail-1.example.com_", "@", "1.2.3.4", "256.1.1.1", "001.2.3.0004", "4111 1111 1111 1111",
    "4111-1111-1111-1111", "41111111111111111234567", "+1 (499) 555-6503", "+49.30.1234567", "+", "5", "é",
    "\U0001f600", " ", "-", ".", "_", "%", "12 34 56 78 90 12 3", "079927398713", "x", "\n", "++1 2 3 4 5 6 7 8 9)",
    "a@b.cx@d.e", "1--2", "1- 2",
]


def test_base_spans_match_plain_patterns(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice(FRAGMENTS) for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    texts += [*TEXTS, "1" * 100_000, "a" * 100_000, "@" * 50_000]
    found = pii.with_spans(docs_of(spark, texts)).select(
        "doc_id", pii.spans_text(F.filter("pii", lambda s: s.kind < 4)).alias("spans")
    )
    got = {r.doc_id: r.spans for r in found.collect()}
    for i, text in enumerate(texts):
        # The plain patterns take quadratic time on endless runs, which hold no valid span.
        assert got[i] == ("" if len(text or "") > 40_000 else plain_spans(text)), text


def test_checksums_context_and_redaction(spark):
    texts = [
        "iban GB82 WEST 1234 5698 7654 32 ok", "GB82WEST12345698765433", "ssn 123-45-6789", "123-45-6789",
        "mail a@b.co, call +1 (499) 555-6503.", None,
    ]
    rows = {r.doc_id: r for r in pii.redact(pii.with_spans(docs_of(spark, texts))).collect()}
    assert rows[0].text == "iban [IBAN] ok" and rows[1].text == texts[1]
    assert rows[2].text == "ssn [NATIONAL_ID]" and rows[3].text == texts[3]
    assert rows[4].text == "mail [EMAIL], call [PHONE]." and rows[5].text is None


def test_pii_query_digest(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = QUERIES["op1_pii"](spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.base_sha256 == hashlib.sha256(plain_spans(texts[r.doc_id]).encode()).hexdigest()


def test_pii_runs_no_python(spark):
    plan = QUERIES["op1_pii"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- quality rules ---------------------------------------------------------------------------------


def plain_measures(text):
    text = text or ""
    space = " \t\n\v\f\r"
    tokens = [t for t in re.split("[\x20\x09-\x0d]+", text) if t]
    windows = [tuple(tokens[i : i + 3]) for i in range(len(tokens) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if x.strip(space)]
    return (
        len(tokens), sum(map(len, tokens)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)
    )


def test_measures_match_plain_counts():
    rng = random.Random(5)
    for text in [*TEXTS, *(" ".join(rng.choice("a b #c \n d| é".split(" ")) for _ in range(60)) for _ in range(100))]:
        assert rules.measure_text(text)[:5] == plain_measures(text)


def test_votes_learn_which_rules_to_trust():
    # Rule 0 is right, rule 1 votes at random, rule 2 abstains on half of the texts.
    rng = random.Random(2)
    counts, truth = {}, {}
    for _ in range(4000):
        good = rng.random() < 0.8
        p = ("+" if good else "-") + rng.choice("++-") + ("0" if rng.random() < 0.5 else "+" if good else "-")
        counts[p] = counts.get(p, 0) + 1
        truth.setdefault(p, []).append(good)
    model = rules.fit_votes(counts, 3)
    for p, found in truth.items():
        assert (model.posterior(p) > 0.5) == (sum(found) > len(found) / 2)
    assert rules.fit_votes({}, 3).posterior("000") == pytest.approx(0.9)


def test_filter_keeps_columns_and_clean_texts(spark):
    rng = random.Random(1)
    names = [f"word{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(20)]
    clean = [" ".join(rng.sample(names, 80)) + "." for _ in range(60)]
    bad = [" ".join(f"{w.upper()}!!***" for w in rng.sample(names, 80)) for _ in range(20)]
    docs = docs_of(spark, clean + bad + TEXTS)
    kept = rules.filter_quality(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted([*range(60)] * 2)
    assert rules.filter_quality(docs.limit(0)).count() == 0


# --- urls ------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "url, rule, verdict",
    [
        ("https://www.example.com/en/1", "www.example.com/en/", "allow"),
        ("https://a.www.EXAMPLE.com/en/", "www.example.com/en/", "allow"),
        ("https://blog.example.com/en/1", "example.com/en/", "block"),
        ("https://example.com/english", "com/", "allow"),
        ("https://notexample.com/en/1", "com/", "allow"),
        ("http://a.net/fr/x", "net/fr/", "block"), ("http://a.net/it/x", None, "allow"),
        ("http://a.com", None, "allow"), ("a.com/en/", None, "allow"), (None, None, "allow"), ("", None, "allow"),
        ("x://y://a.net/es/", None, "allow"), ("http://com/", "com/", "allow"),
    ],
)
def test_longest_entry_wins(url, rule, verdict):
    rest = url.partition("://")[2] if url else ""
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    found = urls.match(urls.build_trie(urls.LIST), host.lower(), path) or (None, "allow")
    assert found == (rule, verdict)


def test_partial_segments_and_limits():
    root = urls.build_trie([urls.Entry("block", "a.b", "/x/ab"), urls.Entry("allow", "b", "/x/abcd/")])
    assert urls.match(root, "q.a.b", "/x/abc")[1] == "block" and urls.match(root, "z.b", "/x/abcd/e")[1] == "allow"
    assert urls.match(root, "z.b", "/x/abc") is None
    with pytest.raises(ValueError):
        urls.build_trie([urls.Entry("block", "a")] * (urls.MAX_ENTRIES + 1))


# --- pages -----------------------------------------------------------------------------------------

BODY = "<h1>Head &amp; line</h1><p>First  <b>bold</b>\n text that is long enough to win.<p>Second &lt;one&gt; here.<br>Third."
WANT = "Head & line\nFirst bold text that is long enough to win.\nSecond <one> here.\nThird."


@pytest.mark.parametrize(
    "page, want",
    [
        (f"<html><head><title>t</title></head><body><nav><a href=/>Menu</a></nav><article>{BODY}</article><footer>f</footer>", WANT),
        (f"<body><div class='sidebar'>side</div><div id=main class=post-12>{BODY}</div><div class='comments'><p>nice!</div>", WANT),
        (f"<body><main>{BODY}<form><input>x</form><script>var a='</p>'</script><!-- c --><aside>z</aside></main>", WANT),
        (None, ""), ("", ""), ("no tags at all", "no tags at all"), ("<p>open <", "open <"), ("<script>x", ""),
    ],
)
def test_page_text(page, want):
    assert html.extract(page, None) == want


def test_hosts_vote(spark):
    long = "text " * 50
    pages = [(i, f"http://h.org/{i}", f"<body><div class=story-{i}><p>{long}{i}</div><div class=x><p>short</div>") for i in range(9)]
    # One page whose story is short follows the consensus of its host.
    pages += [(9, "http://h.org/9", f"<body><div class=story-9><p>brief</div><div class=x><p>{long}</div>"), (10, None, None)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("path", F.lit("clash"))
    got = {r.page_id: r.text for r in html.extract_pages(df).collect()}
    assert got[9] == "brief" and got[3] == (long + "3").strip() and got[10] == ""
    assert html.extract_pages(df.limit(0)).count() == 0


PROSE = "<p>" + "some plain words of a story " * 20 + "</p>"


@pytest.mark.parametrize(
    "page",
    [
        "<article><h1>Title</h1><div class=lead><p>Lead</div><div class=body>%s</div><p>End</article>",
        "<main><h1>Title</h1><p>Lead<article><div>%s</div></article><p>End</main>",
        "<div class=page><h1>Title</h1><div><p>Lead<div class=body>%s</div></div><p>End</div><div class=x><p>short</div>",
        "<h1>Title</h1><p>Lead<div class=body>%s</div><p>End",
    ],
)
def test_title_and_lead_around_an_inner_container(page):
    menu = "<nav><a href=/>Menu</a></nav>"
    source = f"<body>{menu}{page % (PROSE * 3)}<ul class=related><li><a href=/>More</a></ul>"
    path = html.parse_page(source).containers[html.content_root(html.parse_page(source))].path
    for winner in (None, path):
        got = html.extract(source, winner).split("\n")
        assert got[:2] == ["Title", "Lead"] and got[-1] == "End" and len(got) == 6


def test_links_around_the_article_stay_out():
    source = f"<body><div class=page><div class=story>{PROSE * 3}</div><ul><li><a href=/>Another page to read</a></ul></div>"
    assert "Another" not in html.extract(source, None)


def test_teaser_on_the_path_of_the_host():
    source = f"<body><div class=story><p>Teaser</div><article><h1>Title</h1>{PROSE * 3}</article>"
    assert html.extract(source, "/body/div.story").startswith("Title\n")


def test_own_articles_are_not_hidden_by_the_path_of_the_host(spark):
    teaser = "<div class=story><p>" + "teaser text " * 25 + "</div>"
    own = f"<article><h1>Own</h1>{PROSE * 3}</article>"
    pages = [(i, f"http://h.org/{i}", f"<body><div class=story>{PROSE}<p>number {i}</div>") for i in range(5)]
    pages += [(5, "http://h.org/5", f"<body>{teaser}{own}"), (6, "http://h.org/6", f"<body>{teaser}<div class=essay><h1>Own</h1>{PROSE * 3}</div>")]
    df = spark.createDataFrame(pages + pages, "page_id long, url string, html string")
    got = {}
    for r in html.extract_pages(df).collect():
        assert got.setdefault(r.page_id, r.text) == r.text
    text = "some plain words of a story " * 20
    assert got[5] == "\n".join(["Own"] + [text.strip()] * 3)
    assert got[6] == "\n".join([("teaser text " * 25).strip(), "Own"] + [text.strip()] * 3)
    assert got[3] == f"{text.strip()}\nnumber 3"


@pytest.mark.parametrize(
    "part, stays",
    [
        ("<div class=social-history><p>Kept words</div>", True),
        ("<section class='related work'><h2>Kept words</h2></section>", True),
        ("<ul class=related><li><a href=/>Gone</a><li><a href=/>Gone too</a></ul>", False),
        ("<div class='share'><a href=/>Gone</a></div>", False),
        ("<div class=cookie-recipe><p>Kept words</div>", True),
        ("<div class=cookie-notice>Gone</div>", False),
        ("<div class='ad2 wide'>Gone</div>", False),
        ("<div id=comments><p>Gone</div>", False),
        ("<div class=menu-history><p>Kept words, <a href=/>one</a> linked among many plain ones</div>", True),
        ("<p class=legal>Kept words</p>", True),
        ("<aside>Gone</aside>", False), ("<footer>Gone</footer>", False), ("<div role=search>Gone</div>", False),
        ("<header><h2>Kept words</h2><p>Gone</p></header>", None),
    ],
)
def test_parts_of_an_article(part, stays):
    got = html.extract(f"<body><header><h1>Site</h1></header><article><h1>Title</h1>{PROSE * 3}{part}<p>End</article>", None)
    assert got.startswith("Title\n") and got.endswith("\nEnd") and "Site" not in got
    assert ("Kept words" in got) == (stays is not False)
    assert "Gone" not in got


def test_generated_pages_give_their_own_blocks():
    """Pages built from parts of known standing; the expected text is what the article parts hold."""
    rng = random.Random(12)
    words = lambda n: " ".join(rng.choice(["plain", "words", "&amp;", "r&eacute;al", "<i>small</i>", "1 &lt; 2"]) for _ in range(n))
    shown = lambda t: " ".join(re.sub("<.*?>", "", t).replace("&amp;", "&").replace("&eacute;", "é").replace("&lt;", "<").split())
    for _ in range(60):
        blocks, parts = [], []
        for _ in range(rng.randint(3, 8)):
            t = words(rng.randint(5, 60))
            blocks.append(shown(t))
            wrap = rng.choice(["<p>{}</p>", "<p>{}", "<div class=x{}>%s</div>", "<ul><li>{}</ul>", "<blockquote><p>{}</p></blockquote>", "<section><h2>{}</h2></section>"])
            parts.append(wrap % t if "%s" in wrap else wrap.format(t))
            if rng.random() < 0.4:
                parts.append(rng.choice(["<script>x</script>", "<!-- c -->", "<div class=ad>buy</div>", "<form>f</form>", "<style>p{}</style>", "<nav>n</nav>"]))
        page = f"<body><nav>m</nav><div class=top-menu>x</div><article>{''.join(parts)}</article><div class=comments>{words(40)}</div><footer>f</footer>"
        assert html.extract(page, None) == "\n".join(blocks)


def test_deep_and_hostile_pages_take_linear_time():
    import time

    def seconds(page):
        start = time.perf_counter()
        html.votes_of(page), html.extract(page, "/body/div")
        return time.perf_counter() - start

    n = 20_000
    for page in (
        "<div>" * n + "<p>deep text" + "</div>" * n, "<div class=a><p>x" * n, "<b>" * n + "<p>x</b></i>" * n, "<b>" * n + "<h1>x</h1>" * n,
        "<div>" + "<ul class=related><li>x" * n, "<p>" + "</div>" * n, "<a href=x>" * n + "text " * n,
    ):
        assert seconds(page) < 8
    assert html.extract("<article>" + "<div>" * 50_000 + "deep text", None) == "deep text"
    assert html.extract("<article><p>" + "long text " * 500_000, None) == ("long text " * 500_000).strip()


def test_pages_keep_columns_of_any_name(spark):
    df = spark.createDataFrame(
        [(1, f"http://h.org/{i}", f"<article><p>text {i}</article>", "a", "b", "c", "d") for i in range(3)],
        "page_id long, url string, html string, _host string, _salt string, winner string, text string",
    )
    got = html.extract_pages(df).collect()
    assert sorted((r.page_id, r._host, r._salt, r.winner, r.text) for r in got) == [(1, "a", "b", "c", f"text {i}") for i in range(3)]


# --- packing ---------------------------------------------------------------------------------------


def test_word_ids_equal_whole_text_ids():
    encode = packing.WordTokenizer(packing.default_tokenizer())
    texts = [
        "Hello WORLD's it's. don't!?", 'a.b. «x». É́cole 12,3.; "q". x*.', "<|endoftext|> <|ENDOFTEXT|>.", "ß! ΑΣ. İstanbul",
        " a b.\x1cc", "", None, "..., !!", "日本語。テスト, abc", "1.2.3. 4th.", "x" * 3000,
    ]
    for text, got in zip(texts, encode(texts)):
        want = encode.tokenizer.encode(text or "", add_special_tokens=False).ids
        assert list(np.frombuffer(got, "<u4")) == want, text


def test_pieces_fill_sequences_without_gaps(spark):
    texts = [*TEXTS, "word " * 9000, *("tok " * n for n in range(1, 900, 7))]
    docs = docs_of(spark, texts)
    rows = packing.pack(packing.cut_pieces(docs, packing.default_tokenizer()), group_pieces=60).collect()
    encode = packing.WordTokenizer(packing.default_tokenizer())
    ids = {i: raw + b"\1\0\0\0" for i, raw in enumerate(encode(texts))}
    bins = {}
    for r in rows:
        part = ids[r.doc_id][4 * r.start : 4 * (r.start + r.length)]
        assert r.start == 4096 * r.piece and r.ids_crc32 == zlib.crc32(part)
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sum(r.length for r in rows) == 2 * sum(len(v) // 4 for v in ids.values())
    for members in bins.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(bins) <= 1.1 * sum(r.length for r in rows) / 4096 + 1
    assert packing.pack(packing.cut_pieces(docs.limit(0), packing.default_tokenizer())).count() == 0


def test_groups_stay_small_when_lengths_do_not_combine(spark):
    rows = [(i, 0, 0, 2100 + i % 1900, 0, i) for i in range(600)]
    placed = packing.pack(spark.createDataFrame(rows, packing.PIECES), group_pieces=50).collect()
    assert sorted(r.doc_id for r in placed) == list(range(600))
    assert len({r.sequence_id for r in placed}) == 600
    groups = {}
    for r in placed:
        groups[r.sequence_id >> 24] = groups.get(r.sequence_id >> 24, 0) + 1
    assert len(groups) >= 12 and max(groups.values()) <= 100


def test_local_search_empties_a_bin():
    lengths = [6, 4, 7, 3, 5, 5]
    loose = [[0, 3], [1, 4], [2], [5]]
    bins = packing.local_search(loose, lengths, 10)
    assert len(bins) == 3 and sorted(i for b in bins for i in b) == [0, 1, 2, 3, 4, 5]
    assert all(sum(lengths[i] for i in b) <= 10 for b in bins)


# --- classifier ------------------------------------------------------------------------------------


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    scored = QUERIES["op3_quality_classifier"](spark, folder)
    rows = scored.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_ranking_without_two_classes():
    model = classifier.fit_ranking(np.ones((3, classifier.N_FEATURES)), np.array([True] * 3))
    assert list(model.score(np.zeros((1, classifier.N_FEATURES)))) == [pytest.approx(0.7)]
    assert all(len(classifier.text_features(t)) == classifier.N_FEATURES for t in TEXTS)
