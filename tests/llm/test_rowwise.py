"""URL filters, main text, decontamination and quality grades: odd rows, and brute force."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from modlens.llm import decontaminate, main_text, quality, queries, url_filter
from modlens.llm.url_filter import Rule

SF = "/root/testdata/sf0.001"


def judged_by_hand(url, rules):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    upper = str.maketrans(url_filter.UPPER, url_filter.LOWER)
    host, path = (m[1].translate(upper), m[2]) if m else ("", "")
    site, pattern = [], []
    for r in rules:
        if r.site:
            name, _, rest = r.text.partition("/")
            rest = r.text[len(name) :]
            if host and (host == name or host.endswith("." + name)) and path.startswith(rest):
                site.append((len(r.text), r.text, r.action))
        else:
            flat = "".join(".*" if p == "*" else "(?:^|$|[^a-z0-9])" if p == "^" else re.escape(p) for p in re.split(r"([*^])", r.text))
            if url is not None and re.search(flat, url.translate(upper)):
                pattern.append((len(r.text), r.text, r.action))
    best, also = max(site, default=None), max(pattern, default=None)
    return host, path, best and best[1], (best or also or (0, "", "allow"))[2], also and also[1]


def test_urls_against_every_rule(spark):
    rng = random.Random(2)
    rules = [*queries.RULES, Rule("b.example.org/x", "block"), Rule("org/", "allow"), Rule("ads", "block", site=False), Rule("/t*k/", "block", site=False)]
    hosts = ["net", "a.net", "Example.NET", "m.example.net", "notexample.net", "example.com", "x.Example.com:80", "org", "b.example.org", "", "münchen.org", "casino.example.net"]
    paths = ["", "/", "/en/", "/en", "/de/1", "/fr/x?y#z", "?q=/en/", "#/de/", "/casino/", "/x/adserver", "/track/1", "/free-bets", "/x//y://z"]
    urls = [f"{rng.choice(['http', 'HTTPS', ''])}://{h}{p}" for h in hosts for p in paths] + [None, "", "no scheme", "net/", "a\nb://net/\n", "x://y://net/"]
    urls += urls[:20] * 3
    df = spark.createDataFrame([(i, u, "h", 1) for i, u in enumerate(urls)], "page_id int, url string, host string, rule int")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"], r["pattern"]) for r in url_filter.judge_urls(df, rules).collect()}
    assert got == {i: judged_by_hand(u, rules) for i, u in enumerate(urls)}
    assert url_filter.judge_urls(df.limit(0), rules).count() == 0
    assert {r["verdict"] for r in url_filter.judge_urls(df, []).collect()} == {"allow"}


def test_rules_of_the_contract(spark, tmp_path):
    urls = ["http://a.net/x", "http://x.example.net/en/1", "http://example.net/de/", "https://m.example.com/de/", "http://b.org/fr/casino/", "http://b.org/en/", None]
    spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in queries.op1_url_filters(spark, str(tmp_path)).collect()}
    assert [got[i] for i in range(len(urls))] == [
        ("net/", "block"), ("example.net/en/", "allow"), ("net/", "block"), ("example.com/de/", "block"), ("org/fr/", "allow"), (None, "allow"), (None, "allow"),
    ]


def test_needed_tokens():
    assert url_filter.needed_tokens(Rule("example.net/en/", "allow")) == ["en", "example", "net"]
    assert url_filter.needed_tokens(Rule("example.net/en", "allow")) == ["example", "net"]
    assert url_filter.needed_tokens(Rule("^ads-track^", "block", False)) == ["ads", "track"]
    assert url_filter.needed_tokens(Rule("ads-track", "block", False)) == []


PAGE = """<html><head><title>No</title><style>p{}</style></head><body><header><p>Header, text</p></header>
<nav><ul><li><a href=x>One</a></li></ul></nav><div class="cookie-notice"><p>We use cookies, and so on, and so on.</p></div>
<div class="layout"><div class='post-body'><h1>A &amp; B</h1><p>First, a paragraph   with
 white&nbsp;space, commas, and length.<p>Second <b>bold<br>text, unclosed.<ul><li>item &#233;</li></ul><form><p>form</p></form>
<aside>side</aside><div class="advert">buy</div><script>var x = "<p>no</p>";</script><!-- <p>no</p> --></div>
<div id="comments"><p>Reader, says, many, things, here, with, commas.</p></div></div><footer>&copy; me</footer></body></html>"""


def test_main_text_of_a_page():
    assert main_text.main_text(PAGE) == "A & B\n\nFirst, a paragraph with white space, commas, and length.\n\nSecond bold text, unclosed.\n\nitem é"


def test_main_text_of_odd_pages(spark):
    pages = [None, "", "plain text only", "<p>", "<a href=x>link</a>", "<" * 50, "<div>" * 5000 + "deep text, here" + "</div>" * 5000, "<p>x" * 20000, PAGE, PAGE]
    df = spark.createDataFrame([(i, h, 1) for i, h in enumerate(pages)], "page_id int, html string, text int")
    got = {r["page_id"]: r["text"] for r in main_text.extract_main_text(df).collect()}
    assert got[0] == got[1] == got[3] == "" and got[2] == "plain text only" and got[8] == got[9] == main_text.main_text(PAGE)
    assert got[6] == "deep text, here" and got[7].count("x") == 20000
    assert main_text.extract_main_text(df.limit(0)).count() == 0


def test_main_text_of_the_sample_pages(spark):
    import html

    for r in queries.op9_html_extraction(spark, SF).join(spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html"), "page_id").collect():
        article = re.search(r"(?s)<article>(.*)</article>", r["html"])[1]
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", " ", b))).strip() for b in re.split(r"</?(?:p|h1)>", article)]
        assert r["text"] == "\n\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


def hits_by_hand(text, items, window=13):
    def split(t):
        low = "".join(c.lower() if c.isascii() else c for c in t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    words = split(text)
    hit, found = set(), set()
    for item, t in items:
        w = split(t)
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            for p in range(len(words) - size + 1):
                if words[p : p + size] == w[i : i + size]:
                    hit.update(range(p, p + size))
                    found.add("null" if item is None else str(item))
    return len(words), len(hit), sorted(found)


def longest_by_hand(text, items, window=13):
    """The longest run of words that begins with a window and stands in one item."""
    w = [x.decode() for x in decontaminate.words(text)]
    split = [[x.decode() for x in decontaminate.words(t)] for _, t in items]
    most = 0
    windows = {tuple(x[i : i + min(window, len(x))]) for x in split if x for i in range(len(x) - min(window, len(x)) + 1)}
    for p in range(len(w)):
        if any(tuple(w[p : p + len(k)]) == k for k in windows):
            for x in split:
                for q in range(len(x)):
                    n = 0
                    while p + n < len(w) and q + n < len(x) and w[p + n] == x[q + n]:
                        n += 1
                    most = max(most, n)
    return most


def test_longest_match_is_followed_in_every_item():
    tests = decontaminate.TestSuffixes([("a", "w1 w2 w3 zz"), ("b", "w1 w2 w3 w4 w5 w6"), ("c", "w3 w4")], 3)
    text = np.array([tests.number[f"w{i}".encode()] for i in range(1, 7)])
    window, place = tests.matches(text)
    size, there = tests.extended(text, window, place)
    found = sorted(zip(place.tolist(), size.tolist(), strict=True))
    assert found == [(0, 6), (1, 5), (2, 4), (2, 4), (3, 3)]
    rng = np.random.default_rng(3)
    for _ in range(200):
        flat = rng.integers(0, 3, rng.integers(1, 40))
        order = decontaminate.suffix_order(flat)
        ends = [next((j for j in range(i, len(flat)) if flat[j] == 0), len(flat)) for i in range(len(flat))]
        suffixes = [tuple(flat[i : ends[i]]) for i in order.tolist()]
        assert suffixes == sorted(suffixes) and len(order) == (flat > 0).sum()


@pytest.mark.parametrize("block_chars", [10**9, 60])
def test_contamination_against_brute_force(spark, block_chars):
    rng = random.Random(9)
    vocabulary = ["a", "b", "é", "Ça", "x1", "the"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 12, 13, 14, 30])))) for i in range(8)]
    items += [(None, "one two three"), (11, None), (12, "..."), (13, items[5][1]), (13, items[5][1])]
    docs = [None, "", "...", "one, two; THREE!"]
    for _ in range(120):
        w = [rng.choice([*vocabulary, "zz"]) for _ in range(rng.randint(0, 40))]
        if rng.random() < 0.6:
            w[len(w) // 2 : 0] = (rng.choice(items)[1] or "").split()
        docs.append(rng.choice([" ", ", "]).join(w))
    docs += docs[5:9]
    df = spark.createDataFrame([(i, t, "m") for i, t in enumerate(docs)], "doc_id int, text string, items string").repartition(3)
    tests = spark.createDataFrame(items, "item_id int, text string")
    got = {r["doc_id"]: r for r in decontaminate.find_contamination(df, tests, block_chars=block_chars).collect()}
    for i, t in enumerate(docs):
        assert (got[i]["n_words"], got[i]["n_hit"], got[i]["items"]) == hits_by_hand(t, items), t
        assert (got[i]["longest"] is None) == (got[i]["n_hit"] == 0)
        if block_chars > 60:
            assert (got[i]["longest"]["size"] if got[i]["longest"] else 0) == longest_by_hand(t, items)
        if got[i]["longest"]:
            m, w = got[i]["longest"], decontaminate.words(t)
            texts = [decontaminate.words(x) for k, x in items if (m["item"] == "null") == (k is None) and (k is None or str(k) == m["item"])]
            assert any(w[m["start"] : m["start"] + m["size"]] == x[m["item_start"] : m["item_start"] + m["size"]] for x in texts)
    assert decontaminate.find_contamination(df.limit(0), tests).count() == 0
    assert {r["n_hit"] for r in decontaminate.find_contamination(df, tests.limit(0)).collect()} == {0}


def test_suffix_array_is_sorted():
    tests = decontaminate.TestSuffixes([("a", "x y z x y"), ("b", "y z")], 13)
    rng = np.random.default_rng(1)
    text = rng.integers(0, 4, 500)
    at, _ = tests.suffixes(text)
    depth = tests.depth * tests.per_key
    padded = np.concatenate([text, np.zeros(depth, int)])
    tuples = [tuple(padded[i : i + depth]) for i in at]
    assert tuples == sorted(tuples) and len(at) == sum((text[i : i + 2] > 0).all() and i + 1 < len(text) for i in range(len(text)))


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    held_out = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(4)) == 0
    model = quality.train(docs, labels.where(~held_out), F.expr(queries.GRADE), 3)
    assert (np.diff(model.thresholds) > 0).all()
    rows = quality.grade_documents(docs.join(labels.where(held_out), "doc_id").withColumn("grade", F.expr(queries.GRADE)), model).collect()
    kept = {g: [r["tails"][1] >= queries.KEEP_FROM for r in rows if r["grade"] == g] for g in (0, 1, 2)}
    assert np.mean(kept[2]) > 0.97 and np.mean(kept[0]) < 0.45 and np.mean(kept[1]) < 0.6
    for r in rows[:50]:
        assert 0 <= r["tails"][1] <= r["tails"][0] <= 1 and abs(r["expected_grade"] - sum(r["tails"])) < 1e-9


def test_quality_of_odd_rows(spark):
    model = quality.train(spark.createDataFrame([], "doc_id int, text string"), spark.createDataFrame([], "doc_id int, toxic int, quality int"), F.expr(queries.GRADE), 3)
    df = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, "w " * 50000, 5), (3, "w " * 50000, 5)], "doc_id int, text string, score int")
    rows = quality.grade_documents(df, model).collect()
    assert [r["score"] for r in rows] == [0.0] * 4 and rows[0].asDict().keys() == {"doc_id", "text", "score", "expected_grade", "tails"}
    assert quality.grade_documents(df.limit(0), model).count() == 0


def test_likelihood_falls():
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(600):
        g = int(rng.integers(0, 3))
        rows.append((np.unique(np.concatenate([rng.integers(10, 60, 8), [g]])), g))
    model = quality.fit(rows, 3)
    tails = model.tails(np.array([model.score(s) for s, _ in rows]))
    assert np.mean((tails >= 0.5).sum(axis=1) == [g for _, g in rows]) > 0.95


@pytest.mark.parametrize(
    "attributes",
    ['style="overflow:hidden"', 'class="overflow-hidden"', 'data-x="hidden one"', 'title="The hidden world"', "hidden=false", 'data-hidden="1"', 'style="x-display:none"', 'title="display:none"', 'title="a > b hidden"'],
)
def test_main_text_of_elements_that_are_shown(attributes):
    page = f"<body><div {attributes}><article {attributes}><p>One text, that is read, by many.</p></article></div></body>"
    assert main_text.main_text(page) == "One text, that is read, by many."


@pytest.mark.parametrize(
    "attributes", ["hidden", 'hidden=""', "HIDDEN=until-found", 'style="color:red; display : none"', 'style="display:none!important"', "style=display:none", "aria-hidden=true", "aria-hidden='TRUE'"]
)
def test_main_text_of_elements_that_are_hidden(attributes):
    page = f"<body><article><p>One text, that is read, by many.</p><div {attributes}><p>No, no, no, no.</p></div></article></body>"
    assert main_text.main_text(page) == "One text, that is read, by many."


@pytest.mark.parametrize(
    "before",
    ["<head><title>No</title><meta charset=x><link href=y><body>", "<head><title>No</title><style>p{}</style>", "<head><title>No", "<head><script>var x = '<p>';</script></head><body>",
     "<head><style>p{}<body>", "<body><script>var x;", "<body><svg><path d=x>", "<body><svg/>", "<body><noscript>", "<body><template>", "<body><select><option><option>", "<body><iframe src=x>", "<body><textarea>"],
)
def test_main_text_after_elements_without_end(before):
    page = f"<html>{before}<article><h1>A head</h1><p>One text, that is read, by many.</p></article></html>"
    assert main_text.main_text(page) == "A head\n\nOne text, that is read, by many."


ARTICLE = "".join(f"<p>Paragraph {i} of the story, which has some length, a few commas, and an end.</p>" for i in range(4))
ARTICLE_TEXT = "\n\n".join(f"Paragraph {i} of the story, which has some length, a few commas, and an end." for i in range(4))


@pytest.mark.parametrize(
    "names",
    ["content has-sidebar", "no-sidebar", "layout-with-sidebar", "post comments-open", "page-with-header", "entry share-enabled", "article-body nav-open",
     "search-result article", "with-cookies", "menu-hidden", "ads-disabled story"],
)
@pytest.mark.parametrize("kind", ["class", "id"])
def test_main_text_in_layouts_named_after_their_parts(names, kind):
    page = f"<body><div {kind}='{names}'><div>{ARTICLE}</div><div class=sidebar><p>Other, things, to, read, here.</p></div></div><div class=footer-links><p>About, us.</p></div></body>"
    assert main_text.main_text(page) == ARTICLE_TEXT


@pytest.mark.parametrize("names", ["sidebar", "site-footer", "comment-list", "comments", "cookie-banner", "main-nav", "post-comments", "related-box", "share-buttons", "page has-newsletter", "x-popup-y"])
def test_main_text_without_other_parts(names):
    page = f"<body><div>{ARTICLE}<div class='{names}'><p>Many, words, that, are, not, of, the, story.</p></div></div></body>"
    assert main_text.main_text(page) == ARTICLE_TEXT


def test_main_text_without_more_comments_than_article():
    comments = "<p>I think, as a reader, that this, and that, is so, and so on, and so forth.</p>" * 50
    assert main_text.main_text(f"<body><div class=post>{ARTICLE}</div><div id=comments>{comments}</div></body>") == ARTICLE_TEXT


@pytest.mark.parametrize("attributes", ["hidden", "style='display:none'", "class=advert", "class='x ad-slot'", "aria-hidden=true"])
@pytest.mark.parametrize("tag", ["span", "a", "b"])
def test_main_text_without_hidden_inline_parts(attributes, tag):
    page = f"<body><article><p>One text, <{tag} {attributes}>no <{tag}>no</{tag}> <i>no</i></{tag}>that is read, by many.</p><p>Then <{tag} {attributes}>not closed</p>{ARTICLE}</article></body>"
    assert main_text.main_text(page) == f"One text, that is read, by many.\n\nThen\n\n{ARTICLE_TEXT}"


def test_main_text_of_an_article_with_a_header_of_its_own():
    page = f"<body><header><h1>Site</h1></header><article><header><h1>Title</h1><p>by someone, on a day</p></header>{ARTICLE}</article></body>"
    assert main_text.main_text(page) == f"Title\n\n{ARTICLE_TEXT}"


@pytest.mark.parametrize(
    "broken", ['<p class="x ', "<a ", "<!x ", '<a ">" ', "<p class='", "<", "</section>", "<div>x", "<div>", "<script ", "<span hidden>x", '<p title="a>b', "<!--", "&#", "<li>a, b"]
)
def test_main_text_of_broken_pages_takes_linear_time(broken):
    import time

    start = time.perf_counter()
    main_text.main_text(broken * (1_000_000 // len(broken)))
    main_text.main_text("<div>" * 20_000 + "<article><p>One, two.</p>" + broken * (100_000 // len(broken)) + ">" + "</section>" * 20_000)
    assert time.perf_counter() - start < 12


def scored_by_hand(tree):
    """The scoring written once more, on a tree of (tag, children or text): the paragraphs of the best container."""
    found = {}

    def walk(node, above):
        tag, inner = node
        if isinstance(inner, str):
            points = 1 + inner.count(",") + min(len(inner) / 100, 3) if len(inner) > 1 else 0
            for share, at in zip((1, 2, 4), reversed(above), strict=False):
                found[at] = found.get(at, 0) + points / share
            return
        for child in inner:
            walk(child, [*above, id(node)])

    walk(tree, [])
    order = []

    def nodes(node):
        order.append(node)
        if not isinstance(node[1], str):
            for child in node[1]:
                nodes(child)

    nodes(tree)
    best = max((n for n in order if not isinstance(n[1], str)), key=lambda n: found.get(id(n), 0) and found[id(n)] + {"section": 3}.get(n[0], 0))
    value = lambda n: found.get(id(n), 0) and found[id(n)] + {"section": 3}.get(n[0], 0)
    parent = next((n for n in order if not isinstance(n[1], str) and any(c is best for c in n[1])), None)
    kept = []

    def texts(node):
        return [node[1]] if isinstance(node[1], str) else [t for c in node[1] for t in texts(c)]

    if parent is None:
        return texts(best)
    for child in parent[1]:
        if child is best:
            kept += texts(child)
        elif isinstance(child[1], str):
            if len(child[1]) > 80 or child[1][-1:] in ".!?":
                kept += texts(child)
        elif value(child) >= max(10, 0.2 * value(best)):
            kept += texts(child)
    return kept


def test_main_text_of_random_trees():
    rng = random.Random(12)

    def tree(depth):
        if depth == 0 or rng.random() < 0.4:
            return ("p", " ".join(rng.choice(["word", "and,", "so", "end."]) for _ in range(rng.choice([1, 3, 12, 40]))))
        return (rng.choice(["div", "section"]), [tree(depth - 1) for _ in range(rng.randint(1, 4))])

    def markup(node):
        return f"<{node[0]}>{node[1] if isinstance(node[1], str) else ''.join(map(markup, node[1]))}</{node[0]}>"

    for _ in range(300):
        body = ("html", [tree(5) for _ in range(rng.randint(1, 3))])
        page = "".join(markup(c) for c in body[1])
        assert main_text.main_text(page) == "\n\n".join(scored_by_hand(body)), page
