"""Fingerprints, page text and benchmark passages."""

import hashlib
import html
import random
import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pytest

from slipstream.llm import arrow, decontaminate, fingerprint
from slipstream.llm.html_text import extract, main_text
from slipstream.llm.queries import QUERIES
from tests.llm import brute
from tests.llm.conftest import rows_of


def _digest(text):
    return fingerprint.digests(*arrow.flat(pa.array([text or ""])))[0].tobytes()


@pytest.mark.parametrize("source", ["edge", "documents"])
def test_neighbours(spark, edge_docs, edge_rows, source):
    if source == "edge":
        docs, rows = edge_docs, edge_rows
    else:
        docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(5)
        rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = fingerprint.compare_neighbours(docs)
    got = {r.doc_id: r for r in found.collect()}
    assert found.count() == len(rows)
    keys = [i for i, _ in rows]
    once = [(i, t or "") for i, t in rows if i is not None and keys.count(i) == 1]
    texts = sorted(once, reverse=True)
    for (i, own), (j, after) in zip(texts, texts[1:] + texts[:1]):
        if source == "edge" and (i > 24 > j or i < 4):  # repeated and null keys lie between
            continue
        cut = len(own) // 3
        edited = own[: len(own) - cut] + after[:cut]
        r = got[i]
        assert r.n_chars == len(own) and bytes(r.edited_sha256) == hashlib.sha256(edited.encode()).digest()
        assert bytes(r.fingerprint) == _digest(own) and bytes(r.edited_fingerprint) == _digest(edited)
        a, b, c = (np.frombuffer(_digest(t), np.uint8)[None] for t in (own, edited, after))
        assert r.near_edited == fingerprint.likeness(a, b)[0] and r.near_next == fingerprint.likeness(a, c)[0]


def test_neighbours_of_few(edge_docs, no_docs):
    assert fingerprint.compare_neighbours(no_docs).isEmpty()
    one = fingerprint.compare_neighbours(edge_docs.where("doc_id = 10")).first()
    assert one.near_next == 1.0  # its own next


def test_likeness(edge_docs, edge_rows):
    texts = [t for _, t in edge_rows if t and len(t) > 200]
    d = fingerprint.digests(*arrow.flat(pa.array([texts[0], texts[0], texts[0][:-40], texts[4], ""])))
    near = lambda i, j: fingerprint.likeness(d[i : i + 1], d[j : j + 1])[0]
    assert near(0, 1) == 1 and 0 <= near(0, 3) <= near(0, 2) < 1 and near(0, 4) == 0 and near(4, 4) == 1
    found = rows_of(fingerprint.fingerprint(edge_docs), "doc_id", "fingerprint")
    assert {f for i, f in found if i in (3, 10)} == {_digest(texts[0])}


def test_counters_by_hand():
    text = b"abcdefgab"
    got = fingerprint.counters(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0]
    want = np.zeros(fingerprint.BUCKETS, int)
    for at in range(4, len(text)):
        for k, places in enumerate(fingerprint.TRIPLETS):
            a, b, c = (text[at - p] for p in places)
            h = (a + (b << 8) + (c << 16) + ((k + 1) << 24)) * 2654435761 % 2**32
            h = (h ^ h >> 15) * 2246822519 % 2**32
            want[h >> (32 - 8)] += 1
    assert (got == want).all()


PAGE = """<!doctype html><html><head><title>T</title><script>var a = "<p>no</p>";</script></head><body class="page">
<header><h1>Site</h1></header><nav><ul><li><a href="/">menu, menu, menu</a></li></ul></nav>
<div id="cookie-notice"><p>We use cookies, ok, fine, yes.</p></div>
<main><article class="post"><header><h1>Title</h1></header><p>One,  two&nbsp;three &amp; &lt;b&gt;.<p>Next <a href="x">para</a>,<br> on.
<ul><li>x<li>y</ul><div class="ad-slot">Buy</div><form><p>Subscribe, now</p></form><table><tr><td>A<td>B</table>
<p>Last, of <span hidden>not</span> all &copy;.</p><footer>foot</footer></article>
<section id="comments"><article class="comment"><p>Great, really, great, text, comment, wow, long, long, long.</p></article></section></main>
<aside><p>side, bar, text, with, commas</p></aside><footer>f, g, h</footer></body></html>"""


def test_page():
    assert extract(PAGE).split("\n") == ["Title", "One, two three & <b>.", "Next para, on.", "x", "y", "A", "B", "Last, of all ©."]


def test_sides_are_dropped_without_an_article():
    long = "A sentence, with commas, that goes on for a while, as sentences do. " * 3
    links = "".join(f'<li><a href="/{k}">Some link, here, {k}</a></li>' for k in range(30))
    page = f'<body><div class="top"><ul>{links}</ul></div><div class="content"><p>{long}</p><p>{long}</p></div><div class="sidebar"><p>{long}</p></div></body>'
    assert extract(page) == "\n".join([" ".join(long.split())] * 2)


@pytest.mark.parametrize("around", ["article", "main"])
def test_uneven_sections_of_an_article(around):
    part = "One, two, three, four, five and so on until the line has a good length, as lines do in a long section."
    section = lambda n: "<section>" + f"<p>{part}</p>" * n + "</section>"
    lists = "<h2>Then</h2><ul><li>first<li>second</ul><div>Loose text</div>"
    page = f'<body><div class="top"><a href="/">menu</a></div><{around}><h1>Title</h1>{section(20)}{lists}{section(3)}<nav>more</nav></{around}></body>'
    assert extract(page).split("\n") == ["Title", *[part] * 20, "Then", "first", "second", "Loose text", *[part] * 3]


PARTS = "<h2>Then</h2><ul><li>first<li>second</ul><table><tr><td>A<td>B</table><blockquote>Said, he, so.</blockquote>"
SEEN = ["Then", "first", "second", "A", "B", "Said, he, so."]


@pytest.mark.parametrize("around", ["<body>{}</body>", "<body><div><div>{}</div></div></body>", "<body><div><ul><li><a href=x>menu</a></ul></div><div>{}</div></body>"])
def test_all_blocks_of_a_page_without_an_article(around):
    """A long block, then a heading, a list, a table, a quote and a short block: none of it goes."""
    line = "One, two, three, four, five and so on until the line has a good length, as lines do."
    block = lambda n: "<div>" + f"<p>{line}</p>" * n + "</div>"
    page = around.format(f"<h1>Title</h1>{block(20)}{PARTS}{block(3)}")
    assert extract(page).split("\n") == ["Title", *[line] * 20, *SEEN, *[line] * 3]
    apart = around.format(f"<div>{block(5)}{PARTS}</div><div>{block(4)}</div>")
    assert extract(apart).split("\n") == [*[line] * 5, *SEEN, *[line] * 4]


def test_tags_end_as_in_browsers():
    tail = "<p>More, text, here.</p>"
    for tag in ("<p class=it's>", '<p title="abc>', "<p title='abc>", '<p a="x"">', "<p a='>' b=\">\">", "<p a = '1' b>", "<p/ >", "<p =>"):
        found = extract(f"<body><div>{tag}Start, of, it.{tail}</div></body>")
        assert found.split("\n") == ["Start, of, it.", "More, text, here."], tag
    assert extract('<p><a href="x"">link</a> and, on, it goes.</p>') == "link and, on, it goes."
    assert extract("<p>Let <math><mi>x</mi></math> be, <object>so</object> <noscript>far</noscript>.</p>") == "Let x be, so far."
    assert extract("<p>a <![CDATA[b, c") == "a b, c" and extract("<p>a <![CDATA[b]]> c") == "a b c"


class Reference(HTMLParser):
    """Blocks of a well-formed page by the library's parser: texts of p, h1, h2, li, td, blockquote outside dropped elements."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.dropped, self.text = [], 0, None

    def handle_starttag(self, tag, attrs):
        if tag in ("nav", "footer", "aside", "form", "script", "style") or dict(attrs).get("class") == "ad":
            self.dropped += 1
        elif tag in ("p", "h1", "h2", "li", "td", "blockquote"):
            self.text = []

    def handle_endtag(self, tag):
        if tag in ("nav", "footer", "aside", "form", "script", "style") or self.dropped and tag == "section":
            self.dropped -= 1
        elif tag in ("p", "h1", "h2", "li", "td", "blockquote") and self.text is not None:
            if not self.dropped and " ".join("".join(self.text).split()):
                self.out.append(" ".join("".join(self.text).split()))
            self.text = None

    def handle_data(self, data):
        if self.text is not None:
            self.text.append(data)


@pytest.mark.parametrize("around", ["article", "main", "div"])
def test_pages_by_an_independent_parser(around):
    rng = random.Random(around)
    words = "alpha, beta gamma; delta &amp; epsilon &lt;zeta&gt; eta, theta".split()
    sentence = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(6, 30))).capitalize() + "."
    for _ in range(60):
        body = [f"<h1>{sentence()}</h1>"]
        for _ in range(rng.randint(3, 9)):
            body.append(rng.choice([
                f"<p>{sentence()} <b>{sentence()}</b></p>", f"<h2>Part</h2><p>{sentence()}</p>", f"<ul><li>{sentence()}</li><li>one</li></ul>",
                f"<table><tr><td>{sentence()}</td><td>2</td></tr></table>", f"<blockquote>{sentence()}</blockquote>",
                "<nav><p>menu, here, and there.</p></nav>", "<form><p>Subscribe, now.</p></form>", "<section class='ad'><p>Buy, this.</p></section>",
            ]))
        inner = "".join(body) + f"<p>{sentence()}</p>"
        page = f"<html><body><nav><ul><li><a href='/'>Home, page</a></li></ul></nav><{around}>{inner}</{around}><aside><p>{sentence()}</p></aside><footer>f, g.</footer></body></html>"
        reference = Reference()
        reference.feed(page)
        assert extract(page).split("\n") == reference.out


def test_given_pages_by_an_independent_parser(spark):
    """The article of every given page, by the library's parser."""
    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("html").collect()
    for r in rows:
        assert extract(r.html) and not re.search(r"<(?:p|b|br|li|article)>", extract(r.html))
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)
        if article and not re.search(r"<(?:nav|footer|aside|form|script|style|div|section|header|!--)", article[1]):
            text = html.unescape(re.sub(r"<[^>]*>", " ", article[1]))
            assert "".join(extract(r.html).split()) == "".join(text.split())


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("plain & text", "plain & text"),
        ("<p>only", "only"),
        ("<div></div><script>x", ""),
        ("<" * 40, "<" * 40),
        ("<div>" * 5000 + "deep", "deep"),
        ("<!-- never closed <p>x</p>", ""),
        ("<p>a<!-- b --> c</p><p>&#233;&#x41;&bogus;</p>", "a c\néA&bogus;"),
        ("<article><p>Short.</p></article>", "Short."),
    ],
)
def test_odd_pages(page, text):
    assert extract(page) == text


def test_pages_table(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, "old"), (1, "u", PAGE, "old"), (None, None, None, None)], "page_id long, url string, html string, text string")
    found = main_text(pages)
    assert rows_of(found, "page_id", "n_chars") == sorted([(1, len(extract(PAGE)))] * 2 + [(None, 0)], key=repr)
    assert main_text(pages.limit(0)).isEmpty()
    small = QUERIES["op9_main_text"](spark, "/root/testdata/sf0.001")
    assert small.where("n_chars <> char_length(text) OR n_chars = 0").isEmpty()


@pytest.fixture(scope="module")
def planted(edge_rows):
    """Items, texts that hold some of them with edits, and which."""
    rng = random.Random(6)
    words = [t for _, t in edge_rows if t][0].split()
    items = [" ".join(rng.choice(words) for _ in range(n)) for n in (3, 8, 12, 20, 40)]
    texts, truth = [], []
    for k in range(40):
        text = " ".join(rng.choice(words) for _ in range(60))
        if k % 2:
            i = rng.randrange(1, len(items))
            limit = len(items[i].encode()) // 10
            found = list(items[i])
            for _ in range(rng.randint(0, limit // 2)):
                p = rng.randrange(1, len(found) - 1)
                found[p : p + 1] = rng.choice([[], ["q"], [found[p], "w"]])
            passage = "".join(found)
            cut = text.index(" ", rng.randrange(len(text) // 2)) if k > 2 else 0
            text = text[:cut] + " " + ("".join(c if c == "ß" else c.upper() for c in passage) if k % 3 else passage.replace(" ", " \n ")) + " " + text[cut:]
            truth.append((k, i))
        texts.append(text)
    return items, texts, truth


def _fold(text):
    data, offsets, _ = decontaminate.folded(*arrow.flat(pa.array([text])))
    return data.tobytes()


def test_passages(spark, planted):
    items, texts, truth = planted
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)] + [(100, None, "x"), (101, "", "x")], "doc_id long, text string, start string")
    benchmark = spark.createDataFrame([*enumerate(items), (50, None), (51, ""), (52, "ab")], "item_id long, text string")
    found = decontaminate.leaks(docs, benchmark).collect()
    got = {(r.doc_id, r.item_id): r for r in found}
    assert set(truth) <= set(got)
    for k, text in enumerate(texts):
        low = _fold(text)
        for i, item in enumerate(map(_fold, items)):
            limit = len(item) // 10  # one edit in ten bytes, whatever the length
            if len(item) < 8:
                fewest = 0 if b" " + item + b" " in b" " + low + b" " else None
            else:
                fewest = brute.occurs(item, low, limit)
            assert ((k, i) in got) == (fewest is not None), (item, low)
            if fewest is not None:
                r = got[k, i]
                place = text.encode()[r.start : r.stop].decode()
                assert r.edits == fewest and brute.occurs(_fold(place), item, 99) is not None
    kept = {r.doc_id for r in decontaminate.clean(docs, benchmark).collect()}
    assert kept == {*range(len(texts)), 100, 101} - {k for k, _ in got}


def test_nothing_to_search(spark, edge_docs, no_docs, edge_rows):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.leaks(edge_docs, none).isEmpty() and decontaminate.clean(edge_docs, none).count() == len(edge_rows)
    some = spark.createDataFrame([(1, edge_rows[0][1])], "item_id long, text string")
    assert decontaminate.leaks(no_docs, some).isEmpty()
    assert {r[0] for r in rows_of(decontaminate.leaks(edge_docs, some), "doc_id")} == {3, 10, 11, None}


def test_blocks_do_not_matter(spark, planted):
    items, _, _ = planted
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = [i for b in decontaminate.blocks(benchmark, size=60) for i in b.ids]
    assert sorted(found) == list(range(len(items)))


def test_short_items_have_the_same_share_of_edits(spark):
    """Items of 1 to 40 bytes, planted with as many edits as their length allows and with one more."""
    import random

    rng = random.Random(3)
    items, texts, want = [], [], set()
    for size in range(1, 41):
        for _ in range(3):
            item = "".join(rng.choice("bcdfghjklm") for _ in range(size))
            for extra in (0, 1):
                spoiled = list(item)
                for at in rng.sample(range(size), min(size, size // 10 + extra)):
                    spoiled[at] = "Z"
                texts.append(f"one two {''.join(spoiled)} three")
                if not extra:
                    want.add((len(texts) - 1, len(items)))
            items.append(item)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, benchmark).collect()}
    assert want <= got
    for k, text in enumerate(texts):
        for i, item in enumerate(items):
            if (k, i) in got - want:
                assert f" {item} " in text if len(item) < 8 else brute.occurs(_fold(item), _fold(text), len(item) // 10) is not None


def test_items_with_a_common_prompt(spark, monkeypatch):
    """A thousand items begin with one phrase that texts repeat: few are aligned, and unfolding is bounded."""
    import random
    import time

    rng = random.Random(6)
    prompt = "answer the following question with one of the letters "
    items = [prompt + "".join(rng.choice("abcdefghij ") for _ in range(60)) for _ in range(1000)]
    texts = [(prompt + "".join(rng.choice("klmnopqrst ") for _ in range(80))) * 10 for _ in range(100)]
    texts[7] += items[500]
    block = decontaminate.index(list(range(len(items))), items)
    monkeypatch.setattr(decontaminate, "ENTRIES", 100_000)
    data, offsets = arrow.flat(pa.array(texts))
    start = time.perf_counter()
    assert [(r, block.ids[i], e) for r, i, _, _, e in decontaminate.find(data, offsets, block)] == [(7, 500, 0)]
    assert time.perf_counter() - start < 30


def test_several_blocks_are_searched_in_turn(spark, planted, monkeypatch):
    items, texts, truth = planted
    docs = spark.createDataFrame([*enumerate(texts), (100, None), (101, "")], "doc_id long, text string")
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    one = rows_of(decontaminate.leaks(docs, benchmark), "doc_id", "item_id", "start", "stop", "edits")
    kept = rows_of(decontaminate.clean(docs, benchmark), "doc_id")
    several = decontaminate.blocks
    monkeypatch.setattr(decontaminate, "blocks", lambda *a, **b: several(*a, **{**b, "size": 60}))
    assert rows_of(decontaminate.leaks(docs, benchmark), "doc_id", "item_id", "start", "stop", "edits") == one
    assert rows_of(decontaminate.clean(docs, benchmark), "doc_id") == kept
