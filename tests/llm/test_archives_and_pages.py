import base64
import gzip
import hashlib
import itertools
import json
import random
import re

import pytest

from plumbline.llm import html_wrapper, warc


def plain_archive(rows):
    seen, out = {}, []
    for page, html in sorted(rows, key=lambda r: r[0]):
        payload = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((page, len(payload), digest, "revisit" if payload in seen else "response", seen.get(payload)))
        seen.setdefault(payload, page)
    return out


def test_round_trip(spark):
    pages = [(i, f"<p>page {i % 7}</p>" + "é" * (i * 50)) if i % 3 else (i, f"copy {i % 2}") for i in range(60)] + [(100, None), (101, ""), (102, "\x00\r\n\r\nWARC/1.1\r\n")]
    df = spark.createDataFrame([(p, None if p % 5 == 0 else f"http://h/{p} \né", h, "x") for p, h in pages], "page_id bigint, url string, html string, payload string")
    out = [tuple(r) for r in warc.round_trip(df).collect()]
    assert sorted(out) == sorted(plain_archive(pages))
    assert warc.round_trip(df.limit(0)).collect() == []


def test_each_record_is_owned_once_whatever_the_split(spark):
    df = spark.createDataFrame([(i, "http://h", "word " * (i * i)) for i in range(25)], "page_id bigint, url string, html string")
    archives = warc.write(df.repartition(2))
    whole = sorted((r.file, r.offset, r.payload) for r in warc.read(spark, archives).collect())
    assert len(whole) == 25
    for split, ahead in ((1, 1), (50, 7), (333, 64), (10_000, 10)):
        assert sorted((r.file, r.offset, r.payload) for r in warc.read(spark, archives, split, ahead, tasks=4).collect()) == whole


def test_false_magic_is_no_record():
    member = warc.record("response", "urn:a", "http://a", b"payload", None, {})
    other = gzip.compress(b"no warc at all") + b"\x1f\x8b\x08junk" + b"\x1f\x8b\x08"
    data = other + member + member
    assert [at for at, _ in warc.members(data, len(data), False)] == [len(other), len(other) + len(member)]
    damaged = member[:-6] + b"xxxxxx"
    assert [at for at, _ in warc.members(damaged + member, 10_000, False)] == [len(damaged)]


def test_small_payloads_and_repeated_rows(spark):
    rows = [(1, "u", "same"), (1, "u", "same"), (2, "u", "same"), (None, "u", "same"), (3, "u", "long enough to refer"), (4, "u", "long enough to refer")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    kinds = sorted((r.headers.get("x-page-id", ""), r.record_type, r.refers_to or "") for r in warc.read(spark, warc.write(df)).collect())
    assert kinds == [("", "revisit", "urn:page:1"), ("1", "response", ""), ("1", "revisit", "urn:page:1"), ("2", "revisit", "urn:page:1"), ("3", "response", ""), ("4", "revisit", "urn:page:3")]
    large_only = [r.record_type for r in warc.read(spark, warc.write(df, min_revisit_bytes=10)).collect()]
    assert sorted(large_only) == ["response"] * 5 + ["revisit"]


PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var a="</p><p>no";</script></head><body>
<header>top</header><nav><ul><li>a<li>b</ul></nav><div class="cookie-notice">we use</div>%s<aside>side</aside>
<div id=comments><p>reader says</div><form>name <input></form><footer>&copy; me</footer></body></html>"""


def test_article_and_nothing_else(spark):
    body = '<article><h1>Head&nbsp;line</h1><p>One <b>bo</b>ld &lt;tag&gt;<br>line</p><p class="ad">buy</p><p>two\n three<ul><li>x<li>y</ul><!-- no --><p>caf&eacute; 1 < 2</article>'
    rows = [
        (1, "http://a/1", PAGE % body),
        (2, "http://a/2", PAGE % "<article><h1>Only</h1></article>"),
        (3, "http://b/1", "<p>no frame<div class=sidebar>side</div> but text"),
        (4, "http://b/2", None),
        (5, None, ""),
        (6, "odd", "plain &amp; simple"),
        (7, "http://a/3", PAGE % "<article></article>"),
        (8, "http://a/1", "<article><p>unclosed <a href='x>y'>link</a> tail <script>never closed"),
        (None, "http://a/9", "<main>m<section>n</section></main>"),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, url string, html string, text string")
    got = {r.page_id: r.text for r in html_wrapper.main_text(df).collect()}
    assert got[1] == "Head line One bold <tag> line two three x y café 1 < 2"
    assert (got[2], got[3], got[4], got[5], got[6], got[7]) == ("Only", "no frame but text", "", "", "plain & simple", "")
    assert got[8] == "unclosed link tail" and got[None] == "m n"
    assert all(r.n_chars == len(r.text) for r in html_wrapper.main_text(df).collect())
    assert html_wrapper.main_text(df.limit(0)).collect() == []


def test_wrapper_is_a_union_free_expression():
    one = "nav li #nav li #nav /nav article h1 #article p #article p #article /article".split()
    two = "nav li #nav /nav div! #div! /div! article h1 #article p #article h2 #article p #article p #article /article".split()
    wrapper = html_wrapper.infer([one, two])
    automaton = html_wrapper.Wrapper(wrapper)
    for stream in (one, two):
        assert automaton.read([(s, s) for s in stream]) is not None
    third = "nav li #nav li #nav li #nav /nav div! #div! /div! article h1 #article p #article /article".split()
    assert automaton.read([(s, str(i)) for i, s in enumerate(third)]) == [str(third.index("h1") + 1), str(third.index("p") + 1)]
    assert automaton.read([("table", "")]) is None
    assert html_wrapper.fold("p # p # p #".split()) == [[[["p", False], ["#", False]], False]]


@pytest.mark.parametrize("html", ["<" * 3000, "<p " + 'a="' * 3000, "<div>" * 3000, "<p>x" * 3000, "&" * 3000, "<!--" * 1000, "<a" * 2000])
def test_odd_markup_ends(html):
    text, _ = html_wrapper.extract(html, None)
    assert isinstance(text, str)


def test_hosts_that_mix_templates(spark):
    old, new = "<div><h1>Old %d</h1><p>plain text</p></div>", "<div>Site</div><article><h1>New %d</h1><p>framed text</p></article>"
    teaser = "<div><p>plain text</p></div><aside><article>teaser</article></aside>"
    rows = [(i, url, (old if i % 2 else new) % i) for i, url in enumerate(["http://a/1"] * 6 + [None] * 6 + ["odd"] * 2)]
    rows += [(20, "http://a/2", "<div>Site</div><article></article>"), (21, "http://a/3", teaser), (22, None, teaser)]
    got = {r.page_id: r for r in html_wrapper.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert all(r.by_host for r in got.values())
    assert all(got[i].text == (f"Old {i} plain text" if i % 2 else f"New {i} framed text") for i in range(14))
    assert got[20].text == "" and got[21].text == got[22].text == "plain text"


@pytest.mark.parametrize(
    "html, text",
    [
        ('<html class="no-cookies"><body class="has-sidebar widget"><main class="with-sidebar"><article class="post has-comments social">a<p>b</article></main></body></html>', "a b"),
        ('<div class="page share-on"><p>a</div>', "a"),
        ('<div>x</div><div id="social" class="sidebar-left"><div class=widget><article>a</article></div></div>', "a"),
        ('<article>a</article><div class="related-posts"><article class=teaser>b</article></div>', "a"),
        ('<div>a</div><section class="comments"><article>b</article></section>', "a"),
        ('<div>a</div><aside class="page sidebar"><article>b</article></aside>', "a"),
        ('<p>a<ul><li class="comment"><p>b<p>c</p>d<div>e</div><ul><li class="comment">f</li><li>g</ul>h<li>i</ul><p>j', "a i j"),
        ('<ol><li class="comment"><p>b</p><ol><li class="comment"><p>c</p></li></ol>d</li><li>e</li></ol>f', "e f"),
        ('<ol><li class="comment"><div>b</li><li>c</ol>', "c"),
        ('<table><tr><td class="ad"><p>b</p><ul><li>c</ul>d<td>e<tr class="promo"><td>f<tr><td>g</table>h', "e g h"),
        ('<dl><dt class="ad">b<p>c<dd>d</dl><p class="share">e<div>f</div>', "d f"),
        ('<p class="ad">b<p>c<p class="cookie-notice">d</p>e', "c e"),
    ],
)
def test_what_marks_something_apart(html, text):
    assert html_wrapper.extract(html, None)[0] == text
    assert html_wrapper.extract(f"<nav>n</nav>{html}", None)[0] == text


def test_texts_do_not_depend_on_the_number_of_shapes(spark):
    pages = [f"<p>{i}</p>" for i in range(4)] + ["<article></article><p>outside</p>", "<div><article><p>inside</p></article></div>"]
    rows = [(i, "http://h/", html) for i, html in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    few, many = ({r.page_id: r.text for r in html_wrapper.main_text(df, shapes=n).collect()} for n in (1, 32))
    assert few == many
    assert few[4] == "" and few[5] == "inside" and few[0] == "0"


def test_every_page_takes_part_in_the_wrapper_of_its_host(spark):
    """More shapes than a round aligns, over 32 of them, and one stream of over 4,000 symbols: all are read by the wrapper."""
    rng = random.Random(1)
    block = {"p": "<p>%d</p>", "h2": "<h2>%d</h2>", "pre": "<pre>%d</pre>", "li": "<ul><li>%d</ul>", "div": "<div>%d</div>"}
    pages = ["".join(block[rng.choice(list(block))] % n for n in range(rng.randint(1, 9))) for _ in range(60)]
    pages.append("".join(block[rng.choice(list(block))] % n for n in range(2000)))
    assert len({json.dumps(html_wrapper.fold([s for s, _ in html_wrapper.tokens(p)])) for p in pages}) > 50
    assert len([s for s, _ in html_wrapper.tokens(pages[-1])]) > 4000
    rows = [(i, "http://h/" if i % 9 else None, html) for i, html in enumerate(pages)] + [(90, "http://other/", "<p>a"), (91, "http://h/", None)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    for shapes in (4, 32):
        got = {r.page_id: r for r in html_wrapper.main_text(df, shapes=shapes).collect()}
        assert all(got[i].by_host for i in range(len(pages))) and got[91].text == "" and len(got) == len(rows)
        assert all(got[i].text == html_wrapper.extract(html, None)[0] for i, html in enumerate(pages))


@pytest.mark.parametrize("most", [0, 20, 1_000_000])
def test_an_aligned_wrapper_accepts_what_it_comes_from(most, monkeypatch):
    monkeypatch.setattr(html_wrapper._blocks, "__defaults__", (most, 40))
    rng = random.Random(most)
    for _ in range(60):
        streams = [[rng.choice("abcd") for _ in range(rng.randint(1, 14))] for _ in range(rng.randint(2, 6))]
        wrapper = html_wrapper.fold(streams[0])
        for page in map(html_wrapper.fold, streams[1:]):
            before, wrapper = wrapper, html_wrapper.align(wrapper, page)
            known = html_wrapper.Wrapper(wrapper)
            assert known.covers(before) and known.covers(page)
        assert all(known.read([(s, "") for s in stream]) is not None for stream in streams)
        assert not known.covers([["e", False]]) and known.read([("e", "")]) is None


def test_wrapper_of_optional_and_repeated_items():
    items = [["a", False], [[["b", True], ["c", True]], False], [[["d", False], [[["e", False]], True]], True]]
    known = html_wrapper.Wrapper(items)
    expression = re.compile("a(b?c?)+(de*)*".replace("(de*)*", "((de+)|d)*"))
    for n in range(6):
        for stream in itertools.product("abcde", repeat=n):
            assert (known.read([(s, "") for s in stream]) is not None) == bool(expression.fullmatch("".join(stream)))
    assert known.covers([["a", False], [[["d", False], ["e", False]], False]]) and not known.covers([["a", True]])
