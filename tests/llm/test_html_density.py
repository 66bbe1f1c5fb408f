"""Main text of pages against pages whose text is known."""

from __future__ import annotations

import html
import random
import re

import pytest

from terrace.llm import html_density as hd


def known_text(page: str) -> str:
    """The article of the generated tables, whose markup is plain."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>|<br>", " ", inner))
    return "\n".join(x for x in (" ".join(html.unescape(b).split()) for b in blocks) if x)


def test_whole_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    source = {r.page_id: r for r in pages.collect()}
    got = hd.extract(pages).collect()
    assert len(got) == len(source)
    for r in got:
        assert r.text == known_text(source[r.page_id].html) and r.n_chars == len(r.text) and r.url == source[r.page_id].url


def live(x):
    """All elements within one, itself included, that are not taken out."""
    return [x] + [y for c in x.children if not isinstance(c, str) and not c.gone for y in live(c)]


def plain_select(nodes):
    """Densities, sums, threshold and parts, each worked out from its definition."""
    import math

    root = nodes[0]
    chars = lambda x: sum(len("".join(html.unescape(c).split())) for y in live(x) for c in y.children if isinstance(c, str))
    links = lambda x: [y for y in live(x) if y.tag == "a"]
    within = lambda x: [y for y in links(x) if not any(z is not y and y in live(z) for z in links(x))]
    link_chars = lambda x: chars(x) if x.tag == "a" else sum(map(chars, within(x)))

    def density(x):
        c, lc = chars(x), link_chars(x)
        if not c:
            return 0.0
        t, lt = max(len(live(x)) - 1, 1), max(len(links(x)), 1)
        base = math.log(c * max(lc, 1) / max(c - lc, 1) + link_chars(root) / max(chars(root), 1) * c + math.e)
        return c / t * math.log(max(c * t / (max(lc, 1) * lt), 1.0)) / math.log(max(base, 1.0001))

    below = lambda x: [c for c in x.children if not isinstance(c, str) and not c.gone]
    total = lambda x: sum(density(c) for c in below(x))
    body = next((x for x in nodes if x.tag == "body"), root)
    body = root if body.gone or chars(body) < chars(root) else body
    if not chars(body):
        return []

    def largest(x):
        parts = [y for y in live(x) if any(c.tag in hd.BLOCK for c in below(y))]
        return max([x, *parts], key=lambda y: (total(y), y.tag in hd.ARTICLE))

    best = largest(body)
    path = [best]
    while path[-1] is not body:
        path.append(path[-1].parent)
    least, picked, open_ = min(map(density, path)), [], [body]

    def marked(x):
        while x is not None:
            if x.tag == "article" or (x.tag == "main" and not any(y.tag == "article" and chars(y) for y in live(x))):
                return x
            x = x.parent
        return None

    while open_:
        x = open_.pop()
        if density(x) >= least - 1e-12:
            top = largest(x)
            if top is not x:
                open_ += [c for c in below(x) if c.tag in hd.BLOCK]
            picked.append(marked(top) or top)
    return picked


def test_selection_against_plain_recomputation(spark):
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()]
    r = random.Random(11)
    bits = ["<div>", "</div>", "<div class=post>", "<p>", "</p>", "<a href=x>", "</a>", "<ul><li>", "</ul>", "<article>", "</article>", "<main>", "</main>", "<section>", "</section>", "<b>", "</b>"]
    for _ in range(400):
        pages.append("<body>" + "".join(r.choice([*bits, f"{sentence(r, r.randrange(1, 25))} "]) for _ in range(r.randrange(3, 40))))
    for page in pages:
        nodes = hd.parse(page)
        got = hd.select(nodes)
        for x in nodes:  # sums are added up in another order here
            x.density = round(x.density, 9)
        assert {id(x) for x in got} == {id(x) for x in plain_select(nodes)}, page


@pytest.mark.parametrize("bit", ["<a ", '<a href="', "<a", "<b>", "<div>", "<b>x", "<div>x", "<a '\"<b \"'", "<p><b>x", "<i></b>", "<div><span></p>"])
def test_time_grows_in_proportion(bit):
    import time

    took = []
    for n in (60_000, 240_000):
        start = time.process_time()
        hd.main_text(bit * n)
        took.append(time.process_time() - start)
    assert took[1] < 12 * max(took[0], 0.05)  # four times the length; a square would be 16 times


WORDS = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor".split()


def sentence(r, n):
    return " ".join(r.choice(WORDS) for _ in range(n))


@pytest.mark.parametrize("shell", ["<article>{}</article>", "<div id='main-content' class='post'>{}</div>", "<main><div class=story>{}</div></main>", "<div><div><div>{}</div></div></div>"])
def test_boilerplate_goes_and_text_stays(shell):
    r = random.Random(shell)
    parts = [sentence(r, r.randrange(15, 60)) for _ in range(8)]
    body = "".join(f"<p>{p}</p>" for p in parts)
    links = "".join(f"<li><a href='/{k}'>{sentence(r, 3)}</a></li>" for k in range(12))
    page = (
        "<!DOCTYPE html><html><head><title>x</title><style>p{}</style></head><body>"
        f"<header><h1>Site</h1></header><nav><ul>{links}</ul></nav><div class='cookie-notice'>We use cookies and more {sentence(r, 30)}</div>"
        + shell.format(body)
        + f"<aside>{sentence(r, 40)}</aside><div class=sidebar><ul>{links}</ul></div><div class='ad-slot'>{sentence(r, 25)}</div>"
        f"<section id='comments'><p>{sentence(r, 50)}</p></section><form><label>Mail</label><input></form><script>if (1 < 2) document.write('<p>no</p>')</script>"
        f"<ul class=x>{links}</ul><footer>end</footer></body></html>"
    )
    assert hd.main_text(page) == "\n".join(parts)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("<html><body></body></html>", ""),
        ("<p></p><!-- only a comment", ""),
        ("no markup &amp; none", "no markup & none"),
        ("<p>one<p>two <b>bold</i></b>&nbsp;end<br>next</p>", "one\ntwo bold end next"),
        ("<article><p>a &lt;b&gt; &#x41;\n\t b</p><ul><li>x<li>y</ul></article>", "a <b> A b\nx\ny"),
        ("<article><p title='a > b'>quoted</p></article>", "quoted"),
        ("<article>5 < 6 and text</article>", "5 < 6 and text"),
        ("<ARTICLE><P>Upper</P></ARTICLE>", "Upper"),
        ("<article><p>" + "long " * 20000 + "</p></article>", ("long " * 20000).strip()),
        ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"),
        ("<script>never closed <p>x", ""),
        ("<textarea>t</textarea><article><table><tr><td>1<td>2<tr><td>3</table></article>", "1\n2\n3"),
    ],
)
def test_cases(page, text):
    assert hd.main_text(page) == text


def paragraphs(seed, n):
    r = random.Random(seed)
    return [sentence(r, r.randrange(30, 50)) for _ in range(n)]


def marked(parts):
    return "".join(f"<p>{p}</p>" for p in parts)


def test_all_articles_of_a_text_are_kept():
    a, b, c = (paragraphs(k, 6) for k in "abc")
    page = f"<html><body><nav>x</nav><article>{marked(a)}</article><article>{marked(b)}</article><main><section>{marked(c)}</section></main></body></html>"
    assert hd.main_text(page) == "\n".join(a + b + c)


def test_teaser_articles_do_not_hide_the_text():
    text = paragraphs("text", 8)
    teasers = "".join(f"<article><h3><a href='/{k}'>Read more of this</a></h3><p>{sentence(random.Random(k), 6)}</p></article>" for k in range(3))
    for page in (f"<body><div>{marked(text)}</div>{teasers}</body>", f"<body><main>{teasers}<div>{marked(text)}</div></main></body>"):
        assert hd.main_text(page) == "\n".join(text)


def test_an_article_keeps_its_other_parts():
    a, b = paragraphs("a", 7), paragraphs("b", 2)
    page = f"<body><article><h1>Title</h1><section>{marked(a)}</section><section>{marked(b)}</section></article></body>"
    assert hd.main_text(page) == "\n".join(["Title", *a, *b])


def test_text_after_the_body_counts():
    assert hd.main_text("<html><body><p>x</p></body><article>" + marked(paragraphs("a", 5)) + "</article></html>").endswith("\n".join(paragraphs("a", 5)))


def test_frame_edge_cases(spark):
    rows = [(1, "u", None, "t"), (2**60 + 1, None, "<article>x</article>", "t"), (None, "v", "", "t"), (1, "u", None, "t")]
    got = hd.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    key = lambda x: str(x)
    assert sorted([tuple(r) for r in got], key=key) == sorted([(1, "u", "", 0), (2**60 + 1, None, "x", 1), (None, "v", "", 0), (1, "u", "", 0)], key=key)
    assert hd.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
