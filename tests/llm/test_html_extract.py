from __future__ import annotations

import html
import random
import re

import pytest

from lakeloom.llm import html_extract as H
from tests.llm.data import frame

PAGES = "page_id long, url string, html string"
PARA = "This is a paragraph of running text that is long enough to look like the body of a page to any reader of it."

CASES = {
    "article": (f"<html><head><title>No</title><style>p{{x}}</style></head><body><nav><a href=x>Menu</a></nav><article><h1>Head &amp; more</h1><p>{PARA}</p><p>Ok.</p></article><footer>&copy; x</footer></body></html>",
                ["Head & more", PARA, "Ok."]),
    "script holds tags": (f'<article><script>var a="</p><p>bad</p></article>";</script><p>{PARA}</p></article>', [PARA]),
    "boilerplate inside article": (
        f'<article><header><h1>T</h1></header><p>{PARA}</p><aside>aside</aside><div class="ad-box">ad</div><form><label>f</label><input></form>'
        f'<div id="cookie-notice">notice</div><p>after</p><section class="comments"><p>a reader said</p></section></article>', ["T", PARA, "after"]),
    "no article": (f'<body class="with-sidebar"><header>Site</header><div id="menu">a b c</div><div><h2>Heading</h2><p>{PARA}</p><p>{PARA}</p><p>End.</p></div><div class="sidebar">{PARA}</div><div class="footer">bye</div></body>',
                   ["Heading", PARA, PARA, "End."]),
    "links are a menu": (f'<div><a href=1>one</a></div><div><a href=2>two</a></div><div>{PARA}</div>', [PARA]),
    "short page": ("<p>Hi.</p>", ["Hi."]),
    "open tags": (f"<main><p><b>{PARA}<br><p>two<p>three<ul><li>x<li>y</ul></main>", [PARA, "two", "three", "x", "y"]),
    "nav left open": (f"<nav><ul><li>menu<article><p>{PARA}</article>", [PARA]),
    "space": ("<main><p> a \n\t b&nbsp;c&#32; d <i>e</i>f</p><p> </p></main>", ["a b c d ef"]),
    "references": ("<article><p>&lt;b&gt; &#233; &amp;amp; &hellip; &bogus; 1 < 2</p></article>", ["<b> é &amp; … &bogus; 1 < 2"]),
    "comment": ("<article><!-- <p>no</p> --><p>yes</p></article><!-- open", ["yes"]),
    "upper case": (f"<ARTICLE><P>{PARA}</P></ARTICLE><FOOTER>x</FOOTER>", [PARA]),
    "table": ("<article><table><tr><td>1<td>2<tr><td>3</table></article>", ["1", "2", "3"]),
    "quotes": ('<article title="a > b" data-x=\'<p>\'><p class="x">yes</p></article>', ["yes"]),
    "hidden": ('<article><p>yes</p><div style="display: none">no</div><p hidden>no</p></article>', ["yes"]),
    "plain text": ("just text\nhere", ["just text here"]),
    "nothing": ("<nav>x</nav>", []),
    "empty": ("", []),
}


@pytest.mark.parametrize("name", CASES)
def test_pages(name):
    page, want = CASES[name]
    assert H.extract(page) == "\n\n".join(want)


def test_line_windows():
    line = lambda n: H.Line("x" * n, False, 0)
    gap = [H.Line("", False, 0)] * H.WINDOW
    kept = H.main_lines([line(5), *gap, line(60), line(40), line(3), *gap, line(20), *gap, line(90)])
    assert [len(k) for k in kept] == [60, 40, 3, 90]
    assert H.main_lines([]) == [] and H.main_lines(gap) == []


def test_article_is_a_hint():
    teaser = f'<article class="teaser"><p>Short teaser.</p></article><div><h2>Head</h2><p>{PARA}</p><p>{PARA}</p></div>'
    assert H.extract(teaser) == "\n\n".join(["Short teaser.", "Head", PARA, PARA])
    assert H.extract(f"<p>short words</p>{teaser}") == H.extract(teaser)
    assert H.extract(f"<main><p>{PARA}</p></main><div><a href=x>{PARA}</a></div><div>few words</div>") == PARA


def test_short_end_behind_an_advert():
    ad = '<div class="ad">buy</div>'
    page = f"<body><div>top{ad}</div><div><p>{PARA}</p>{ad}<p>Middle.</p>{ad}<p>{PARA}</p>{ad}<p>End.</p></div><hr><nav>n</nav><div>few words</div></body>"
    assert H.extract(page) == "\n\n".join([PARA, "Middle.", PARA, "End."])


def test_generated_pages_by_pattern(spark, data):
    """The given pages hold their text in article, whose blocks a pattern can cut."""
    got = H.page_texts(spark.read.parquet(f"{data}/pages.parquet")).collect()
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{data}/pages.parquet").collect()}
    assert len(got) == len(pages)
    for r in got:
        story = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        cut = re.sub(r"<[^>]+>", " ", re.sub(r"</?(?:p|h1)>", "\0", story))
        want = "\n\n".join(" ".join(html.unescape(b).split()) for b in cut.split("\0") if b.strip())
        assert r["text"] == want and r["n_chars"] == len(want)


def test_broken_pages_take_linear_time():
    for piece in ("<div ", '<a href="x', "<p>x", "<div>", "<a '", "</x>", "<!--", "<li>", "<b></i>"):
        H.extract(piece * 20_000)


def test_tags_of_any_length():
    uri = "data:image/png;base64," + "QUJD+/" * 170_000
    for tag in (f'<img alt="a > b" src="{uri}">', f"<img src='{uri}'/>", f"<img src={uri}>", f'<img src="{uri}>', "<img " + "data-x=1 " * 5_000 + ">"):
        assert H.extract(f"<article><p>{PARA}</p>{tag}<p>end</p></article>") == f"{PARA}\n\nend"
    many = '{"a": "' + "x > y " * 2_000 + '"}'
    page = f"<nav data-json='{many}'><p>menu</p></nav><article data-json='{many}'><p>{PARA}</p></article><div class=\"ad\" style=\"{'a:b;' * 2_000}\">{PARA}</div>"
    assert H.extract(page) == PARA
    assert [line.text for line in H.lines_of(f'<body><img src="{uri}">seen</body>', whole=True) if line.text] == ["seen"]


def test_broken_quotes_take_linear_time():
    for piece in ('<a b=">"', "<a b='<c d=\">", '<a b="x', "<!", "<? <a =", '<a b= "'):
        H.extract(piece * 20_000)


def test_columns_and_odd_rows(spark):
    pages = frame(spark, [(1, None, None), (2, "u", ""), (None, "u", "<p>x</p>"), (2, "u", "<p>" + PARA * 2_000)], PAGES)
    out = H.extract_text(pages.selectExpr("*", "1 AS text", "2 AS n_chars"))
    assert sorted(out.columns) == sorted(["page_id", "url", "html", "n_chars", "text"])
    assert sorted(len(r["text"]) for r in out.collect()) == [0, 0, 1, len(PARA) * 2_000]
    assert H.page_texts(frame(spark, [], PAGES)).count() == 0


WRAPPERS = ['<div class="container right-sidebar">{}</div>', '<div id="page" class="layout menu-open">{}</div>', '<div class="popular-science">{}</div>',
            '<form id="aspnetForm">{}</form>', '<article><div class="legal-analysis">{}</div></article>', '<div class="page search"><main>{}</main></div>',
            '<div class="top-widget"><div class="inner-menu"><div>{}</div></div></div>']


def test_wrappers_named_like_boilerplate():
    """A class word does not throw the page away; what is boilerplate inside or beside the wrapper goes."""
    inner = f"<p>{PARA}</p><p>{PARA}</p>"
    for wrapper in WRAPPERS:
        assert H.extract(f"<body>{wrapper.format(inner)}</body>") == f"{PARA}\n\n{PARA}", wrapper
        noise = f'<nav>n</nav><div class="comments"><p>{PARA[:90]} nice</p></div><form class="search"><input>go</form>'
        assert H.extract(f"<body>{wrapper.format(inner + noise)}<footer>{PARA}</footer></body>") == f"{PARA}\n\n{PARA}", wrapper


def test_long_comments_stay_out():
    comments = '<div class="comments">' + f"<p>{PARA} I agree.</p>" * 6 + "</div>"
    for page in (f"<article><p>{PARA}</p></article>{comments}", f"<article><p>{PARA}</p>{comments}</article>", f"<div><p>{PARA}</p><p>{PARA}</p></div>{comments}",
                 f'<div class="content sidebar-left"><article><p>{PARA}</p></article>{comments}</div>'):
        assert "agree" not in H.extract(page) and PARA in H.extract(page), page


def slow_main(lines, window, surge, story_surge):
    """Surge and dive by the definition, window by window."""
    size = [0 if not x.story and 2 * x.linked > len(x.text) else len(x.text) for x in lines]

    def total(i):
        return sum(size[k] for k in range(i, min(len(lines), i + window)))

    stories = [total(i) for i, x in enumerate(lines) if x.story and x.text]
    page = surge if stories and max(stories) > 0 else min(surge, max([total(i) for i in range(len(lines))], default=0))
    story = max(1, min(story_surge, max(stories, default=0)))
    ranges, i = [], 0
    while i < len(lines):
        end = next((k for k in range(i, len(lines)) if total(k) == 0), len(lines))
        best = max((total(k) for k in range(i, end) if lines[k].story), default=0)
        if best >= story if lines[i].story else total(i) >= page:
            end = i + 1
            while end < len(lines) and total(end) > 0:
                end += 1
            ranges.append((i, end))
            i = end + 1  # the dive itself cannot surge
        else:
            i += 1
    out, homes = [], set()
    for i, x in enumerate(lines):
        inside = any(a <= i < b for a, b in ranges)
        if size[i] and (inside or x.home in homes):
            out.append(x.text)
            if inside and x.home:
                homes.add(x.home)
    return out


def test_windows_by_brute_force():
    rng = random.Random(4)
    for _ in range(400):
        lines = []
        for _ in range(rng.randint(0, 25)):
            text = "x" * rng.choice([0, 0, 0, 1, 5, 20, 40, 90])
            lines.append(H.Line(text, rng.choice([0, 0, 1]), rng.choice([0, len(text)]), rng.randint(0, 3)))
        for window, surge, story in ((3, 86, 30), (1, 10, 1), (4, 50, 60)):
            assert H.main_lines(lines, window, surge, story) == slow_main(lines, window, surge, story)
