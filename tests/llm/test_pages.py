"""Main texts of pages of many shapes, odd markup, and time in proportion to the page."""
import time

import pytest

from tessera.llm import html_paths

A, B, C = "Rain fell on the hills, and the river rose. It kept on.", "By noon, the bridge was closed; nobody crossed. They waited.", "At last the sun came out, as it does. So ended the day."
P = f"<p>{A}</p><p>{B}</p><p>{C}</p>"
MENU = '<ul class="menu"><li><a href="/">Home</a></li><li><a href="/n">News</a></li><li><a href="/c">Contact</a></li></ul>'
FOOT = '<div id="footer"><a href="/p">Privacy</a> <a href="/t">Terms</a></div>'
WHOLE = "\n\n".join((A, B, C))
PAGES = {
    "article": (f"<body>{MENU}<article><h1>Title</h1>{P}</article>{FOOT}</body>", f"Title\n\n{WHOLE}"),
    "main": (f"<body>{MENU}<main><h1>Title</h1>{P}</main>{FOOT}</body>", f"Title\n\n{WHOLE}"),
    "plain div": (f"<body>{MENU}<div class=post><h1>Title</h1>{P}</div>{FOOT}</body>", f"Title\n\n{WHOLE}"),
    "sibling articles": (f"<body>{MENU}<article>{P}</article><article>{P}</article></body>", f"{WHOLE}\n\n{WHOLE}"),
    "sections": (f"<body>{MENU}<div><section>{P}</section><section><h2>Next</h2>{P}</section></div>{FOOT}</body>", f"{WHOLE}\n\nNext\n\n{WHOLE}"),
    "table cells": (f"<body>{MENU}<table><tr><td>{A}<td>{B}<tr><td>{C}</table>{FOOT}</body>", WHOLE),
    "definition list": (f"<body>{MENU}<article><dl><dt>Rain<dd>{A}<dt>Noon<dd>{B}</dl><p>{C}</article></body>", f"Rain\n\n{A}\n\nNoon\n\n{B}\n\n{C}"),
    "unclosed paragraphs": (f"<body>{MENU}<div><p>{A}<p>{B}<p>{C}</div>{FOOT}", WHOLE),
    "nested comments": (f"<body><article>{P}<div class=comments><p>{A}</p><div><p>So true, I agree. Yes.</p></div></div></article></body>", WHOLE),
    "quotes in attributes": (f"<body><article><p title=it's>{A}</p><p data-x=\"a > b\" title='the hidden one' tall\">{B}</p><p class=a=\"b>{C}</p></article></body>", WHOLE),
    "forms and scripts": (f"<body><article>{P}<form><p>Sign up, now. Please.</p></form><script>if (a < b) x('</p>');</script><style>p {{}}</style></article></body>", WHOLE),
    "white space": (f"<body><article><p>\n {A.replace(' ', chr(10) + '  ')}\t</p><p>{B}<br></p><!-- {A} --><p>{C}&nbsp;</p></article>", WHOLE),
    "upper case": (f"<BODY><ARTICLE><P>{A}</P><P CLASS=x>{B}</P><P>{C}</P></ARTICLE></BODY>", WHOLE),
    "signs": ("<article><p>1 &lt; 2, and a < b &amp; c. Yes.</p></article>", "1 < 2, and a < b & c. Yes."),
    "names in an article": (f'<body><article><div class="search-results-study"><p>{A}</p></div><p class="notice-period">{B}</p><div class="social-history"><p>{C}</p></div></article></body>', WHOLE),
}


@pytest.mark.parametrize("shape", PAGES)
def test_shapes(shape):
    page, want = PAGES[shape]
    assert html_paths.main_text(page) == want


def test_time_is_in_proportion():
    n = 20000
    for page in ("<div>x, y." * n, "<i><div>" + "<span>" * n + "</i>x, y." * n, "<x-a>x, y." * n, '<a b="x, y.' * n, "<select>x, y." * n, "<div>" * n + "</x>a, b." * n, "<a " * n, "<!-- x" * n, "<a x='" * n + ">k, l."):
        began = time.process_time()
        html_paths.main_text(page)
        assert time.process_time() - began < 10, page[:20]


def test_odd_tables(spark):
    rows = [(1, "u", None, "a"), (1, "u", None, "a"), (None, None, PAGES["article"][0], None), (2, "v", "", "b")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, Text string")
    got = html_paths.extract(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r.page_id or 0, r.url or "", r.n_chars) for r in got.collect()) == [(0, "", len(PAGES["article"][1])), (1, "u", 0), (1, "u", 0), (2, "v", 0)]
    assert html_paths.extract(pages.limit(0)).count() == 0
