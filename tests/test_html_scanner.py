"""Stray "<", quoted ">", comments that mention ignored elements, unclosed comments."""

import pytest

from webloom.operators import pages as P

CASES = [
    ("<html><p>if a < b then c</p></html>", ["if a < b then c"], []),
    ("<html>1 <2, 3 << 4 <3 <b>x</b></html>", ["1 <2, 3 << 4 <3 ", "x"], []),
    ('<html><a title="x > y" href="/one">go</a> end</html>', ["go", " end"], ["/one"]),
    ("<html><a href='/a>b' class=it's>it's</a> don't</html>", ["it's", " don't"], ["/a>b"]),
    ("<html><!-- no <script> here --> kept <script>var x = '</p>';</script> too</html>", [" no <script> here ", " kept  too"], []),
    ('<html><a title="<script>" href="/q">one</a> two <script>gone</script></html>', ["one", " two "], ["/q"]),
    ("<html>before <!-- open words </html>", ["before ", " open words </html>"], []),
    ("<html lang='a>b'>word</html>", ["word"], []),
    ('<html><a href="/open>text</a> after</html>', ["text", " after"], [""]),
    ('<html><a href="/1" href="/2">x</a><a>none</a></html>', ["x", "none"], ["/2", ""]),
    ("<html><style>p > a {}</style><STYLE type='>'>q</STYLE>left</html>", ["left"], []),
    ("<html><!----><!-->-->text</html>", ["", ">", "text"], []),
    ("no page", [], []),
    (None, [], []),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(k, "http://h/p", html) for k, (html, _, _) in enumerate(CASES)], "page_id long, url string, html string")


def test_text_and_links(pages):
    texts, links = {}, {}
    for r in P.text_runs(pages).orderBy("page_id", "pos").collect():
        texts.setdefault(r.page_id, []).append(r.text)
    for r in P.page_links(pages).orderBy("page_id", "pos").collect():
        links.setdefault(r.page_id, []).append(r.href)
    for k, (html, want, hrefs) in enumerate(CASES):
        assert texts.get(k, []) == want, html
        assert links.get(k, []) == hrefs, html


def test_long_tags_and_texts_do_not_exhaust_the_stack(spark):
    tag = "<a " + " ".join(f'k{i}="v > {i}"' for i in range(3000)) + ' href="/far">'
    html = f"<html>{'a < b ' * 20_000}{tag}{'word ' * 50_000}<p {'=x ' * 3000}"
    page = spark.createDataFrame([(1, "http://h/", html)], "page_id long, url string, html string")
    assert [r.href for r in P.page_links(page).collect()] == ["/far"]
    assert P.text_runs(page).count() >= 2


def test_running_weights(spark):
    html = "<html>0<h1>7<b>9</b>7</h1>0<b>2<i>3<p>0<em>1</p>0</b>0</i></b>0<!-- c --><title>7</title></html>"
    page = spark.createDataFrame([(1, "http://h/", html)], "page_id long, url string, html string")
    rows = P.weighted_runs(page).selectExpr("inline(runs)").collect()
    assert [(r.font, r.text) for r in rows if r.text.strip().isdigit()] == [(int(r.text), r.text) for r in rows if r.text.strip().isdigit()]
    assert [r.font for r in P.font_weights(page).orderBy("pos").collect()] == [r.font for r in rows]
