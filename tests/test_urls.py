"""URL resolution cases (base http://Host.example/a/b?q=1#frag)."""

from webloom.functions.urls import with_resolved_url

BASE = "http://Host.example/a/b?q=1#frag"

CASES = [
    ("", "http://Host.example/a/b?q=1"),
    (None, "http://Host.example/a/b?q=1"),
    ("c", "http://Host.example/a/c"),
    ("./c", "http://Host.example/a/c"),
    ("../c", "http://Host.example/c"),
    ("../../c", "http://Host.example/c"),
    ("../../../c", "http://Host.example/c"),
    ("/c", "http://Host.example/c"),
    ("//other.example/c", "http://other.example/c"),
    ("?x=2", "http://Host.example/a/b?x=2"),
    ("#s", "http://Host.example/a/b?q=1#s"),
    ("c#s", "http://Host.example/a/c#s"),
    ("c?y=1#s", "http://Host.example/a/c?y=1#s"),
    ("HTTP://Other.example/P#z", "http://Other.example/P"),
    ("https://o.example", "https://o.example"),
    ("https://o.example/a/../b#t", "https://o.example/a/../b"),
    ("mailto:me@x.example", "mailto:me@x.example"),
    ("javascript:void(0)", "javascript:void(0)"),
    ("c/", "http://Host.example/a/c/"),
    (".", "http://Host.example/a/"),
    ("..", "http://Host.example/"),
    ("/a/./b/../c", "http://Host.example/a/c"),
    ("http://o.example/?q#f", "http://o.example/?q"),
    (" c", "http://Host.example/a/c"),
    ("c//d", "http://Host.example/a/c/d"),
]


def test_staged_form_matches(spark):
    df = spark.createDataFrame([(i, BASE, h) for i, (h, _) in enumerate(CASES)], "i int, base string, href string")
    got = {r.i: r.u for r in with_resolved_url(df, "base", "href", "u").collect()}
    bad = [(h, want, got[i]) for i, (h, want) in enumerate(CASES) if got[i] != want]
    assert not bad, bad


def test_base_without_path(spark):
    df = spark.createDataFrame([(0, "http://h.example", "c"), (1, "http://h.example", "?x"),
                                (2, "http://h.example/?", "")], "i int, base string, href string")
    got = [r.u for r in with_resolved_url(df, "base", "href", "u").orderBy("i").collect()]
    assert got == ["http://h.example/c", "http://h.example?x", "http://h.example/"]
