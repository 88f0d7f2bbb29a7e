"""DuckDB statements for the page queries (HTML events, URLs, page index, page graph)."""

from __future__ import annotations

#: Fixed values and patterns, stated here on their own: nothing is taken from the engine.
STOP_WORDS = [
    "", "the", "of", "at", "on", "in", "is", "it",
    "a", "b", "c", "d", "e", "f", "g", "h", "i", "j",
    "k", "l", "m", "n", "o", "p", "q", "r", "s", "t",
    "u", "v", "w", "x", "y", "z", "and", "or",
]
POSTING_BLOCK = 4096
FONT_WEIGHTS = {"b": 2, "strong": 2, "i": 1, "em": 1, "h1": 7, "h2": 6, "h3": 5, "h4": 4, "h5": 3, "title": 7}
HEADINGS = ["h1", "h2", "h3", "h4", "h5", "title"]
INLINE = ["b", "strong", "i", "em"]
BLOCKS = ["p", "div", "li", "td", "h1", "h2", "h3", "h4", "h5", "h6", "article"]
DROPPED = ["script", "iframe", "noscript", "object", "svg", "canvas", "applet", "frameset", "textarea", "style", "map"]
SCHEME_RE = r"^([a-zA-Z][a-zA-Z0-9+.\-]*):"
VALUE = r"""(?:"[^"]*"|'[^']*'|[^\s"'>=])"""
REST = rf"""[^>=]*(?:=\s*(?:{VALUE}[^>=]*)?)*>"""
TAG = rf"<(?:[a-zA-Z]|[/!?]){REST}|<(?:[a-zA-Z]|[/!?])[^>]*>"
COMMENT = r"<!--(?:.*?-->|.*\z)"
BODY_RE = rf"(?is)<html\b{REST}(.*)\z"
CUT_RE = f"(?is)({COMMENT})|" + "|".join(rf"<{t}\b{REST}.*?</{t}\s*>" for t in DROPPED) + f"|({TAG})"
EVENT_RE = f"(?s){COMMENT}|{TAG}|[^<]*(?:<+[^<a-zA-Z/!?][^<]*)+|[^<]+"
COMMENT_RE = r"(?s)^<!--(.*?)(?:-->)?\z"
TAG_NAME_RE = r"^</?\s*([a-zA-Z][a-zA-Z0-9]*)"
TITLE_RE = r"(?is)<title\b[^>]*>(.*?)</title\s*>"
HREF_RE = (r"""(?is)^<a(?:\s+[^\s=>]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>][^\s>]*))?)*"""
           r"""\s+href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")

WS = r"[ \t\n\r\f\x0B]"
STOP_SQL = ", ".join("'" + w + "'" for w in STOP_WORDS)
NETLOC_RE = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#]*)"
PATH_RE = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*([^?#]*)"
QUERY_RE = r"^[^?#]*\?([^#]*)"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def body_sql(html: str = "html") -> str:
    return (f"regexp_replace(regexp_extract({html}, {q(BODY_RE)}, 1), {q(CUT_RE)}, '\\1\\2', 'g')")


def normalize_sql(u: str) -> str:
    d = f"regexp_replace({u}, '#.*$', '')"
    s = f"regexp_extract({d}, {q(SCHEME_RE)}, 1)"
    low = f"CASE WHEN {s} <> '' THEN lower({s}) || ':' || regexp_replace({d}, {q(SCHEME_RE)}, '') ELSE {d} END"
    return f"regexp_replace({low}, '\\?$', '')"


def resolve_ctes(src: str, base: str, ref: str, out: str, name: str) -> list[str]:
    """CTE stages adding column ``out`` to ``src`` (mirror of ``with_resolved_url``)."""
    tmp = ["_r0", "_abs", "_b", "_r", "_bs", "_bn", "_bp", "_bq", "_rs", "_rr", "_rp", "_rq", "_rf", "_nn", "_np"]
    c1 = (f"{name}_1 AS (SELECT *, regexp_replace(regexp_replace(coalesce({ref}, ''), '[\\t\\r\\n]', '', 'g'), "
          f"'^[\\x00-\\x20]+', '') AS _r0 FROM {src})")
    c2 = (f"{name}_2 AS (SELECT *, (starts_with(lower(_r0), 'http://') OR starts_with(lower(_r0), 'https://')) AS _abs "
          f"FROM {name}_1)")
    c3 = (f"{name}_3 AS (SELECT *, {normalize_sql(f'CASE WHEN _abs THEN _r0 ELSE {base} END')} AS _b, "
          f"CASE WHEN _abs THEN '' ELSE _r0 END AS _r FROM {name}_2)")
    c4 = (f"{name}_4 AS (SELECT *, lower(regexp_extract(_b, {q(SCHEME_RE)}, 1)) AS _bs, "
          f"regexp_extract(_b, {q(NETLOC_RE)}, 1) AS _bn, regexp_extract(_b, {q(PATH_RE)}, 1) AS _bp, "
          f"regexp_extract(_b, {q(QUERY_RE)}, 1) AS _bq, lower(regexp_extract(_r, {q(SCHEME_RE)}, 1)) AS _rs "
          f"FROM {name}_3)")
    c5 = (f"{name}_5 AS (SELECT *, CASE WHEN _rs <> '' AND _rs = _bs THEN regexp_replace(_r, {q(SCHEME_RE)}, '') "
          f"ELSE _r END AS _rr FROM {name}_4)")
    c6 = (f"{name}_6 AS (SELECT *, regexp_extract(_rr, '^([^?#]*)', 1) AS _rp, "
          f"regexp_extract(_rr, {q(QUERY_RE)}, 1) AS _rq, regexp_extract(_rr, '^[^#]*#(.*)$', 1) AS _rf, "
          f"regexp_extract(_rr, '^//([^/?#]*)', 1) AS _nn, regexp_extract(_rr, '^//[^/?#]*([^?#]*)', 1) AS _np "
          f"FROM {name}_5)")

    def dots(segs: str) -> str:
        fold = (f"list_reduce({segs}, lambda acc, s: CASE WHEN s = '..' THEN CASE WHEN len(acc) > 0 "
                f"THEN acc[1:len(acc) - 1] ELSE acc END WHEN s = '.' THEN acc ELSE list_append(acc, s) END, "
                f"[]::VARCHAR[])")
        return f"CASE WHEN ({segs})[-1] IN ('.', '..') THEN list_append({fold}, '') ELSE {fold} END"

    base_parts = "string_split(_bp, '/')"
    dir_parts = f"CASE WHEN ({base_parts})[-1] <> '' THEN ({base_parts})[1:len({base_parts}) - 1] ELSE {base_parts} END"
    segs = f"list_concat({dir_parts}, string_split(_rp, '/'))"
    c7 = f"{name}_7 AS (SELECT *, {segs} AS _segs FROM {name}_6)"
    split_rp = "(string_split(_rp, '/'))"
    compact = ("CASE WHEN len(_segs) >= 2 THEN list_concat(_segs[1:1], "
               "list_filter(_segs[2:len(_segs) - 1], lambda x: x <> ''), _segs[len(_segs):len(_segs)]) ELSE _segs END")
    merged = (f"CASE WHEN starts_with(_rp, '/') THEN {dots(split_rp)} "
              f"ELSE {dots('(' + compact + ')')} END")
    c8 = f"{name}_8 AS (SELECT *, array_to_string({merged}, '/') AS _mp FROM {name}_7)"

    def assemble(netloc: str, path: str, query: str, frag: str) -> str:
        p = f"CASE WHEN ({path}) <> '' AND substring({path}, 1, 1) <> '/' THEN '/' || ({path}) ELSE ({path}) END"
        return (f"(_bs || '://' || {netloc} || {p} || CASE WHEN ({query}) <> '' THEN '?' || ({query}) ELSE '' END "
                f"|| CASE WHEN {frag} <> '' THEN '#' || {frag} ELSE '' END)")

    resolved = (
        "CASE WHEN _r = '' THEN _b "
        "WHEN _rs <> '' AND NOT (_rs = _bs) THEN _r "
        f"WHEN starts_with(_rr, '//') THEN {assemble('_nn', '_np', '_rq', '_rf')} "
        f"WHEN _rp = '' THEN {assemble('_bn', '_bp', 'CASE WHEN _rq <> $$$$ THEN _rq ELSE _bq END', '_rf')} "
        f"ELSE {assemble('_bn', 'CASE WHEN _mp = $$$$ THEN $$/$$ ELSE _mp END', '_rq', '_rf')} END"
    ).replace("$$", "'")
    drop = ", ".join(tmp + ["_segs", "_mp"])
    c9 = f"{name} AS (SELECT * EXCLUDE ({drop}), {resolved} AS {out} FROM {name}_8)"
    return [c1, c2, c3, c4, c5, c6, c7, c8, c9]


EVENTS = f"""pg_events AS (
  SELECT page_id, (generate_subscripts(ev, 1) - 1)::INTEGER AS pos, unnest(ev) AS event
  FROM (SELECT page_id, regexp_extract_all({body_sql()}, {q(EVENT_RE)}, 0) AS ev FROM pages)
)"""

EVENTS_TYPED = f"""pg_ev AS (
  SELECT page_id, pos, kind,
         CASE WHEN kind = 'tag' THEN lower(regexp_extract(event, {q(TAG_NAME_RE)}, 1)) END AS tag,
         CASE WHEN kind = 'tag' THEN starts_with(event, '</') END AS closing,
         CASE kind WHEN 'comment' THEN regexp_extract(event, {q(COMMENT_RE)}, 1) WHEN 'text' THEN event END AS text
  FROM (SELECT *, CASE WHEN starts_with(event, '<!--') THEN 'comment'
                       WHEN regexp_matches(event, '^<[a-zA-Z/!?]') THEN 'tag' ELSE 'text' END AS kind FROM pg_events)
)"""

RUNS = "pg_runs AS (SELECT page_id, pos, text FROM pg_ev WHERE kind IN ('text', 'comment'))"

PAGE_TOKS = f"""pg_toks AS (
  SELECT page_id, pos, tpos, word FROM (
    SELECT page_id, pos, (generate_subscripts(parts, 1) - 1)::INTEGER AS tpos, unnest(parts) AS word
    FROM (SELECT page_id, pos, regexp_extract_all(lower(text), '[a-zA-Z0-9\\-_]+') AS parts FROM pg_runs))
  WHERE word NOT IN ({STOP_SQL})
)"""

ANCHORS = f"""pg_anchors AS (
  SELECT e.page_id, e.pos, p.url,
         regexp_extract(e.event, {q(HREF_RE)}, 1) || regexp_extract(e.event, {q(HREF_RE)}, 2)
           || regexp_extract(e.event, {q(HREF_RE)}, 3) AS href
  FROM pg_events e JOIN pages p ON p.page_id = e.page_id
  WHERE lower(regexp_extract(e.event, {q(TAG_NAME_RE)}, 1)) = 'a' AND NOT starts_with(e.event, '</')
)"""

LINK_CTES = [EVENTS, ANCHORS, *resolve_ctes("pg_anchors", "url", "href", "to_url", "pg_links0"),
             f"pg_links AS (SELECT page_id, pos, {normalize_sql('url')} AS from_url, href, to_url FROM pg_links0)"]

CANON = f"pg_canon AS (SELECT page_id, {normalize_sql('url')} AS url FROM pages)"

DOCIDX = """pg_docidx AS (
  SELECT row_number() OVER (ORDER BY url)::BIGINT AS doc_id, url
  FROM (SELECT url FROM pg_canon UNION SELECT to_url AS url FROM pg_links)
)"""

PAGE_INDEX_CTES = [*LINK_CTES, EVENTS_TYPED, RUNS, PAGE_TOKS, CANON, DOCIDX,
                   """pg_doc_toks AS (SELECT d.doc_id, t.pos, t.tpos, t.word FROM pg_toks t
  JOIN pg_canon c ON c.page_id = t.page_id JOIN pg_docidx d ON d.url = c.url)""",
                   """pg_lex AS (SELECT row_number() OVER (ORDER BY word)::BIGINT AS word_id, word
  FROM (SELECT DISTINCT word FROM pg_doc_toks))""",
                   """pg_inv AS (SELECT DISTINCT l.word_id, t.doc_id FROM pg_doc_toks t JOIN pg_lex l ON l.word = t.word)""",
                   """pg_edges AS (SELECT a.doc_id AS from_id, b.doc_id AS to_id FROM pg_links l
  JOIN pg_docidx a ON a.url = l.from_url JOIN pg_docidx b ON b.url = l.to_url)"""]


def font_ctes() -> list[str]:
    heading = " ".join(f"WHEN '{t}' THEN {FONT_WEIGHTS[t]}" for t in HEADINGS)
    inline = " ".join(f"WHEN '{t}' THEN {FONT_WEIGHTS[t]}" for t in INLINE)
    blocks = ", ".join(f"'{t}'" for t in BLOCKS)
    upto = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    return [
        f"""pg_fd AS (SELECT page_id, pos, kind,
  CASE WHEN kind = 'tag' THEN (CASE tag {heading} ELSE 0 END) * (CASE WHEN closing THEN -1 ELSE 1 END) ELSE 0 END AS dh,
  CASE WHEN kind = 'tag' THEN (CASE tag {inline} ELSE 0 END) * (CASE WHEN closing THEN -1 ELSE 1 END) ELSE 0 END AS di,
  CASE WHEN kind = 'tag' AND tag IN ({blocks}) THEN 1 ELSE 0 END AS blk FROM pg_ev)""",
        f"""pg_f1 AS (SELECT *, sum(dh) OVER (PARTITION BY page_id ORDER BY pos {upto}) AS sh,
  sum(blk) OVER (PARTITION BY page_id ORDER BY pos {upto}) AS seg FROM pg_fd)""",
        f"""pg_f2 AS (SELECT *, min(least(sh, 0)) OVER (PARTITION BY page_id ORDER BY pos {upto}) AS mh,
  sum(di) OVER (PARTITION BY page_id, seg ORDER BY pos {upto}) AS si FROM pg_f1)""",
        f"""pg_f3 AS (SELECT *, min(least(si, 0)) OVER (PARTITION BY page_id, seg ORDER BY pos {upto}) AS mi FROM pg_f2)""",
        "pg_font AS (SELECT page_id, pos, (sh - mh + si - mi)::INTEGER AS font FROM pg_f3 WHERE kind <> 'tag')",
    ]


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def build(pagerank_ctes) -> dict[str, str]:
    sql: dict[str, str] = {}
    sql["page_events"] = _with(EVENTS, EVENTS_TYPED) + "SELECT page_id, pos, kind, tag, closing, text FROM pg_ev"
    sql["strip_ignored"] = f"SELECT page_id, {body_sql()} AS body FROM pages"
    sql["text_runs"] = _with(EVENTS, EVENTS_TYPED, RUNS) + "SELECT page_id, pos, text FROM pg_runs"
    title = (f"coalesce(regexp_replace(regexp_replace((regexp_extract_all(body, {q(TITLE_RE)}, 1))[-1], "
             f"'<[^>]*>', ' ', 'g'), '^{WS}+|{WS}+$', '', 'g'), '')")
    texts = (f"list_transform(list_filter(regexp_extract_all(body, {q(EVENT_RE)}, 0), "
             f"lambda e: NOT regexp_matches(e, '^<[a-zA-Z/!?]') OR starts_with(e, '<!--')), lambda e: CASE WHEN starts_with(e, '<!--') "
             f"THEN regexp_extract(e, {q(COMMENT_RE)}, 1) ELSE e END)")
    desc = (f"array_to_string(list_transform(list_filter({texts}, lambda t: regexp_replace(t, '{WS}+', '', 'g') <> '')[1:3], "
            f"lambda t: lower(t)), '')")
    sql["page_meta"] = (f"SELECT page_id, {title} AS title, {desc} AS description "
                        f"FROM (SELECT page_id, {body_sql()} AS body FROM pages)")
    sql["page_links"] = _with(*LINK_CTES) + "SELECT page_id, pos, from_url, href, to_url FROM pg_links"
    sql["resolve_url"] = _with(*LINK_CTES) + "SELECT page_id, pos, href, to_url FROM pg_links"
    sql["font_weights"] = _with(EVENTS, EVENTS_TYPED, *font_ctes()) + "SELECT page_id, pos, font FROM pg_font"
    sql["page_tokens"] = _with(EVENTS, EVENTS_TYPED, RUNS, PAGE_TOKS) + "SELECT page_id, pos, tpos, word FROM pg_toks"
    stripped = f"regexp_replace(url, '^{WS}+|{WS}+$', '', 'g')"
    sql["seeds"] = (f"SELECT DISTINCT url, 0 AS depth FROM (SELECT {normalize_sql(stripped)} AS url FROM pages) "
                    "WHERE url <> ''")
    sql["doc_index"] = _with(*LINK_CTES, CANON, DOCIDX) + "SELECT doc_id, url FROM pg_docidx"
    sql["encode_edges"] = _with(*PAGE_INDEX_CTES) + "SELECT from_id, to_id FROM pg_edges"
    sql["page_inverted_index"] = _with(*PAGE_INDEX_CTES) + "SELECT word_id, doc_id FROM pg_inv"
    sql["resolved_index"] = _with(*PAGE_INDEX_CTES) + f"""
SELECT l.word, (i.doc_id // {POSTING_BLOCK})::BIGINT AS block_no, count(*)::BIGINT AS n_urls,
       string_agg(d.url, chr(10) ORDER BY d.url) AS urls
FROM pg_inv i JOIN pg_lex l ON l.word_id = i.word_id JOIN pg_docidx d ON d.doc_id = i.doc_id
GROUP BY l.word, i.doc_id // {POSTING_BLOCK}"""
    sql["hits"] = _with(*PAGE_INDEX_CTES, *font_ctes()) + """
SELECT t.page_id, t.pos, t.tpos, l.word_id, f.font
FROM pg_toks t JOIN pg_font f ON f.page_id = t.page_id AND f.pos = t.pos JOIN pg_lex l ON l.word = t.word"""
    sql["rank_report"] = _with(*PAGE_INDEX_CTES, *pagerank_ctes(edges="pg_edges")) + """
SELECT row_number() OVER (ORDER BY p.score DESC, d.url)::BIGINT AS rank, d.url, round(p.score, 9) AS score
FROM pr p JOIN pg_docidx d ON d.doc_id = p.doc_id"""
    host = f"regexp_extract(url, {q(NETLOC_RE)}, 1)"
    reached = ["pc_0 AS (SELECT d.doc_id AS id FROM pg_docidx d JOIN (SELECT min(url) AS url FROM pg_canon GROUP BY " + host + ") USING (url))"]
    for depth in (1, 2):
        reached.append(f"pc_{depth} AS (SELECT id FROM pc_{depth - 1} UNION SELECT e.to_id FROM pc_{depth - 1} c JOIN pg_edges e ON e.from_id = c.id)")
    sql["page_crawl"] = _with(*PAGE_INDEX_CTES, *reached) + """
SELECT d.url, count(DISTINCT l.word)::BIGINT AS n_words
FROM pg_docidx d JOIN pg_canon c ON c.url = d.url LEFT JOIN pg_doc_toks l ON l.doc_id = d.doc_id
WHERE d.doc_id IN (SELECT id FROM pc_2) GROUP BY d.url"""
    sql["page_search"] = _with(
        *PAGE_INDEX_CTES, *pagerank_ctes(edges="pg_edges"),
        f"""terms AS (
  SELECT item_id AS query_id, lower(unnest(string_split_regex(regexp_replace(text, '^{WS}+|{WS}+$', '', 'g'), '{WS}+'))) AS word
  FROM benchmark)""",
        """scored AS (
  SELECT t.query_id, i.doc_id, count(*) * max(p.score) AS score
  FROM terms t JOIN pg_lex l ON l.word = t.word JOIN pg_inv i ON i.word_id = l.word_id JOIN pr p ON p.doc_id = i.doc_id
  WHERE t.word <> '' GROUP BY t.query_id, i.doc_id)""") + """
SELECT s.query_id, row_number() OVER (PARTITION BY s.query_id ORDER BY s.score DESC, s.doc_id)::BIGINT AS rank, d.url, round(s.score, 9) AS score
FROM scored s JOIN pg_docidx d ON d.doc_id = s.doc_id"""
    return sql
