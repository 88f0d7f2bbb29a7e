"""DuckDB statements for spelling, fallback search, suggestions, search-log history and the crawl."""

from __future__ import annotations

WS = r"[ \t\n\r\f\x0B]"


def norm(x: str) -> str:
    return f"regexp_replace(lower(regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')), '{WS}{WS}+', ' ', 'g')"


def words_of(x: str) -> str:
    """Python's str.split(): whitespace runs, no empty ends (a blank string gives [''])."""
    return f"string_split_regex(regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g'), '{WS}+')"


MISSPELT = """misspelt AS (
  SELECT query_id, array_to_string(list_transform(string_split(keywords, ' '),
           lambda w: CASE WHEN length(w) > 4 THEN substring(w, 1, 1) || substring(w, 3) ELSE w END), ' ') AS keywords
  FROM queries
)"""

SESSION = """long_words AS (
  SELECT query_id, coalesce(list_filter(string_split(keywords, ' '), lambda w: length(w) > 4)[1], '') AS word FROM queries
),
session AS (
  SELECT query_id * 4 AS query_id, keywords FROM queries
  UNION ALL SELECT query_id * 4 + 1, keywords FROM misspelt
  UNION ALL SELECT query_id * 4 + 2, CASE WHEN word = '' THEN '' ELSE substring(word, 1, 3) || 'qz' || substring(word, 4) END FROM long_words
  UNION ALL SELECT query_id * 4 + 3, CASE WHEN word = '' THEN '' ELSE substring(word, 1, 1) || 'qzqzqzq' || right(word, 1) END FROM long_words
)"""

DICT = """dict AS (SELECT word, count(DISTINCT doc_id)::BIGINT AS df FROM all_doc_toks WHERE word <> '' GROUP BY word)"""


def search_ctes(src: str, p: str) -> list[str]:
    """Search over query table ``src`` (needs lex, inv, pr); defines ``{p}_results``."""
    return [
        f"""{p}_terms AS (
  SELECT query_id, (generate_subscripts(ws, 1) - 1)::INTEGER AS pos, lower(unnest(ws)) AS word
  FROM (SELECT query_id, {words_of('keywords')} AS ws FROM {src}))""",
        f"""{p}_hits AS (
  SELECT DISTINCT t.query_id, t.pos, t.word, i.doc_id, r.score
  FROM {p}_terms t JOIN lex l ON l.word = t.word JOIN inv i ON i.word_id = l.word_id JOIN pr r ON r.doc_id = i.doc_id
  WHERE t.word <> '')""",
        f"""{p}_results AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id)::BIGINT AS rank, doc_id, score
  FROM (SELECT query_id, doc_id, count(*) * max(score) AS score FROM {p}_hits GROUP BY query_id, doc_id))""",
    ]


def spell_ctes(src: str, p: str, any_length: bool = False) -> list[str]:
    """Corrections for the normalised words of query table ``src``; defines ``{p}_fix``."""
    fewer = "" if any_length else " AND dist < length(qa)"
    return [
        f"""{p}_words AS (
  SELECT query_id, (generate_subscripts(ws, 1) - 1)::INTEGER AS pos, unnest(ws) AS word
  FROM (SELECT query_id, string_split({norm('keywords')}, ' ') AS ws FROM {src}))""",
        f"""{p}_q AS (SELECT DISTINCT word AS q, regexp_replace(word, '[^\\x00-\\x7F]', '~', 'g') AS qa FROM {p}_words)""",
        f"""{p}_cand AS (
  SELECT q.q, q.qa, d.word, d.df, levenshtein(q.qa, d.word) AS dist
  FROM {p}_q q JOIN dict d ON length(d.word) BETWEEN length(q.qa) - 2 AND length(q.qa) + 2)""",
        f"""{p}_best AS (
  SELECT q, word FROM (
    SELECT q, word, row_number() OVER (PARTITION BY q ORDER BY dist, df DESC, word) AS rn FROM {p}_cand WHERE dist <= 2{fewer})
  WHERE rn = 1)""",
        f"""{p}_fix AS (
  SELECT w.query_id, w.pos, w.word, coalesce(b.word, w.word) AS correction
  FROM {p}_words w LEFT JOIN {p}_best b ON b.q = w.word)""",
    ]


def fallback_ctes() -> list[str]:
    return [
        *search_ctes("session", "s1"),
        "failed AS (SELECT * FROM session WHERE query_id NOT IN (SELECT query_id FROM s1_results))",
        *spell_ctes("failed", "sp"),
        f"""rebuilt AS (
  SELECT query_id, regexp_replace(string_agg(correction, ' ' ORDER BY pos), '{WS}+$', '') AS corrected
  FROM sp_fix GROUP BY query_id)""",
        f"""retry AS (
  SELECT f.query_id, r.corrected AS keywords FROM failed f JOIN rebuilt r ON r.query_id = f.query_id
  WHERE lower({norm('f.keywords')}) <> lower(r.corrected))""",
        *search_ctes("retry", "s2"),
        """fallback AS (
  SELECT query_id, NULL::VARCHAR AS corrected, rank, doc_id, score FROM s1_results
  UNION ALL
  SELECT r.query_id, t.keywords AS corrected, r.rank, r.doc_id, r.score FROM s2_results r JOIN retry t ON t.query_id = r.query_id)""",
        """sugg AS (
  SELECT coalesce(f.corrected, s.keywords) AS text, min(f.query_id) AS first_seen
  FROM (SELECT DISTINCT query_id, corrected FROM fallback) f JOIN session s ON s.query_id = f.query_id
  GROUP BY coalesce(f.corrected, s.keywords))""",
    ]


ESC = r"regexp_replace({c}, '([!-/:-@\[-`{{-~])', '\\\1', 'g')"


def esc(c: str) -> str:
    return ESC.format(c=c)


def suggestion_ctes() -> list[str]:
    ws = words_of("keywords")
    nonempty = f"list_filter({ws}, lambda w: w <> '')"
    parts = f"list_transform({nonempty}, lambda w: {esc('substring(w, 1, 1)')} || '.*' || {esc('right(w, 1)')})"
    pattern = (f"CASE WHEN length(keywords) = 1 THEN '^' || {esc('keywords')} "
               f"WHEN len({nonempty}) = 0 THEN NULL ELSE '^' || array_to_string({parts}, ' +') END")
    key = f"CASE WHEN length(keywords) = 1 THEN keywords ELSE substring(({ws})[1], 1, 1) END"
    return [
        f"""pats AS (
  SELECT query_id, {pattern} AS pattern, {key} AS key
  FROM session WHERE query_id NOT IN (SELECT query_id FROM fallback))""",
        """matched AS (
  SELECT p.query_id, s.text, s.first_seen FROM pats p JOIN sugg s
    ON substring(s.text, 1, 1) = p.key AND s.first_seen < p.query_id AND regexp_matches(s.text, p.pattern)
  WHERE p.pattern IS NOT NULL)""",
    ]


LOG = "log AS (SELECT conv_id AS user_id, turn AS seq, text FROM conversations WHERE role = 'user')"


def log_words(src: str = "log", name: str = "lw") -> str:
    return f"""{name} AS (
  SELECT user_id, seq, (generate_subscripts(ws, 1) - 1)::INTEGER AS pos, unnest(ws) AS word
  FROM (SELECT user_id, seq, string_split({norm('text')}, ' ') AS ws FROM {src}))"""


def counts_cte(src: str = "lw", name: str = "hc") -> str:
    return f"""{name} AS (
  SELECT user_id, word, n, f.seq AS first_seq, f.pos AS first_pos FROM (
    SELECT user_id, word, count(*)::BIGINT AS n, min(struct_pack(seq := seq, pos := pos)) AS f
    FROM {src} WHERE user_id IS NOT NULL GROUP BY user_id, word))"""


def recent_cte(src: str = "lw", name: str = "rw", k: int = 10) -> str:
    return f"""{name} AS (
  SELECT user_id, (len(q) - generate_subscripts(q, 1) + 1)::INTEGER AS rank, unnest(q) AS word FROM (
    SELECT user_id, list_reduce(list(word ORDER BY seq, pos),
             lambda acc, x: CASE WHEN list_contains(acc, x) THEN acc
                                 WHEN len(acc) = {k} THEN list_append(acc[2:], x)
                                 ELSE list_append(acc, x) END, []::VARCHAR[]) AS q
    FROM {src} WHERE user_id IS NOT NULL GROUP BY user_id))"""


def build(base_ctes, queries_cte, chain_cte, pagerank_ctes, crawl_depth: int) -> dict[str, str]:
    def w(*ctes):
        return "WITH " + ",\n".join(ctes) + "\n"

    sql: dict[str, str] = {}
    docs = base_ctes[:2]  # split_docs, all_doc_toks
    sql["spell_dictionary"] = w(*docs, DICT) + "SELECT word, df FROM dict"
    sql["normalize_query"] = w(LOG) + f"""
SELECT user_id, seq, {norm('text')} AS normalized, len(string_split({norm('text')}, ' '))::INTEGER AS n_words FROM log"""
    sql["spell_correct"] = w(*docs, DICT, queries_cte, MISSPELT, *spell_ctes("misspelt", "sp", any_length=True)) + \
        "SELECT query_id, pos, word, correction FROM sp_fix"
    full = (*base_ctes, chain_cte, *pagerank_ctes(), DICT, queries_cte, MISSPELT, SESSION, *fallback_ctes())
    sql["search_with_fallback"] = w(*full) + "SELECT query_id, corrected, rank, doc_id, round(score, 9) AS score FROM fallback"
    sql["suggestion_list"] = w(*full) + "SELECT text, first_seen FROM sugg"
    sql["suggestions"] = w(*full, *suggestion_ctes()) + """
SELECT query_id, rank, text AS suggestion FROM (
  SELECT query_id, text, row_number() OVER (PARTITION BY query_id ORDER BY first_seen, text)::BIGINT AS rank FROM matched)
WHERE rank <= 5"""
    sql["query_word_counts"] = w(LOG, log_words()) + """
SELECT user_id, seq, word, count(*)::BIGINT AS n, min(pos) AS first_pos FROM lw GROUP BY user_id, seq, word"""
    sql["history_counts"] = w(LOG, log_words(), counts_cte()) + \
        "SELECT user_id, word, n, first_seq, first_pos FROM hc"
    sql["history_top20"] = w(LOG, log_words(), counts_cte()) + """
SELECT user_id, rank, word, n FROM (
  SELECT user_id, word, n,
         row_number() OVER (PARTITION BY user_id ORDER BY n DESC, first_seq, first_pos, word)::BIGINT AS rank FROM hc)
WHERE rank <= 20"""
    sql["recent_words"] = w(LOG, log_words(), recent_cte()) + "SELECT user_id, rank, word FROM rw"
    sql["history_snapshot"] = w(
        LOG,
        """outs AS (
  SELECT conv_id AS user_id, min(turn) AS seq FROM conversations WHERE role = 'assistant' GROUP BY conv_id
  UNION SELECT conv_id, max(turn) FROM conversations WHERE role = 'assistant' GROUP BY conv_id)""",
        """ended AS (
  SELECT l.user_id, l.seq, l.text, min(o.seq) AS signout_seq FROM log l
  JOIN outs o ON o.user_id = l.user_id AND o.seq >= l.seq GROUP BY l.user_id, l.seq, l.text)""",
        "sessions AS (SELECT *, dense_rank() OVER (ORDER BY user_id, signout_seq) AS sid FROM ended)",
        "cut AS (SELECT sid AS user_id, seq, text FROM sessions)", log_words("cut", "lw"), counts_cte(),
        recent_cte(),
    ) + """
SELECT k.user_id, k.signout_seq, c.word, c.n, r.rank AS recent_rank
FROM hc c JOIN (SELECT DISTINCT sid, user_id, signout_seq FROM sessions) k ON k.sid = c.user_id
LEFT JOIN rw r ON r.user_id = c.user_id AND r.word = c.word"""
    levels = ["c0 AS (SELECT DISTINCT p_partkey AS id, 0 AS depth FROM part WHERE p_size = 1)"]
    for d in range(1, crawl_depth + 1):
        seen = " UNION ALL ".join(f"SELECT id FROM c{k}" for k in range(d))
        levels.append(f"""c{d} AS (SELECT DISTINCT ch.to_id AS id, {d} AS depth FROM c{d - 1} JOIN chain ch ON ch.from_id = c{d - 1}.id
  WHERE ch.to_id NOT IN ({seen}))""")
    union = " UNION ALL ".join(f"SELECT id, depth FROM c{k}" for k in range(crawl_depth + 1))
    sql["crawl_frontier"] = w(chain_cte, *levels) + f"SELECT id, depth::INTEGER AS depth FROM ({union})"
    return sql
