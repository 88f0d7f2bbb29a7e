"""DuckDB SQL for each named query: an independent statement of the same result.

The tables (documents, pages, lineitem, ...) are views in DuckDB. Column
names and types match the Spark results (BIGINT ids, INTEGER positions,
DOUBLE scores rounded to 9 digits, sets rendered as sorted space-joined
strings). Regexes stay in the subset shared by Java and RE2.
"""

from __future__ import annotations

from webloom.plans.oracle_pages import POSTING_BLOCK, STOP_WORDS

DAMPING = 0.85  # fixed value
WS = r"[ \t\n\r\f\x0B]"
STOP_SQL = ", ".join("'" + w + "'" for w in STOP_WORDS)


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# ---------------------------------------------------------------- building blocks

SPLIT_DOCS = r"""split_docs AS (
  SELECT doc_id, regexp_extract_all(lower(text), '[a-zA-Z0-9\-_]+') AS parts FROM documents
)"""

ALL_DOC_TOKS = """all_doc_toks AS (
  SELECT doc_id, (generate_subscripts(parts, 1) - 1)::INTEGER AS pos, unnest(parts) AS word FROM split_docs
)"""

DOC_TOKS = f"""doc_toks AS (
  SELECT doc_id, pos, word FROM all_doc_toks WHERE word NOT IN ({STOP_SQL})
)"""

LEX = """lex AS (
  SELECT row_number() OVER (ORDER BY word)::BIGINT AS word_id, word FROM (SELECT DISTINCT word FROM doc_toks)
)"""

INV = """inv AS (
  SELECT DISTINCT l.word_id, t.doc_id FROM doc_toks t JOIN lex l ON l.word = t.word
)"""

DOC_INDEX_CTES = (SPLIT_DOCS, ALL_DOC_TOKS, DOC_TOKS, LEX, INV)

CHAIN = """chain AS (
  SELECT from_id, to_id FROM (
    SELECT l_partkey AS from_id,
           lead(l_partkey) OVER (PARTITION BY l_orderkey
                                 ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS to_id
    FROM lineitem) WHERE from_id IS NOT NULL AND to_id IS NOT NULL
)"""

QUERIES = "queries AS (SELECT item_id AS query_id, text AS keywords FROM benchmark)"


def pagerank_ctes(edges: str = "chain", sweeps: int = 20, initial: float = 1.0,
                  damping: float = DAMPING, name: str = "pr") -> list[str]:
    """Synchronous sweeps unrolled as CTEs; the last one is called ``name``."""
    ctes = [
        f"pr_od AS (SELECT from_id AS id, count(*)::DOUBLE AS outdeg FROM {edges} GROUP BY from_id)",
        f"pr_links AS (SELECT DISTINCT from_id, to_id FROM {edges})",
        "pr_n AS (SELECT count(*)::DOUBLE AS n FROM pr_od)",
        f"pr_0 AS (SELECT id, {float(initial)!r}::DOUBLE AS score FROM pr_od)",
    ]
    for i in range(1, sweeps + 1):
        ctes.append(
            f"""pr_{i} AS (
  SELECT o.id, (1.0::DOUBLE - {damping!r}::DOUBLE) / (SELECT n FROM pr_n) + {damping!r}::DOUBLE * coalesce(s.t, 0.0) AS score
  FROM pr_od o LEFT JOIN (
    SELECT l.to_id, sum(r.score / od.outdeg) AS t
    FROM pr_links l JOIN pr_{i - 1} r ON r.id = l.from_id JOIN pr_od od ON od.id = l.from_id
    GROUP BY l.to_id) s ON s.to_id = o.id
)"""
        )
    ctes.append(f"{name} AS (SELECT id AS doc_id, score FROM pr_{sweeps})")
    return ctes


TERMS = rf"""terms AS (
  SELECT query_id, (generate_subscripts(ws, 1) - 1)::INTEGER AS pos, lower(unnest(ws)) AS word
  FROM (SELECT query_id, string_split_regex(regexp_replace(keywords, '^{WS}+|{WS}+$', '', 'g'), '{WS}+') AS ws FROM queries)
)"""

TERM_HITS = """term_hits AS (
  SELECT DISTINCT t.query_id, t.pos, t.word, i.doc_id, p.score
  FROM terms t JOIN lex l ON l.word = t.word JOIN inv i ON i.word_id = l.word_id JOIN pr p ON p.doc_id = i.doc_id
  WHERE t.word <> ''
)"""

RESULTS = """results AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id)::BIGINT AS rank, doc_id, score
  FROM (SELECT query_id, doc_id, count(*) * max(score) AS score FROM term_hits GROUP BY query_id, doc_id)
)"""


# ---------------------------------------------------------------- statements

def build() -> dict[str, str]:
    sql: dict[str, str] = {}
    sql["tokens"] = _with(SPLIT_DOCS, ALL_DOC_TOKS, DOC_TOKS) + "SELECT doc_id, pos, word FROM doc_toks"
    sql["all_tokens"] = _with(SPLIT_DOCS, ALL_DOC_TOKS) + "SELECT doc_id, pos, word FROM all_doc_toks WHERE word <> ''"
    sql["stopword_filter"] = _with(SPLIT_DOCS, ALL_DOC_TOKS, DOC_TOKS) + \
        "SELECT word, count(*)::BIGINT AS n FROM doc_toks GROUP BY word"
    sql["doc_word_count"] = _with(SPLIT_DOCS, ALL_DOC_TOKS, DOC_TOKS) + """
SELECT d.doc_id, coalesce(c.n, 0)::BIGINT AS num_words
FROM documents d LEFT JOIN (SELECT doc_id, count(*) AS n FROM doc_toks GROUP BY doc_id) c ON c.doc_id = d.doc_id"""
    sql["lexicon"] = _with(SPLIT_DOCS, ALL_DOC_TOKS, DOC_TOKS, LEX) + "SELECT word_id, word FROM lex"
    sql["inverted_index"] = _with(*DOC_INDEX_CTES) + "SELECT word_id, doc_id FROM inv"
    sql["raw_postings"] = _with(SPLIT_DOCS, ALL_DOC_TOKS, DOC_TOKS, LEX) + """
SELECT l.word_id, t.doc_id, t.pos FROM doc_toks t JOIN lex l ON l.word = t.word"""
    sql["term_frequency"] = _with(*DOC_INDEX_CTES) + """
SELECT l.word_id, t.doc_id, count(*)::BIGINT AS tf FROM doc_toks t JOIN lex l ON l.word = t.word GROUP BY l.word_id, t.doc_id"""
    sql["inverted_index_sets"] = _with(*DOC_INDEX_CTES) + f"""
SELECT word_id, (doc_id // {POSTING_BLOCK})::BIGINT AS block_no, count(*)::BIGINT AS n_docs,
       string_agg(doc_id::VARCHAR, ' ' ORDER BY doc_id) AS doc_ids
FROM inv GROUP BY word_id, doc_id // {POSTING_BLOCK}"""
    sql["document_frequency"] = _with(*DOC_INDEX_CTES) + """
SELECT i.word_id, l.word, count(*)::BIGINT AS df FROM inv i JOIN lex l ON l.word_id = i.word_id GROUP BY i.word_id, l.word"""
    sql["part_chain"] = _with(CHAIN) + "SELECT from_id, to_id FROM chain"
    sql["out_degree"] = _with(CHAIN) + "SELECT from_id, count(*)::BIGINT AS outdeg FROM chain GROUP BY from_id"
    sql["in_links"] = _with(CHAIN) + f"""
SELECT to_id, (from_id // {POSTING_BLOCK})::BIGINT AS block_no, count(*)::BIGINT AS n_from,
       string_agg(from_id::VARCHAR, ' ' ORDER BY from_id) AS from_ids
FROM (SELECT DISTINCT to_id, from_id FROM chain) GROUP BY to_id, from_id // {POSTING_BLOCK}"""
    sql["link_counts"] = _with(CHAIN) + \
        "SELECT from_id, to_id, count(*)::BIGINT AS n_links FROM chain GROUP BY from_id, to_id"
    sql["page_rank"] = _with(CHAIN, *pagerank_ctes()) + "SELECT doc_id, round(score, 9) AS score FROM pr"
    search_ctes = (*DOC_INDEX_CTES, CHAIN, *pagerank_ctes(), QUERIES, TERMS, TERM_HITS)
    sql["term_lookup"] = _with(*search_ctes) + \
        "SELECT query_id, pos, word, doc_id, round(score, 9) AS score FROM term_hits"
    sql["search"] = _with(*search_ctes, RESULTS) + "SELECT query_id, rank, doc_id, round(score, 9) AS score FROM results"
    sql["search_page"] = _with(*search_ctes, RESULTS) + """
SELECT r.query_id, 2 AS page_no, t.total_pages, r.rank, r.doc_id, round(r.score, 9) AS score
FROM results r JOIN (SELECT query_id, ceil(count(*) / 5.0)::BIGINT AS total_pages FROM results GROUP BY query_id) t
  ON t.query_id = r.query_id
WHERE r.rank BETWEEN 6 AND 10"""
    sql["lexicon_scan"] = sql["lexicon"]
    sql["insert_if_absent"] = _with(SPLIT_DOCS, ALL_DOC_TOKS, DOC_TOKS, LEX) + """,
en_lex AS (
  SELECT row_number() OVER (ORDER BY word)::BIGINT AS word_id, word FROM (
    SELECT DISTINCT t.word FROM doc_toks t JOIN documents d ON d.doc_id = t.doc_id WHERE d.lang = 'en'))
SELECT word_id, word FROM en_lex
UNION ALL
SELECT (SELECT max(word_id) FROM en_lex) + row_number() OVER (ORDER BY word) AS word_id, word FROM lex
WHERE word NOT IN (SELECT word FROM en_lex)"""
    # Fixed sweeps far past the tolerance, one recursion step each.
    sql["page_rank_converged"] = _with(CHAIN, *pagerank_ctes(sweeps=1)[:3]).replace("WITH ", "WITH RECURSIVE ", 1).rstrip() + f""",
pr_i AS (
  SELECT 0 AS i, id, 1.0::DOUBLE AS score FROM pr_od
  UNION ALL
  SELECT s.i, o.id, (1.0::DOUBLE - {DAMPING!r}::DOUBLE) / (SELECT n FROM pr_n) + {DAMPING!r}::DOUBLE * s.t
  FROM pr_od o JOIN (
    SELECT r.i + 1 AS i, o2.id, sum(CASE WHEN l.to_id IS NULL THEN 0.0 ELSE r.score / od.outdeg END) AS t
    FROM pr_od o2 LEFT JOIN pr_links l ON l.to_id = o2.id AND l.from_id IN (SELECT id FROM pr_od)
    JOIN pr_i r ON r.id = coalesce(l.from_id, o2.id) JOIN pr_od od ON od.id = r.id
    WHERE r.i < 300 GROUP BY r.i, o2.id) s ON s.id = o.id)
SELECT id AS doc_id, round(score, 9) AS score FROM pr_i WHERE i = 300"""
    return sql


def _all() -> dict[str, str]:
    from webloom.plans import catalog, oracle_pages, oracle_search

    sql = build()
    sql.update(oracle_pages.build(pagerank_ctes))
    sql.update(oracle_search.build(DOC_INDEX_CTES, QUERIES, CHAIN, pagerank_ctes,
                                   catalog.CRAWL_DEPTH))
    sql["doc_index_scan"] = sql["doc_index"]
    sql["postings_scan"] = sql["inverted_index"]
    sql["page_rank_scan"] = sql["page_rank"]
    return sql


ORACLE_SQL = _all()
