"""Registered queries of the corpus operators and the SQL that says the same, where SQL can."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm import conversation_trie, exact_dedup, fingerprints, licences, line_dedup, manifest, merge_replay, mixing, ngram_join, packing, sharding, token_files, toxicity
from webloom.llm.common import count_words, documents
from webloom.llm.token_pieces import tokenizer_path, word_pattern
from webloom.session import ensure_checkpoint_dir

#: The end id of the word tokenizer's files, and of the byte tokenizer's windows.
FILE_TOKENIZER, FILE_END = "word_bpe_49k.json", 1
PACK_TOKENIZER, PACK_END = "byte_bpe_50k.json", 0
RANK_FILE = "byte_bpe_multi_50k.tiktoken"


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.neighbour_fingerprints(documents(spark, sf_dir))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir).select("doc_id", "source", "text"))
    return mixed.select(
        "doc_id", count_words(F.col("text")).alias("size"), F.col("repeats_source_size").alias("source_size"),
        F.col("repeats_target").alias("target"), "repeats", "source"
    ).withColumn("taken", F.col("size") * F.col("repeats"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(documents(spark, sf_dir), words=3, percent=90)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_groups(documents(spark, sf_dir), every_line=True)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/token-files/{uuid.uuid4().hex}"
    token_files.write_token_files(documents(spark, sf_dir), path, tokenizer_path(FILE_TOKENIZER), FILE_END)
    return token_files.read_token_files(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer_path(PACK_TOKENIZER), PACK_END)


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(documents(spark, sf_dir))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(documents(spark, sf_dir))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.rate(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op11_merge_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = tokenizer_path(RANK_FILE)
    coded = merge_replay.encode(documents(spark, sf_dir), ranks, word_pattern())
    return merge_replay.digests(coded, ranks)


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.document_manifest(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_fingerprints": op2_fingerprints,
    "op3_mixing": op3_mixing,
    "op4_ngram_join": op4_ngram_join,
    "op5_line_dedup": op5_line_dedup,
    "op6_token_files": op6_token_files,
    "op7_packing": op7_packing,
    "op8_licences": op8_licences,
    "op9_sharding": op9_sharding,
    "op10_toxicity": op10_toxicity,
    "op11_merge_replay": op11_merge_replay,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_manifest": op13_manifest,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _licence_sql() -> str:
    line = f"regexp_replace(lower(x), {_quoted(licences.COPYRIGHT_LINE)}, '')"
    for old, new in licences.SPELLINGS:
        line = f"replace({line}, {_quoted(old)}, {_quoted(new)})"
    line = f"trim(regexp_replace({line}, {_quoted(licences.NOT_WORDS)}, ' ', 'g'))"
    lines = f"list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: {line}), lambda x: x <> '')"
    known = ", ".join(f"({_quoted(i)}, {_quoted(t)})" for i, t in licences.LICENCES)
    return f"""
        WITH given(license_id, text) AS (VALUES {known}),
        known AS (SELECT array_to_string({lines}, ' ') AS body, min(license_id) AS license_id FROM given GROUP BY 1),
        t AS (SELECT doc_id, {lines} AS lines FROM documents),
        hits AS (SELECT doc_id, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS notices
                 FROM (SELECT doc_id, unnest(lines) AS body FROM t) JOIN known USING (body) GROUP BY doc_id)
        SELECT t.doc_id, sha256(array_to_string(lines, ' ')) AS text_digest, known.license_id,
               coalesce(hits.notices, '') AS notices
        FROM t LEFT JOIN known ON array_to_string(lines, ' ') = known.body LEFT JOIN hits ON hits.doc_id = t.doc_id"""


def _trie_sql() -> str:
    """The trie by joining every node to the nodes below it, a prefix being the list of its turns' digests."""
    crc = ("list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ord(x)::UBIGINT)), "
           "lambda a, x: list_reduce([xor(a, x), 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[], "
           "lambda v, i: xor(v >> 1, (v & 1) * 3988292384::UBIGINT)))")
    return f"""
        WITH t AS MATERIALIZED (
            SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) - 1 AS i,
                   sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS x, strlen(coalesce(text, '')) AS b
            FROM conversations WHERE conv_id IS NOT NULL),
        n AS (SELECT c, count(*) AS n FROM t GROUP BY c),
        k AS (SELECT n.c, n.c - n.c % 5 AS base, xor({crc.replace("c::", "n.c::")}, 4294967295::UBIGINT)::BIGINT % 9 AS h,
                     coalesce(o.n, 0) AS n_base FROM n LEFT JOIN n AS o ON o.c = n.c - n.c % 5),
        r AS (SELECT k.c, t.i AS place, x, b FROM k JOIN t ON t.c = k.base AND t.i < k.h
              UNION ALL
              SELECT k.c, least(h, n_base) + t.i - h, x, b FROM k JOIN t ON t.c = k.c AND t.i >= k.h),
        p AS MATERIALIZED (
            SELECT c, 0::BIGINT AS depth, '' AS key, 0::BIGINT AS b, '' AS parent FROM k
            UNION ALL
            SELECT c, place + 1, string_agg(x, '') OVER w, b, coalesce(string_agg(x, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '')
            FROM r WINDOW w AS (PARTITION BY c ORDER BY place)),
        nodes AS MATERIALIZED (SELECT depth, key, min(c) AS conv_id, count(*) AS n_convs, min(b) AS b, min(parent) AS parent FROM p GROUP BY depth, key),
        kids AS (SELECT parent AS key, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY parent),
        below AS (SELECT v.key, sum((u.n_convs - 1) * u.b)::BIGINT AS saved, sum((NOT EXISTS (FROM kids WHERE kids.key = u.key))::INT)::BIGINT AS leaves
                  FROM nodes v JOIN nodes u ON starts_with(u.key, v.key) GROUP BY v.key),
        ends AS (SELECT key, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS digest
                 FROM (SELECT c, arg_max(key, depth) AS key FROM p GROUP BY c) GROUP BY key)
        SELECT v.conv_id, v.depth, CASE WHEN v.depth > 0 THEN up.conv_id END AS parent_conv_id, v.n_convs, coalesce(kids.n, 0) AS n_children,
               below.leaves AS n_leaves, below.saved AS saved_tokens, coalesce(ends.digest, sha256('')) AS ends_sha256
        FROM nodes v JOIN below ON below.key = v.key LEFT JOIN kids ON kids.key = v.key LEFT JOIN ends ON ends.key = v.key
        LEFT JOIN nodes up ON up.key = v.parent AND up.depth = v.depth - 1"""


ORACLE_SQL: dict[str, str] = {
    "op1_exact_dedup": f"""
        WITH t AS (SELECT doc_id, {_LOWER} AS body FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY body) AS keep_id,
               count(*) OVER (PARTITION BY body) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY body) AS kept, sha256(body) AS text_sha256
        FROM t""",
    "op8_licences": _licence_sql(),
    "op12_conversation_trie": _trie_sql(),
}
