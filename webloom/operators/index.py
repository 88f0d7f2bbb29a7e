"""Index building: tokens (T1-T3), hits, inverted index and postings (A1-A5).

Every step is a DataFrame job. Aggregations keep map-side partial
aggregation (``distinct``/``count`` combine before the shuffle), and no step
gathers an unbounded group: posting *sets* are emitted in blocks of a bounded
doc-id range, so a word found in every document still yields many small rows
spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.functions.text import is_kept_word, token_array
from webloom.operators.keys import build_lexicon
from webloom.session import materialize

# Documents per posting block: a block holds at most this many doc ids.
POSTING_BLOCK = 4096
# Places of a document per block of positions.
POSITION_BLOCK = 1024
# Bytes of a lexicon that are broadcast at most.
LEXICON_BYTES = 64 << 20


def tokens(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """T1 + T2: ``(doc_id, pos, word)`` for every kept token, ``pos`` counting raw split pieces."""
    return (
        df.select(F.col(id_col).alias("doc_id"), F.posexplode(token_array(F.col(text_col))).alias("pos", "word"))
        .where(is_kept_word(F.col("word")))
    )


def all_tokens(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """T1 alone (no stop filter, empty pieces dropped): ``(doc_id, pos, word)``."""
    return (
        df.select(F.col(id_col).alias("doc_id"), F.posexplode(token_array(F.col(text_col))).alias("pos", "word"))
        .where(F.col("word") != "")
    )


def doc_word_count(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Kept words per document, row by row; documents with no word report 0."""
    kept = F.size(F.filter(token_array(F.coalesce(F.col(text_col), F.lit(""))), is_kept_word))
    return df.select(F.col(id_col).alias("doc_id"), kept.cast("bigint").alias("num_words"))


def word_doc_pairs(toks: DataFrame) -> DataFrame:
    """Distinct ``(word, doc_id)``: partial aggregation removes repeats inside a document
    before the shuffle, and the shuffle key includes the doc, so a frequent word is spread."""
    return toks.select("word", "doc_id").distinct()


def with_word_ids(rows: DataFrame, lex: DataFrame) -> DataFrame:
    """``rows`` with the ``word_id`` of their ``word``. A lexicon within ``LEXICON_BYTES`` (measured; each row also costs
    the hash table some room) is broadcast, so the rows of a frequent word stay in the tasks that hold them."""
    size = lex.agg(F.sum(F.octet_length("word") + 64)).first()[0] or 0
    return rows.join(F.broadcast(lex) if size <= LEXICON_BYTES else lex, "word")


def inverted_index(toks: DataFrame, lexicon: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """A2: ``inverted_index(word_id, doc_id)`` distinct, plus the lexicon used.

    The join of pairs to the lexicon is an inner equi-join on ``word``; with a
    lexicon too large to be broadcast a very frequent word is a skewed key,
    which adaptive execution splits (``spark.sql.adaptive.skewJoin.enabled``).
    """
    # Tokenising is the expensive part: produce the distinct pairs once, as a
    # table, and derive both the lexicon and the postings from it.
    pairs = materialize(word_doc_pairs(toks))
    lex = lexicon if lexicon is not None else build_lexicon(pairs)
    inv = with_word_ids(pairs, lex).select("word_id", "doc_id")
    return inv, lex


def all_word_doc_pairs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Distinct ``(word, doc_id)`` over every non-empty token (stop words included),
    written once as a table: the inverted index and the spelling dictionary both
    derive from it, so the corpus is tokenised once."""
    words = F.array_distinct(token_array(F.col(text_col)))  # a document is one row: no shuffle
    return materialize(df.select(F.col(id_col).alias("doc_id"), F.explode(words).alias("word")).where(F.col("word") != "")
                       .select("word", "doc_id"))


def inverted_index_from_pairs(all_pairs: DataFrame, keep_word: bool = False) -> tuple[DataFrame, DataFrame]:
    """A2 from ``all_word_doc_pairs``: stop words dropped, dense ids, ``(inverted_index, lexicon)``. With ``keep_word``
    the index has the ``word`` too, so that a search can pick its words before all pairs meet a large lexicon."""
    pairs = all_pairs.where(is_kept_word(F.col("word")))
    lex = build_lexicon(pairs)
    return with_word_ids(pairs, lex).select("word_id", "doc_id", *["word"] * keep_word), lex


def documents_apart(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Documents partitioned by id: their texts move once, and what is grouped by document and word later does not."""
    return df.repartition(id_col)


def position_blocks(toks: DataFrame, block: int = POSITION_BLOCK) -> tuple[DataFrame, DataFrame]:
    """A3: every occurrence, in blocks ``(word_id, doc_id, block, gaps)``, and the lexicon they refer to.

    A block covers ``block`` consecutive places of one document, so no row exceeds that, however long the document.
    ``gaps`` are the distances between the word's places, the first one from the block's start. The corpus is
    tokenised once; places of a word are put together without a shuffle when the tokens come from documents that are
    partitioned by id (``documents_apart``).
    """
    held = materialize(
        toks.groupBy("word", "doc_id", F.floor(F.col("pos") / F.lit(block)).cast("int").alias("block"))
        .agg(F.array_sort(F.collect_list(F.col("pos").cast("int"))).alias("places")))
    gaps = F.transform("places", lambda p, i: p - F.when(i == 0, F.col("block") * F.lit(block)).otherwise(
        F.element_at("places", F.greatest(i, F.lit(1)))))
    lex = build_lexicon(held)
    return with_word_ids(held.select("word", "doc_id", "block", gaps.alias("gaps")), lex).select(
        "word_id", "doc_id", "block", "gaps"), lex


def raw_postings(blocks: DataFrame, block: int = POSITION_BLOCK) -> DataFrame:
    """A3: one row per occurrence ``(word_id, doc_id, pos)`` from blocks (no key, duplicates kept)."""
    start = F.array().cast("array<int>")
    places = F.aggregate("gaps", start, lambda done, gap: F.array_append(
        done, gap + F.coalesce(F.try_element_at(done, F.lit(-1)), F.col("block") * F.lit(block))))
    return blocks.select("word_id", "doc_id", F.explode(places).alias("pos"))


def term_frequency(blocks: DataFrame) -> DataFrame:
    """A3 aggregated: ``(word_id, doc_id, tf)`` occurrences per word and document, from the blocks' sizes."""
    return blocks.groupBy("word_id", "doc_id").agg(F.sum(F.size("gaps")).cast("bigint").alias("tf"))


def posting_blocks(inv: DataFrame, key: str = "word_id", value: str = "doc_id",
                   block: int = POSTING_BLOCK) -> DataFrame:
    """A4: posting sets per key, cut into blocks of ``block`` consecutive doc ids.

    Returns ``(key, block_no, n_docs, doc_ids)`` where ``doc_ids`` is the sorted
    distinct set of the block rendered as a space-separated string. The group
    key is ``(key, doc_id div block)``, so no group exceeds ``block`` members.
    """
    return (
        inv.groupBy(F.col(key), (F.col(value) / F.lit(block)).cast("bigint").alias("block_no"))
        .agg(F.array_sort(F.collect_set(F.col(value))).alias("_s"))
        .select(
            key,
            "block_no",
            F.size("_s").cast("bigint").alias("n_docs"),
            F.array_join("_s", " ").alias("doc_ids"),
        )
    )


def document_frequency(inv: DataFrame) -> DataFrame:
    """Documents per word ``(word_id, df)``; partial aggregation keeps hot words cheap."""
    return inv.groupBy("word_id").agg(F.count(F.lit(1)).cast("bigint").alias("df"))


def resolved_index(inv: DataFrame, lexicon: DataFrame, doc_index: DataFrame,
                   block: int = POSTING_BLOCK) -> DataFrame:
    """A5: word → set of URLs, in bounded blocks: ``(word, block_no, n_urls, urls)``.

    Blocks follow doc-id ranges; URLs inside a block are sorted and joined by line feeds, which no URL holds.
    """
    resolved = inv.join(lexicon, "word_id").join(doc_index, "doc_id").select("word", "doc_id", "url")
    return (
        resolved.groupBy("word", (F.col("doc_id") / F.lit(block)).cast("bigint").alias("block_no"))
        .agg(F.array_sort(F.collect_set("url")).alias("_s"))
        .select("word", "block_no", F.size("_s").cast("bigint").alias("n_urls"), F.array_join("_s", "\n").alias("urls"))
    )
