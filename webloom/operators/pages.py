"""Page content jobs over ``pages(page_id, url, html)``.

A page is one row, so everything that only needs one page is a row-level
expression over the page's event array (title, description, anchors,
tokens, running font weights): no shuffle at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.functions import html as H
from webloom.functions.text import WS_CLASS, is_kept_word, strip_ws, token_array
from webloom.functions.urls import normalize_base, with_resolved_url
from webloom.operators.index import with_word_ids


def _body(html: Column) -> Column:
    """Everything after ``<html ...>`` with ignored elements (and their content) removed."""
    return F.regexp_replace(F.regexp_extract(html, H.BODY_RE, 1), H.IGNORED_RE, H.KEPT)


def _event_array(html: Column) -> Column:
    return F.regexp_extract_all(_body(html), F.lit(H.EVENT_RE), 0)


def _is_comment(e: Column) -> Column:
    return e.startswith("<!--")


def _is_tag(e: Column) -> Column:
    return ~_is_comment(e) & e.rlike(H.IS_TAG_RE)


def _text_of_event(e: Column) -> Column:
    """Text carried by an event: the inside of a comment, a text run itself, NULL for a tag."""
    return (
        F.when(_is_comment(e), F.regexp_extract(e, H.COMMENT_RE, 1))
        .when(_is_tag(e), F.lit(None).cast("string"))
        .otherwise(e)
    )


def page_events(pages: DataFrame) -> DataFrame:
    """``(page_id, pos, kind, tag, closing, text)``; kind is tag / text / comment."""
    ev = pages.select("page_id", F.posexplode(_event_array(F.col("html"))).alias("pos", "event"))
    e = F.col("event")
    kind = F.when(_is_comment(e), "comment").when(_is_tag(e), "tag").otherwise("text")
    tag = F.when(kind == "tag", F.lower(F.regexp_extract(e, H.TAG_NAME_RE, 1)))
    return ev.select(
        "page_id",
        F.col("pos").cast("int").alias("pos"),
        kind.alias("kind"),
        tag.alias("tag"),
        F.when(kind == "tag", e.startswith("</")).alias("closing"),
        _text_of_event(e).alias("text"),
    )


def strip_ignored(pages: DataFrame) -> DataFrame:
    """``(page_id, body)`` — the readable part of the page, ignored elements removed."""
    return pages.select("page_id", _body(F.col("html")).alias("body"))


def text_runs(pages: DataFrame, include_comments: bool = True) -> DataFrame:
    """``(page_id, pos, text)`` for text (and comment) events, in document order."""
    ev = page_events(pages)
    kinds = ["text", "comment"] if include_comments else ["text"]
    return ev.where(F.col("kind").isin(kinds)).select("page_id", "pos", "text")


def page_meta(pages: DataFrame) -> DataFrame:
    """P4 + P5: ``(page_id, title, description)`` from row-level array expressions.

    Title: text of the last ``<title>`` element (inner tags read as spaces), stripped,
    original case. Description: the first three text runs that are not blank,
    lower-cased and concatenated without separator (unstripped).
    """
    body = _body(F.col("html"))
    titles = F.regexp_extract_all(body, F.lit(H.TITLE_RE), 1)
    last_title = F.try_element_at(titles, F.lit(-1))
    title = F.coalesce(strip_ws(F.regexp_replace(last_title, "<[^>]*>", " ")), F.lit(""))
    events = F.regexp_extract_all(body, F.lit(H.EVENT_RE), 0)
    texts = F.transform(F.filter(events, lambda e: ~_is_tag(e)), _text_of_event)
    non_blank = F.filter(texts, lambda t: F.regexp_replace(t, f"{WS_CLASS}+", "") != "")
    description = F.array_join(F.transform(F.slice(non_blank, 1, 3), lambda t: F.lower(t)), "")
    return pages.select("page_id", title.alias("title"), description.alias("description"))


def page_links(pages: DataFrame) -> DataFrame:
    """P6 + G1: every ``<a>`` tag: ``(page_id, pos, from_url, href, to_url)``; duplicates and self links kept.

    A missing ``href`` reads as the empty string, i.e. a link to the page itself.
    """
    ev = pages.select("page_id", "url", F.posexplode(_event_array(F.col("html"))).alias("pos", "event"))
    anchors = ev.where(F.lower(F.regexp_extract(F.col("event"), H.TAG_NAME_RE, 1)) == "a").where(
        ~F.col("event").startswith("</")
    )
    given = F.filter(F.regexp_extract_all("event", F.lit(H.ATTRIBUTE_RE), 0), lambda a: a.rlike(H.HREF_RE))
    last = F.coalesce(F.try_element_at(given, F.lit(-1)), F.lit(""))
    href = F.concat(*[F.regexp_extract(last, H.HREF_RE, k) for k in (1, 2, 3)])
    anchors = anchors.select("page_id", F.col("pos").cast("int").alias("pos"), "url", href.alias("href"))
    anchors = anchors.withColumn("from_url", normalize_base(F.col("url")))
    return with_resolved_url(anchors, "url", "href", "to_url").select("page_id", "pos", "from_url", "href", "to_url")


def _weight(tag: Column, tags: set[str]) -> Column:
    weights = F.create_map(*[x for t in sorted(tags) for x in (F.lit(t), F.lit(H.FONT_WEIGHTS[t]))])
    return F.coalesce(F.element_at(weights, tag), F.lit(0))


def weighted_runs(pages: DataFrame) -> DataFrame:
    """P3 + P7 in one pass: ``(page_id, runs)``, ``runs`` the page's text and comment events in order as
    ``(pos, font, text)``.

    weight = open heading/title weight + open inline weight: enter adds a tag's weight, leave takes it away, neither
    part falls below zero, and the inline part restarts at every block boundary tag. One fold over the page's event
    array, in the row: the HTML is parsed once and nothing is shuffled.
    """
    events = pages.select("page_id", F.transform(_event_array(F.col("html")), lambda e, i: F.struct(
        i.cast("int").alias("pos"), F.when(_is_tag(e), F.lower(F.regexp_extract(e, H.TAG_NAME_RE, 1))).alias("tag"),
        F.when(e.startswith("</"), F.lit(-1)).otherwise(F.lit(1)).alias("sign"), _text_of_event(e).alias("text"))).alias("events"))
    # Tags carry no text; the fold keeps the two open weights and, per event, their sum.
    zero = F.lit(0)
    start = F.struct(zero.alias("heading"), zero.alias("inline"), F.array().cast("array<int>").alias("fonts"))

    def step(state: Column, event: Column) -> Column:
        tag, sign = event["tag"], event["sign"]
        heading = F.greatest(state["heading"] + sign * _weight(tag, H.HEADING_TAGS), zero)
        open_inline = F.when(tag.isin(H.BLOCK_TAGS), zero).otherwise(state["inline"])
        inline = F.greatest(open_inline + sign * _weight(tag, H.INLINE_TAGS), zero)
        return (F.when(tag.isNull(), F.struct(state["heading"].alias("heading"), state["inline"].alias("inline"),
                                              F.array_append(state["fonts"], state["heading"] + state["inline"]).alias("fonts")))
                .otherwise(F.struct(heading.alias("heading"), inline.alias("inline"), state["fonts"].alias("fonts"))))

    fonts = F.aggregate("events", start, step, lambda state: state["fonts"])
    texts = F.filter("events", lambda e: e["tag"].isNull())
    runs = F.zip_with(texts, fonts, lambda e, font: F.struct(e["pos"].alias("pos"), font.alias("font"), e["text"].alias("text")))
    return events.select("page_id", runs.alias("runs"))


def font_weights(pages: DataFrame) -> DataFrame:
    """Weight of every text/comment event ``(page_id, pos, font)``."""
    return weighted_runs(pages).select("page_id", F.explode("runs").alias("run")).select("page_id", "run.pos", "run.font")


def page_tokens(pages: DataFrame) -> DataFrame:
    """T1 + T2 over the text runs of pages: ``(page_id, pos, tpos, word)``."""
    runs = text_runs(pages)
    return (
        runs.select("page_id", "pos", F.posexplode(token_array(F.col("text"))).alias("tpos", "word"))
        .where(is_kept_word(F.col("word")))
        .select("page_id", "pos", F.col("tpos").cast("int").alias("tpos"), "word")
    )


def hits(pages: DataFrame, lexicon: DataFrame) -> DataFrame:
    """A1: ``(page_id, pos, tpos, word_id, font)`` per kept token occurrence, in document order."""
    runs = weighted_runs(pages).select("page_id", F.explode("runs").alias("run")).select("page_id", "run.*")
    toks = runs.select("page_id", "pos", "font", F.posexplode(token_array(F.col("text"))).alias("tpos", "word"))
    toks = toks.where(is_kept_word(F.col("word"))).withColumn("tpos", F.col("tpos").cast("int"))
    return with_word_ids(toks, lexicon).select("page_id", "pos", "tpos", "word_id", "font")


def page_urls(pages: DataFrame) -> DataFrame:
    """Canonical URL of each captured page (fragment dropped, scheme lower-cased)."""
    return pages.select("page_id", normalize_base(F.col("url")).alias("url"))
