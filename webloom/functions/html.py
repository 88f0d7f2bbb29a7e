"""HTML → events as regular expressions (Java).

A page is cut into an ordered list of events: comments, tags and text runs.
Ignored elements (script, style, ...) are removed with their content first, but not where a comment or an
attribute merely mentions them.
Only what follows the opening ``<html>`` tag is read; a page without one has
no events.
"""

from __future__ import annotations

# Elements never read, with all their content (19 distinct names).
IGNORED_TAGS = [
    "meta", "script", "link", "embed", "iframe", "frame",
    "noscript", "object", "svg", "canvas", "applet", "frameset",
    "textarea", "style", "area", "map", "base", "basefont", "param",
]

# Ignored elements that have no closing tag (void); they fall out as plain tag events.
VOID_TAGS = {"meta", "link", "embed", "frame", "area", "base", "basefont", "param"}
PAIRED_IGNORED = [t for t in IGNORED_TAGS if t not in VOID_TAGS]

# Weight added on entering and removed on leaving a tag.
FONT_WEIGHTS = {
    "b": 2, "strong": 2, "i": 1, "em": 1,
    "h1": 7, "h2": 6, "h3": 5, "h4": 4, "h5": 3,
    "title": 7,
}
HEADING_TAGS = {"h1", "h2", "h3", "h4", "h5", "title"}
INLINE_TAGS = {"b", "strong", "i", "em"}

# Our choice (rule F): inline weights restart at each block boundary.
BLOCK_TAGS = ["p", "div", "li", "td", "h1", "h2", "h3", "h4", "h5", "h6", "article"]

# The inside of a tag: quoted values (after "=") may hold ">". Every repetition starts at a "=" and is never taken
# back (Java matches a possessive group in a loop, without a stack that grows), so a match takes time in proportion
# to its length. A tag with an unclosed quote ends at the first ">" instead.
_ATTRIBUTES = r"""[^>=]*(?:=\s*(?:"[^"]*"[^>=]*|'[^']*'[^>=]*|[^\s"'>=][^>=]*|))*+>"""
_TAG = rf"<[a-zA-Z/!?]{_ATTRIBUTES}|<[a-zA-Z/!?][^>]*>"
# A comment that is never closed runs to the end of the page.
_COMMENT = r"<!--.*?(?:-->|\z)"
# Text with any "<" that starts no tag.
_TEXT = r"[^<]*(?:<+[^a-zA-Z/!?<][^<]*)++|[^<]+"

BODY_RE = rf"(?is)<html\b{_ATTRIBUTES}(.*)\z"
# Ignored elements with their content; comments and other tags are matched as wholes, so what they mention is not
# taken for an element. Replacing by KEPT drops the elements alone.
IGNORED_RE = f"(?is)({_COMMENT})|" + "|".join(rf"<{t}\b{_ATTRIBUTES}.*?</{t}\s*>" for t in PAIRED_IGNORED) + f"|({_TAG})"
KEPT = "$1$2"
EVENT_RE = f"(?s){_COMMENT}|{_TAG}|{_TEXT}"
COMMENT_RE = r"(?s)^<!--(.*?)(?:-->)?\z"
IS_TAG_RE = r"^<[a-zA-Z/!?]"
TAG_NAME_RE = r"^</?\s*([a-zA-Z][a-zA-Z0-9]*)"
TITLE_RE = r"(?is)<title\b[^>]*>(.*?)</title\s*>"
# One attribute of a tag, and the value of an href.
ATTRIBUTE_RE = r"""\s+[^\s=>]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>][^\s>]*))?"""
HREF_RE = r"""(?i)^\s+href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
