"""HTML Column expressions: links, title, body text and publish date.

They are regular expressions over the whole page, so malformed markup gives a
best-effort answer instead of a parse error.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import strip

LINK_REGEX = r"""(?i)<a\s[^>]*?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
TITLE_REGEX = r"(?is)<title[^>]*>(.*?)</title>"
ARTICLE_REGEX = r"(?is)<article[^>]*>(.*?)</article>"
BODY_REGEX = r"(?is)<body[^>]*>(.*)</body>"
HIDDEN_REGEX = (
    r"(?is)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<noscript[^>]*>.*?</noscript>"
)
BREAK_REGEX = r"(?i)<br\s*/?>|</?(p|h[1-6]|li|ul|ol|div|tr|table|blockquote)(\s[^>]*)?>"
TAG_REGEX = r"(?s)<[^>]*>"
DATE_REGEX = (
    r'(?i)(?:article:published_time"\s+content="|<time[^>]*\sdatetime=")(\d{4}-\d{2}-\d{2})'
)

# The named entities that are decoded, ampersand last.
ENTITIES = (
    ("&nbsp;", " "),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&apos;", "'"),
    ("&copy;", "©"),
    ("&middot;", "·"),
    ("&amp;", "&"),
)


def decode_entities(text: Column) -> Column:
    for entity, character in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(character))
    return text


def links(html: Column) -> Column:
    """Array of the ``href`` values of anchors, in page order: quoted either way or not at all, entities decoded.

    Scripts, styles and comments are dropped first; what looks like an anchor there is none.
    """
    visible = F.regexp_replace(html, HIDDEN_REGEX, "")
    raw = F.regexp_extract_all(visible, F.lit(LINK_REGEX), F.lit(1))
    return F.transform(raw, lambda h: decode_entities(F.regexp_replace(h, "^[\"']|[\"']$", "")))


def title(html: Column) -> Column:
    found = F.regexp_extract(html, TITLE_REGEX, 1)
    return strip(decode_entities(F.regexp_replace(found, TAG_REGEX, "")))


def body_text(html: Column) -> Column:
    """Text of the article element, or of the body when there is none.

    Scripts, styles and comments are dropped first, block elements end a line,
    remaining tags vanish, entities are decoded and white space is tidied.
    """
    visible = F.regexp_replace(html, HIDDEN_REGEX, "")
    article = F.regexp_extract(visible, ARTICLE_REGEX, 1)
    body = F.regexp_extract(visible, BODY_REGEX, 1)
    chosen = F.when(F.length(article) > 0, article).when(F.length(body) > 0, body).otherwise(visible)
    lines = F.regexp_replace(F.regexp_replace(chosen, r"\s+", " "), BREAK_REGEX, "\n")
    plain = decode_entities(F.regexp_replace(lines, TAG_REGEX, ""))
    return strip(F.regexp_replace(plain, r" *\n[ \n]*", "\n"))


def publish_date(html: Column) -> Column:
    """Date of the published-time meta tag or the first time element; null without one."""
    return F.try_to_date(F.regexp_extract(html, DATE_REGEX, 1), "yyyy-MM-dd")
