"""Article fields from raw HTML, by pattern."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Entities to decode, the ampersand last.
ENTITIES = (
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&nbsp;", " "),
    ("&amp;", "&"),
)

HEADING = r"(?s)<h1\b[^>]*>(.*?)</h1>"
BODY = r"(?s)<article\b[^>]*>(.*?)</article>"
# An open paragraph ends where the next one starts.
PARAGRAPH = r"(?s)<p\b[^>]*>(.*?)(?=</p>|<p\b|$)"
NAVIGATION = r"(?s)<nav\b[^>]*>(.*?)</nav>"
LINK = r"(?s)<a\b[^>]*>(.*?)</a>"
OPEN_LINK = r"(?s)<a\b[^>]*>(.*?)(?=</a>|<a\b|$)"


def plain(markup: Column) -> Column:
    """Markup without tags, entities decoded."""
    text = F.regexp_replace(markup, r"<[^>]*>", "")
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def heading(html: Column) -> Column:
    return plain(F.regexp_extract(html, HEADING, 1))


def paragraphs(html: Column, body: str = BODY) -> Column:
    """Raw paragraphs of the article body, in order."""
    return F.regexp_extract_all(F.regexp_extract(html, body, 1), F.lit(PARAGRAPH), 1)


def link_texts(html: Column, area: str = NAVIGATION) -> Column:
    """Raw link texts inside one area of the page."""
    return F.regexp_extract_all(F.regexp_extract(html, area, 1), F.lit(LINK), 1)


def number_in(html: Column, pattern: str) -> Column:
    """First group of the pattern as a whole number, 0 where it is missing."""
    return F.coalesce(F.regexp_extract(html, pattern, 1).try_cast("int"), F.lit(0))
