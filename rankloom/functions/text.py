"""Column expressions on text. All run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ws_tokens(text: Column) -> Column:
    """Tokens between runs of Unicode white space; none for blank text."""
    return F.filter(F.split(text, r"(?U)\s+"), lambda t: t != "")


def word_terms(text: Column) -> Column:
    """Runs of ASCII letters and digits, lower-cased; any other character splits."""
    return F.transform(F.regexp_extract_all(text, F.lit("([A-Za-z0-9]+)"), 1), F.lower)


def rejoin(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


def content_key(text: Column) -> Column:
    """First 16 hex digits of the SHA-256 of the UTF-8 text."""
    return F.substring(F.sha2(text.cast("binary"), 256), 1, 16)


def is_blank(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"(?U)\s+", "")) == 0


def preview(text: Column, limit: int = 160) -> Column:
    """One line of at most ``limit`` characters, '...' marking a cut."""
    line = F.replace(text, F.lit("\n"), F.lit(" "))
    return F.when(F.length(line) > limit, F.concat(F.substring(line, 1, limit - 3), F.lit("..."))).otherwise(line)


def short_preview(text: Column, limit: int = 120) -> Column:
    """The first ``limit`` characters, always followed by '...'."""
    return F.concat(F.substring(text, 1, limit), F.lit("..."))


def plain_text(html: Column) -> Column:
    """Markup stripped to one line of text: scripts, styles, comments, tags, entities."""
    text = F.regexp_replace(html, r"(?is)<(script|style)\b[^>]*>.*?</\1>", " ")
    text = F.regexp_replace(text, r"(?s)<!--.*?-->", " ")
    text = F.regexp_replace(text, r"(?s)<[^>]*>", " ")
    text = F.regexp_replace(text, r"&[A-Za-z0-9#]+;", " ")
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def sentences(text: Column) -> Column:
    """Sentences ending in '.', '!' or '?' before white space, punctuation kept."""
    marked = F.regexp_replace(text, r"([.!?])\s+", "$1\u0001")
    return F.filter(F.split(marked, "\u0001"), lambda s: s != "")


def token_cover(needle: Column, hay: Column) -> Column:
    """Share of distinct needle terms that also occur in ``hay``; NULL without terms."""
    distinct = F.array_distinct(needle)
    return F.when(F.size(distinct) > 0, F.size(F.array_intersect(needle, hay)) / F.size(distinct))
