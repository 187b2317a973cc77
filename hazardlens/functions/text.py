"""Text expressions: cleaning, tokens, keyword lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token patterns that decide which words can match.
LEXICON_WORD = r"([a-zA-Z][a-zA-Z\-]+)"
CAPITALISED = r"(?U)\b([A-Z][a-zA-Z\-]{2,})\b"


def joined_text(*parts: Column) -> Column:
    """All parts with a blank between them; a missing part counts as empty."""
    return F.concat_ws(" ", *[F.coalesce(p, F.lit("")) for p in parts])


def clean_document(*parts: Column) -> Column:
    """Lower-case letters and blanks only."""
    return F.lower(F.regexp_replace(joined_text(*parts), r"[^a-zA-Z\s]", " "))


def one_line(text: Column) -> Column:
    return F.regexp_replace(text, r"[\t\n\r]", " ")


def lexicon_words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(LEXICON_WORD), F.lit(1))


def capitalised_tokens(text: Column, max_chars: int | None = None) -> Column:
    """Capitalised words of the whole text, or of its first ``max_chars`` characters."""
    known = F.coalesce(text, F.lit(""))
    head = known if max_chars is None else F.substring(known, 1, max_chars)
    return F.regexp_extract_all(head, F.lit(CAPITALISED), F.lit(1))


def last_segment(uri: Column) -> Column:
    return F.element_at(F.split(uri, "/"), -1)


def post_link(uri: Column) -> Column:
    """Public link of a post from its author (segment 2) and record key (last segment)."""
    return F.when(
        uri.isNotNull() & (uri != ""),
        F.concat(F.lit("https://bsky.app/profile/"), F.get(F.split(uri, "/"), F.lit(2)),
                 F.lit("/post/"), last_segment(uri)),
    ).otherwise("")
