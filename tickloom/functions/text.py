"""Text columns: cleaning, HTML paragraphs, tokens, sentiment labels. All built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The cleaning patterns, with word characters spelled out for any alphabet.
URL = r"(?:http|www)\S+"
MENTION = r"@[\p{L}\p{N}_]+"
HASHTAG = r"#[\p{L}\p{N}_]+"
NOT_WORD = r"[^\p{L}\p{N}_\s]"
SPACES = r"\s+"
PARAGRAPH = r"(?s)<p(?:\s[^>]*)?>(.*?)</p>"
TAG = r"(?s)<[^>]*>"


def clean_text(text: str | Column) -> Column:
    """Without URLs, mentions, hashtags and punctuation; spaces squeezed."""
    c = F.col(text) if isinstance(text, str) else text
    for pattern in (URL, MENTION, HASHTAG, NOT_WORD):
        c = F.regexp_replace(c, pattern, "")
    return F.trim(F.regexp_replace(c, SPACES, " "))


def html_paragraphs(html: str | Column, limit: int = 10) -> Column:
    """The text of the first ``limit`` paragraphs, joined by spaces, tags removed."""
    found = F.slice(F.regexp_extract_all(html, F.lit(PARAGRAPH), F.lit(1)), 1, limit)
    return F.array_join(F.transform(found, lambda p: F.trim(F.regexp_replace(p, TAG, ""))), " ")


def tokens(text: str | Column) -> Column:
    return F.split(F.lower(clean_text(text)), " ")


def sentiment_label(polarity: str | Column) -> Column:
    c = F.col(polarity) if isinstance(polarity, str) else polarity
    return F.when(c > 0.1, "positive").when(c < -0.1, "negative").otherwise("neutral")
