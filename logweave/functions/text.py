"""Column functions for short texts (built-in expressions only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: must equal the reference's word filter --------------------------------
STOP_WORDS = (
    "a", "an", "the", "in", "on", "at", "to", "for", "with", "by",
    "of", "and", "or", "is", "are", "was", "were", "be", "been",
    "this", "that", "it", "i", "you", "he", "she", "they", "we",
    "rt", "http", "https", "com", "amp",
)
MIN_WORD_LENGTH_EXCLUSIVE = 2          # keep words longer than 2 characters
CLEAN_DROP_PATTERN = r"[^a-zA-Z0-9\s#@]"
WHITESPACE_RUN = r"\s+"
LINE_BREAK = r"\r\n|\r|\n"
# --- end of fixed values ------------------------------------------------------------------


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def java_split_space(text) -> Column:
    """``String.split(" ")`` semantics: trailing empty tokens are dropped.

    An all-space line therefore gives no tokens, an empty line one empty token.
    """
    t = _c(text)
    trimmed = F.rtrim(t)
    return (F.when((t != F.lit("")) & (trimmed == F.lit("")), F.array().cast("array<string>"))
            .otherwise(F.split(trimmed, " ")))


def clean_text(text) -> Column:
    """Lower case, drop everything but [a-zA-Z0-9 whitespace # @], squeeze spaces, trim."""
    t = F.lower(_c(text))
    t = F.regexp_replace(t, CLEAN_DROP_PATTERN, "")
    t = F.regexp_replace(t, WHITESPACE_RUN, " ")
    return F.trim(t)


def clean_words(text) -> Column:
    """P12 + F2 + F3: tokens of the cleaned text, longer than 2 chars, not stop words."""
    toks = F.split(clean_text(text), " ")
    stop = F.array(*[F.lit(w) for w in STOP_WORDS])
    return F.filter(toks, lambda w: (F.length(w) > MIN_WORD_LENGTH_EXCLUSIVE) & ~F.array_contains(stop, w))


def text_lines(text) -> Column:
    """Lines of a text the way a text-file reader sees them (no empty last line)."""
    t = _c(text)
    body = F.regexp_replace(t, r"(?:\r\n|\r|\n)\z", "")
    return F.when(t == F.lit(""), F.array().cast("array<string>")).otherwise(F.split(body, LINE_BREAK))


def char_length(text) -> Column:
    """P13, default: length in code points."""
    return F.length(_c(text))


def utf16_length(text) -> Column:
    """P13, JVM-string variant: length in UTF-16 code units (an emoji counts 2)."""
    return (F.octet_length(F.encode(_c(text), "UTF-16BE")) / 2).cast("long")
