"""Text normalisation and tokenisation with built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The token rule (maximal runs of Unicode letters after
# lower-casing) and the whitespace class collapsed by normalisation.
TOKEN_SPLIT_PATTERN = r"[^\p{L}]+"
WHITESPACE_PATTERN = r"[ \t\n\r\f\x0B]+"

# Fixed values from the sequence route: tokens kept per post and the
# width of the word vectors in the reference configuration.
MAX_TOKENS = 80
REFERENCE_VECTOR_DIM = 300


def normalize_text(text: Column) -> Column:
    """OP-T1: collapse whitespace runs to one space and trim the ends.
    Everything else is left untouched (an encoder has its own tokeniser)."""
    return F.trim(F.regexp_replace(text, WHITESPACE_PATTERN, " "))


def tokenize(text: Column) -> Column:
    """OP-T2: lower-case, split on non-letters, drop empty pieces.
    Null text gives a null list (kept null; OP-F8 turns it into zeros)."""
    return F.filter(F.split(F.lower(text), TOKEN_SPLIT_PATTERN), lambda t: t != F.lit(""))


def truncate_tokens(tokens: Column, max_tokens: int = MAX_TOKENS) -> Column:
    """OP-O1: first ``max_tokens`` tokens (null stays null)."""
    return F.slice(tokens, 1, max_tokens)
